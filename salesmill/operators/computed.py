"""Columns derived from other columns, given as plain definitions.

A definition is a mapping with a ``type``:

* ``concatenation``: ``columns``, ``separator``, ``nulls``
* ``calculation``: ``formula``, a Spark SQL expression, its ``columns`` if they are to be told, and ``nulls``
* ``classification``: ``column``, ``labels`` {code: label}, ``default``
* ``bands``: ``column``, ``steps`` [(lower bound, label)], ``default``
* ``fiscal_year`` / ``fiscal_quarter``: ``column``
* ``days_since``: ``column``, ``as_of``
* ``lookup``: ``table``, ``on`` (own column), ``key``, ``value``
"""

from __future__ import annotations

from collections.abc import Mapping
from graphlib import CycleError, TopologicalSorter
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from ..functions.text import joined_key


def sources(definition: Mapping[str, Any]) -> set[str]:
    """Columns a definition reads. For a formula without ``columns``, Spark's own parse tells."""
    kind = definition["type"]
    if kind == "concatenation":
        return set(definition["columns"])
    if kind == "calculation":
        return set(definition["columns"]) if "columns" in definition else formula_columns(definition["formula"])
    if kind == "lookup":
        return {definition["on"]}
    return {definition["column"]}


def formula_columns(formula: str) -> set[str]:
    """Columns that a Spark SQL expression names, as spelled."""
    spark = SparkSession.active()
    parsed = spark._jsparkSession.sessionState().sqlParser().parseExpression(formula)
    kind = spark._jvm.java.lang.Class.forName(
        "org.apache.spark.sql.catalyst.analysis.UnresolvedAttribute",
        True,
        spark._jvm.java.lang.Thread.currentThread().getContextClassLoader(),
    )
    found, todo = set(), [parsed]
    while todo:
        node = todo.pop()
        if kind.isInstance(node):
            found.add(node.nameParts().apply(0))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def _concatenation(d: Mapping[str, Any]) -> Column:
    return joined_key(d["columns"], d.get("separator", "_"), d.get("nulls", "text"))


def _calculation(d: Mapping[str, Any]) -> Column:
    value = F.expr(d["formula"])
    policy = d.get("nulls", "null")
    if policy == "zero":
        return F.coalesce(value, F.lit(0))
    if policy == "error":
        return F.when(value.isNull(), F.raise_error(f"no value for {d['formula']}")).otherwise(value)
    return value


def _classification(d: Mapping[str, Any]) -> Column:
    out = F
    for code, label in d["labels"].items():
        out = out.when(F.col(d["column"]) == code, F.lit(label))
    return out.otherwise(F.lit(d.get("default")))


def _bands(d: Mapping[str, Any]) -> Column:
    out = F
    for lower, label in sorted(d["steps"], reverse=True):
        out = out.when(F.col(d["column"]) > lower, F.lit(label))
    return out.otherwise(F.lit(d.get("default")))


_BUILDERS = {
    "concatenation": _concatenation,
    "calculation": _calculation,
    "classification": _classification,
    "bands": _bands,
    "fiscal_year": lambda d: dates.fiscal_year(d["column"], d.get("start_month", 4)),
    "fiscal_quarter": lambda d: dates.fiscal_quarter(d["column"], d.get("start_month", 4)),
    "days_since": lambda d: dates.days_since(d["column"], d["as_of"]),
}


def build_order(definitions: Mapping[str, Mapping[str, Any]]) -> list[str]:
    """Names so that each comes after the derived columns it reads."""
    graph = {n: sources(d) & set(definitions) - {n} for n, d in definitions.items()}
    for n, d in definitions.items():
        if n in sources(d):
            raise ValueError(f"{n} is defined by itself")
    try:
        return list(TopologicalSorter(graph).static_order())
    except CycleError as err:
        raise ValueError(f"definitions depend on each other: {err.args[1]}") from err


def add_computed(
    df: DataFrame,
    definitions: Mapping[str, Mapping[str, Any]],
    tables: Mapping[str, DataFrame] | None = None,
) -> tuple[DataFrame, dict[str, list[str]]]:
    """Add the defined columns; returns the frame and {skipped column: missing sources}."""
    skipped: dict[str, list[str]] = {}
    for name in build_order(definitions):
        d = definitions[name]
        have = {c.lower() for c in df.columns}
        absent = sorted(s for s in sources(d) if s.lower() not in have)
        if absent:
            skipped[name] = absent
            continue
        if d["type"] == "lookup":
            df = lookup(df, (tables or {})[d["table"]], d["on"], d["key"], d["value"], name)
        else:
            value = _BUILDERS[d["type"]](d)
            df = df.withColumn(name, value.cast(d["datatype"]) if "datatype" in d else value)
    return df, skipped


def lookup(df: DataFrame, table: DataFrame, on: str, key: str, value: str, name: str) -> DataFrame:
    """Value of a reference table by key; NULL when there is none.

    The planner broadcasts the two reference columns when they are small and
    shuffles both sides on the key otherwise.
    """
    side = table.select(F.col(key).alias("_key"), F.col(value).alias(name))
    return df.join(side, df[on] == F.col("_key"), "left").drop("_key")


def definition_problems(schema: T.StructType, definitions: Mapping[str, Mapping[str, Any]]) -> list[dict]:
    """Definitions reading columns that neither the schema nor a definition provides."""
    have = {f.name for f in schema.fields} | set(definitions)
    return [
        {"column": n, "missing": sorted(sources(d) - have)}
        for n, d in definitions.items()
        if sources(d) - have
    ]


def definition_report(
    df: DataFrame, definitions: Mapping[str, Mapping[str, Any]], tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One row per definition: name, the columns it lacks (comma-joined), and the rows that get a value from it.

    Definitions that depend on each other are refused, those that lack a column
    are left out with all that read them. The rest are counted in one pass.
    """
    out, skipped = add_computed(df, definitions, tables)
    count = lambda n: F.count(F.col(f"`{n}`")) if n not in skipped else F.lit(0).cast("long")
    rows = [F.struct(F.lit(n).alias("name"), F.lit(",".join(skipped.get(n, []))).alias("missing"), count(n).alias("filled")) for n in definitions]
    return out.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))
