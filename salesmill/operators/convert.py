"""Column profiles and whole-column type decisions.

Every decision here ("convert this column only if few values fail") needs counts
over the data. All columns and all candidate formats share one aggregation.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import flag, lenient_cast, lenient_double, lenient_long
from ..functions.text import strip_all

# Accepted date layouts, tried in this order.
DATE_LAYOUTS = ("yyyy-M-d", "d/M/yyyy", "M/d/yyyy", "yyyyMMdd", "yyyy-M-d H:m:s")

_MONTH, _DAY = "(0?[1-9]|1[0-2])", "(0?[1-9]|[12][0-9]|3[01])"
# What text in a layout looks like. Parsing text of another layout raises and
# catches an error per value, which costs far more than this look.
_SHAPES = {
    "yyyy-M-d": f"^[0-9]{{4}}-{_MONTH}-{_DAY}$",
    "d/M/yyyy": f"^{_DAY}/{_MONTH}/[0-9]{{4}}$",
    "M/d/yyyy": f"^{_MONTH}/{_DAY}/[0-9]{{4}}$",
    "yyyyMMdd": "^[0-9]{4}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])$",
    "yyyy-M-d H:m:s": f"^[0-9]{{4}}-{_MONTH}-{_DAY} [0-9]{{1,2}}:[0-9]{{1,2}}:[0-9]{{1,2}}$",
}


class ConversionError(ValueError):
    """A column has more unreadable values than the limit allows."""


@dataclasses.dataclass(frozen=True)
class Converted:
    frame: DataFrame
    chosen: dict[str, str]
    failures: dict[str, int]
    kept_as_text: tuple[str, ...]
    extra: dict[str, object] = dataclasses.field(default_factory=dict)


def _measures(f: T.StructField) -> dict[str, Column]:
    c = F.col(f"`{f.name}`")
    ordered = isinstance(f.dataType, T.NumericType)
    text = isinstance(f.dataType, T.StringType)
    return {
        "null_count": F.count_if(c.isNull()),
        "min_value": F.min(c).cast("double") if ordered else F.lit(None).cast("double"),
        "max_value": F.max(c).cast("double") if ordered else F.lit(None).cast("double"),
        "max_bytes": F.max(F.octet_length(c)) if text else F.lit(None).cast("int"),
    }


def profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per column: nulls, numeric range, longest text in bytes. One pass."""
    wanted = set(columns) if columns is not None else set(df.columns)
    fields = [f for f in df.schema.fields if f.name in wanted]
    stats = [
        F.struct(F.lit(f.name).alias("column_name"), *[m.alias(k) for k, m in _measures(f).items()])
        for f in fields
    ]
    one_row = df.agg(F.count(F.lit(1)).alias("row_count"), F.array(*stats).alias("stats"))
    return one_row.select("row_count", F.inline("stats"))


def exact_ranges(df: DataFrame, columns: Iterable[str]) -> dict[str, tuple]:
    """Exact (min, max) per integer column, one pass."""
    columns = list(columns)
    if not columns:
        return {}
    row = df.agg(*[F.struct(F.min(f"`{c}`"), F.max(f"`{c}`")).alias(c) for c in columns]).first()
    return {c: tuple(row[c]) for c in columns}


def max_bytes(df: DataFrame, columns: Iterable[str]) -> dict[str, int | None]:
    """Longest value in bytes per text column, one pass."""
    columns = list(columns)
    if not columns:
        return {}
    row = df.agg(*[F.max(F.octet_length(f"`{c}`")).alias(c) for c in columns]).first()
    return row.asDict()


def _date_readings(c: Column, target: T.DataType, layouts: Iterable[str]) -> dict[str, Column]:
    text = strip_all(c)
    parsed = {p: F.try_to_timestamp(text, F.lit(p)).cast(target) for p in layouts}
    return {p: F.when(text.rlike(_SHAPES[p]), v) if p in _SHAPES else v for p, v in parsed.items()}


def readings(c: Column, target: T.DataType, layouts: Iterable[str] = DATE_LAYOUTS) -> dict[str, Column]:
    """Every way to read a text column as the target type, in order of preference."""
    kind = target.simpleString()
    if isinstance(target, (T.DateType, T.TimestampType)):
        return _date_readings(c, target, layouts)
    if isinstance(target, T.IntegralType):
        return {kind: lenient_long(c, kind)}
    if isinstance(target, (T.FloatType, T.DoubleType)):
        return {kind: lenient_double(c).cast(target)}
    if isinstance(target, T.DecimalType):
        return {kind: lenient_cast(c, target)}
    if isinstance(target, T.BooleanType):
        return {kind: flag(strip_all(c))}
    return {}


def convert(
    df: DataFrame,
    targets: Mapping[str, T.DataType],
    max_failures: float = 0.1,
    date_failures: float | None = None,
    on_failure: str = "raise",
    layouts: Iterable[str] = DATE_LAYOUTS,
    extra: Mapping[str, Column] | None = None,
) -> Converted:
    """Convert text columns, deciding per column over the whole data.

    A value fails when it was not NULL and reads as NULL. The first reading whose
    failures stay within the limit is taken; with none, ``on_failure`` is
    ``raise`` (error) or ``keep`` (the column stays text). ``extra`` aggregates
    are taken in the same pass and returned.
    """
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    layouts = tuple(layouts)
    options = {
        c: opts for c, t in targets.items() if c in text and (opts := readings(F.col(f"`{c}`"), t, layouts))
    }
    counts = {
        f"{c}|{name}": F.count_if(F.col(f"`{c}`").isNotNull() & reading.isNull())
        for c, opts in options.items()
        for name, reading in opts.items()
    }
    wanted = counts | dict(extra or {})
    if not wanted:
        return Converted(df, {}, {}, ())
    row = df.agg(F.count(F.lit(1)).alias("|rows"), *[v.alias(k) for k, v in wanted.items()]).first()

    chosen, failures, kept = {}, {}, []
    for c, opts in options.items():
        dated = isinstance(targets[c], (T.DateType, T.TimestampType))
        limit = date_failures if dated and date_failures is not None else max_failures
        fits = [name for name in opts if row[f"{c}|{name}"] <= row["|rows"] * limit]
        if fits:
            chosen[c] = fits[0]
            failures[c] = row[f"{c}|{fits[0]}"]
        elif on_failure == "keep":
            kept.append(c)
            failures[c] = min(row[f"{c}|{name}"] for name in opts)
        else:
            worst = min(row[f"{c}|{name}"] for name in opts)
            raise ConversionError(f"{c}: {worst} of {row['|rows']} values unreadable as {targets[c].simpleString()}")
    out = df.withColumns({c: options[c][name] for c, name in chosen.items()})
    return Converted(out, chosen, failures, tuple(kept), {k: row[k] for k in extra or {}})


def convert_mapped(df: DataFrame, schema: T.StructType) -> Converted:
    """Numeric columns that convert without a single failure; the others stay text."""
    targets: dict[str, T.DataType] = {}
    for f in schema.fields:
        if isinstance(f.dataType, T.IntegralType):
            targets[f.name] = T.IntegerType() if not isinstance(f.dataType, T.LongType) else T.LongType()
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            targets[f.name] = T.DoubleType()
    return convert(df, targets, max_failures=0.0, on_failure="keep")


def lenient_types(df: DataFrame, kinds: Mapping[str, str], names: Mapping[str, str] | None = None) -> DataFrame:
    """Rename and cast without counting: unreadable values become NULL."""
    names = names or {}
    spark_types = {"int": "bigint", "integer": "bigint", "float": "double", "double": "double"}
    picked = []
    for c in df.columns:
        value = F.col(f"`{c}`")
        if c in kinds:
            value = value.try_cast(spark_types.get(kinds[c], "string"))
        picked.append(value.alias(names.get(c, c)))
    return df.select(picked)


def strict_int(df: DataFrame, *columns: str) -> DataFrame:
    """Cast to int; an unreadable value fails the job."""
    return df.withColumns({c: F.col(c).cast("int") for c in columns})
