"""Data-quality rules, overflow checks and load gates.

Row rules become boolean expressions; all of them are counted in one pass and the
names of the broken ones travel with the row, so rejected rows say why.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ddl
from ..functions.dates import as_int
from ..functions.numbers import finite_or_null
from ..functions.text import blank_to_null
from .convert import exact_ranges, max_bytes

VIOLATIONS = "_violations"

# Checking order, and what may happen to a row that breaks a rule.
STAGES = ("schema", "quality", "business", "cross_table")
ACTIONS = ("fail", "warn", "skip_row", "use_default", "convert_to_null")

# Formats of well-known columns.
PATTERNS = {
    "invoice_no": r"^[A-Z0-9]{8,20}$",
    "customer_code": r"^[A-Z0-9]{4,12}$",
    "material_code": r"^[A-Z0-9]{4,18}$",
    "email": r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$",
}

# Fixed values: (minimum, maximum, default) of the measure kinds.
RANGES = {
    "quantity": (0, 999999999, 0),
    "amount": (0, 9999999999.99, 0.0),
    "rate": (0, 9999999.99, 0.0),
}
DATE_RANGE = (19000101, 20991231)
NEVER_NULL = ("invoice_date", "invoice_no", "customer_code", "material_code")
SELDOM_NULL = ("dealer_name", "material_description", "sales_office_code")
UPPER_COLUMNS = ("customer_code", "material_code", "dealer_code", "sales_office_code")
LOWER_COLUMNS = ("email", "website")
VOLUME_LIMITS = (0.5, 1.5)
ERROR_LIMITS = (0.001, 0.01)
GROWTH = 1.2


class QualityError(ValueError):
    """A rule with action ``fail`` was broken, or too many rows were rejected."""


@dataclasses.dataclass(frozen=True)
class Rule:
    """A row is fine when ``ok`` is true or NULL."""

    name: str
    ok: Column
    action: str = "warn"
    column: str | None = None
    default: Any = None
    stage: str = "quality"

    def __post_init__(self) -> None:
        if self.action not in ACTIONS or self.stage not in STAGES:
            raise ValueError(f"{self.name}: unknown action or stage")
        if self.action in ("use_default", "convert_to_null") and self.column is None:
            raise ValueError(f"{self.name}: action {self.action} needs a column")

    @property
    def broken(self) -> Column:
        return ~F.coalesce(self.ok, F.lit(True))


def required(column: str, action: str = "fail") -> Rule:
    return Rule(f"{column}_missing", F.col(column).isNotNull(), action, column)


def in_range(column: str, kind: str, action: str = "use_default") -> Rule:
    low, high, default = RANGES[kind]
    return Rule(f"{column}_range", F.col(column).between(low, high), action, column, default)


def matches(column: str, pattern: str | None = None, action: str = "warn") -> Rule:
    return Rule(f"{column}_pattern", F.col(column).rlike(pattern or PATTERNS[column]), action, column)


def plausible_day(column: str, as_of: dt.date | None = None, action: str = "skip_row") -> Rule:
    """Day within the valid range and, given a current day, not in the future."""
    low, high = DATE_RANGE
    if as_of is not None:
        high = min(high, as_int(as_of))
    return Rule(f"{column}_day", F.col(column).between(low, high), action, column)


def declared_required(schema: T.StructType, action: str = "fail") -> list[Rule]:
    """Columns declared NOT NULL hold a value."""
    return [required(f.name, action) for f in schema.fields if not f.nullable]


def fits_bytes(schema: T.StructType, action: str = "warn") -> list[Rule]:
    """Text no longer than declared; limits count bytes."""
    return [
        Rule(
            f"{f.name}_length",
            F.octet_length(f.name) <= f.metadata["max_bytes"],
            action,
            f.name,
            stage="schema",
        )
        for f in schema.fields
        if "max_bytes" in (f.metadata or {})
    ]


def ordered(rules: Iterable[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: STAGES.index(r.stage))


def flag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the names of broken rules, and repair the values rules may repair."""
    rules = ordered(rules)
    marks = [F.when(r.broken, F.lit(r.name)) for r in rules]
    names = F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")
    flagged = df.withColumn(VIOLATIONS, names)
    repaired: dict[str, Column] = {}
    for r in rules:
        if r.action in ("use_default", "convert_to_null"):
            dtype = df.schema[r.column].dataType
            value = F.lit(r.default if r.action == "use_default" else None).cast(dtype)
            hit = F.array_contains(VIOLATIONS, r.name)
            repaired[r.column] = F.when(hit, value).otherwise(repaired.get(r.column, F.col(r.column)))
    return flagged.withColumns(repaired)


def rejected(rules: Iterable[Rule]) -> Column:
    """Does a flagged row break a rule that excludes it?"""
    stops = [r.name for r in rules if r.action in ("fail", "skip_row")]
    if not stops:
        return F.lit(False)
    return F.arrays_overlap(F.col(VIOLATIONS), F.array(*[F.lit(s) for s in stops]))


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their reasons)."""
    flagged = flag(df, rules)
    stop = rejected(rules)
    bad = flagged.filter(stop).withColumnRenamed(VIOLATIONS, "reasons")
    return flagged.filter(~stop).drop(VIOLATIONS), bad


def rule_counts(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with the number of rows breaking it. One pass."""
    rules = ordered(rules)
    stats = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            F.lit(r.stage).alias("stage"),
            F.count_if(F.array_contains(VIOLATIONS, r.name)).alias("violations"),
        )
        for r in rules
    ]
    one_row = flagged.agg(F.count(F.lit(1)).alias("row_count"), F.array(*stats).alias("stats"))
    return one_row.select("row_count", F.inline("stats"))


def count_columns(rules: Sequence[Rule]) -> list[Column]:
    """The same counts as columns for ``DataFrame.observe`` on a write."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(rejected(rules)).alias("rejected"),
        *[F.count_if(F.array_contains(VIOLATIONS, r.name)).alias(f"rule:{r.name}") for r in rules],
    ]


def gate(counts: Mapping[str, int], rules: Iterable[Rule], max_error_ratio: float) -> None:
    """Refuse the load when a ``fail`` rule was broken or too many rows were rejected."""
    for r in rules:
        n = counts.get(f"rule:{r.name}", 0)
        if r.action == "fail" and n:
            raise QualityError(f"{r.name}: {n} rows")
    rows, bad = counts.get("rows", 0), counts.get("rejected", 0)
    if bad > rows * max_error_ratio:
        raise QualityError(f"{bad} of {rows} rows rejected, limit {max_error_ratio:.2%}")


# --- declared sizes ---------------------------------------------------------


def text_overflows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns holding more bytes than declared, with a proposed size."""
    limits = {f.name: f.metadata["max_bytes"] for f in schema.fields if "max_bytes" in (f.metadata or {})}
    stats = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(n).cast("bigint").alias("declared_bytes"),
            F.max(F.octet_length(F.col(c).cast("string"))).cast("bigint").alias("max_bytes"),
        )
        for c, n in limits.items()
        if c in df.columns
    ]
    found = df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))
    proposal = F.floor(F.col("max_bytes") * F.lit(GROWTH))
    return found.filter(F.col("max_bytes") > F.col("declared_bytes")).withColumn("proposed_bytes", proposal)


def int_overflows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Integer columns with values outside the declared type."""
    stats = []
    for f in schema.fields:
        kind = ddl.base_type(ddl.declared(f))
        if kind in ddl.INT_BOUNDS and f.name in df.columns and isinstance(df.schema[f.name].dataType, T.IntegralType):
            low, high = ddl.INT_BOUNDS[kind]
            stats.append(
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(kind).alias("declared"),
                    F.min(f.name).cast("bigint").alias("min_value"),
                    F.max(f.name).cast("bigint").alias("max_value"),
                    F.lit(low).cast("bigint").alias("low"),
                    F.lit(high).cast("bigint").alias("high"),
                )
            )
    found = df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))
    return found.filter((F.col("min_value") < F.col("low")) | (F.col("max_value") > F.col("high"))).drop("low", "high")


def text_in_numeric(df: DataFrame, schema: T.StructType) -> list[str]:
    """Columns declared numeric that still hold text."""
    numeric = {f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)}
    return [f.name for f in df.schema.fields if f.name in numeric and isinstance(f.dataType, T.StringType)]


@dataclasses.dataclass(frozen=True)
class Widening:
    table: str
    column: str
    old: str
    new: str
    reason: str

    @property
    def statement(self) -> str:
        """What is to change, for people; ``Table.evolve`` makes the change."""
        return f"{self.table}.{self.column}: {self.old} to {self.new}"


def proposed_bytes(longest: int) -> int:
    """Declared size for text of which the longest value has so many bytes."""
    return int(longest * GROWTH)


def propose_widening(df: DataFrame, table: str, schema: T.StructType) -> list[Widening]:
    """Type changes that make the data fit. Reads the data twice at most, all columns at once."""
    by_name = {f.name: f for f in schema.fields if f.name in df.columns}
    texts = [c for c, f in by_name.items() if "max_bytes" in (f.metadata or {})]
    ints = [
        c
        for c, f in by_name.items()
        if ddl.base_type(ddl.declared(f)) in ddl.INT_BOUNDS and isinstance(df.schema[c].dataType, T.IntegralType)
    ]
    plan = []
    for c, longest in max_bytes(df, texts).items():
        limit = by_name[c].metadata["max_bytes"]
        if longest is not None and longest > limit:
            size = proposed_bytes(longest)
            plan.append(Widening(table, c, f"VARCHAR({limit})", f"VARCHAR({size})", f"longest value {longest} bytes"))
    for c, (low, high) in exact_ranges(df, ints).items():
        if low is None:
            continue
        old = ddl.declared(by_name[c])
        new = ddl.next_int_type(old, low, high)
        if new:
            plan.append(Widening(table, c, old, new, f"values {low} to {high}"))
    for c, f in by_name.items():
        kind, actual = ddl.base_type(ddl.declared(f)), df.schema[c].dataType
        if kind == "FLOAT" and isinstance(actual, T.DoubleType):
            plan.append(Widening(table, c, "FLOAT", "DOUBLE", "double precision data"))
        elif kind == "DATE" and isinstance(actual, (T.TimestampType, T.TimestampNTZType)):
            plan.append(Widening(table, c, "DATE", "DATETIME", "time of day in the data"))
    return plan


def widened(schema: T.StructType, changes: Iterable[Widening]) -> T.StructType:
    """Schema after the changes; a change that is not a widening is refused."""
    new = {c.column: c for c in changes}
    fields = []
    for f in schema.fields:
        if f.name in new:
            if not ddl.may_widen(new[f.name].old, new[f.name].new):
                raise ValueError(f"{f.name}: {new[f.name].old} to {new[f.name].new} is not a widening")
            f = ddl.field(f.name, new[f.name].new, f.nullable)
        fields.append(f)
    return T.StructType(fields)


def widening_log(spark: SparkSession, changes: Iterable[Widening], at: dt.datetime) -> DataFrame:
    """The changes as records, ready to be appended to a log."""
    rows = [(json.dumps(dataclasses.asdict(c)), c.statement, at) for c in changes]
    return spark.createDataFrame(rows, "change string, statement string, recorded_at timestamp")


# --- across rows and tables -------------------------------------------------


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact keys without a dimension row, with the number of fact rows.

    Keys are counted first, so a hot key crosses the network as one row.
    """
    keys = fact.filter(F.col(fact_key).isNotNull()).groupBy(fact_key).agg(F.count(F.lit(1)).alias("fact_rows"))
    side = dim.select(F.col(dim_key).alias("_dim_key"))
    return keys.join(side, keys[fact_key] == F.col("_dim_key"), "left_anti")


def volume_alerts(runs: DataFrame, previous: DataFrame, on: str, rows: str = "rows") -> DataFrame:
    """Row-count ratio of runs to their previous runs, with an alert outside the limits."""
    low, high = VOLUME_LIMITS
    prev = previous.select(F.col(on).alias("_run"), F.col(rows).alias("previous_rows"))
    joined = runs.join(prev, runs[on] == F.col("_run")).drop("_run")
    ratio = F.col(rows) / F.nullif(F.col("previous_rows"), F.lit(0))
    alert = (
        F.when(F.col("ratio") > high, "increase").when(F.col("ratio") < low, "decrease").otherwise("none")
    )
    return joined.withColumn("ratio", ratio).withColumn("alert", alert)


def error_level(errors: Column, rows: Column) -> Column:
    warn, critical = ERROR_LIMITS
    rate = errors / F.nullif(rows, F.lit(0))
    return F.when(rate > critical, "critical").when(rate > warn, "warning").otherwise("ok")


# --- standard forms ---------------------------------------------------------


def standardise(
    df: DataFrame,
    upper: Iterable[str] = UPPER_COLUMNS,
    lower: Iterable[str] = LOWER_COLUMNS,
    places: int = 2,
) -> DataFrame:
    """Strip text, empty text to NULL, fixed case for codes, finite rounded numbers."""
    upper, lower = set(upper), set(lower)
    new: dict[str, Column] = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            value = blank_to_null(f.name)
            value = F.upper(value) if f.name in upper else F.lower(value) if f.name in lower else value
            new[f.name] = value
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            new[f.name] = F.round(finite_or_null(f.name), places)
    return df.withColumns(new)


def audit_columns(
    df: DataFrame, batch: str, at: dt.datetime, system: str, user: str = "SYSTEM", source_file: Column | None = None
) -> DataFrame:
    """Who, when and from where, as columns."""
    stamp = F.lit(at)
    return df.withColumns(
        {
            "created_at": stamp,
            "updated_at": stamp,
            "created_by": F.lit(user),
            "updated_by": F.lit(user),
            "source_file": source_file if source_file is not None else F.lit(None).cast("string"),
            "source_system": F.lit(system),
            "load_timestamp": stamp,
            "load_batch_id": F.lit(batch),
        }
    )


def within_retention(df: DataFrame, column: str, as_of: dt.date, days: int) -> DataFrame:
    """Rows not older than the retention period; undated rows stay."""
    limit = as_of - dt.timedelta(days=days)
    dtype = df.schema[column].dataType
    bound = F.lit(as_int(limit)) if isinstance(dtype, T.IntegralType) else F.lit(limit)
    return df.filter(F.col(column).isNull() | (F.col(column) >= bound))
