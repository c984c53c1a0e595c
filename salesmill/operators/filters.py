"""Row filters. Plain comparisons on bare columns, so they reach the Parquet scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def from_day(df: DataFrame, column: str, cutoff: int) -> DataFrame:
    """Rows dated on or after a day; NULL dates drop out."""
    return df.filter(F.col(column) >= cutoff)


def after_day(df: DataFrame, column: str, cutoff: int) -> DataFrame:
    """Rows dated after a day; NULL dates drop out."""
    return df.filter(F.col(column) > cutoff)


def in_period(column: str, first: int, last: int) -> Column:
    return F.col(column).between(first, last)


def not_blank(column: str) -> Column:
    return F.col(column).isNotNull() & (F.trim(F.col(column)) != "")


def differ(left: str, right: str) -> Column:
    """Inequality; a NULL on either side drops the row."""
    return F.col(left) != F.col(right)


def any_of(types: Iterable[str], reason_types: Iterable[str], reasons: Iterable[str]) -> Column:
    """Document type in one list, or in a second list with an accepted reason."""
    by_type = F.col("mis_type").isin(*types)
    by_reason = F.col("mis_type").isin(*reason_types) & F.col("reason_code").isin(*reasons)
    return by_type | by_reason


def members(df: DataFrame, column: str, allowed: DataFrame, key: str) -> DataFrame:
    """Rows whose value occurs in a table of allowed values (no literal list)."""
    side = allowed.withColumnRenamed(key, "_allowed")
    return df.join(side, df[column] == F.col("_allowed"), "left_semi")
