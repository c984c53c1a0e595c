"""Choosing, numbering, stacking and totalling records."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import small_side
from .align import union_all


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order.

    ``order`` must settle every tie. The planner keeps one candidate per key and
    partition before the shuffle, so a hot key moves no more rows than others.
    """
    by_key = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(by_key)).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return first_per_key(df, keys, [F.col(column).desc()])


def last_value_map(df: DataFrame, key: str, value: str, order: str, name: str) -> DataFrame:
    """Key -> value of the row that comes last in the given order."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(name))


def running_total(df: DataFrame, group: str, day: str, measure: str, name: str) -> DataFrame:
    """Total of the group up to and including the row's day; same-day rows share it.

    Days are totalled first: the running sum then runs over one row per group
    and day, however many rows a group has, and is joined back by day.
    """
    days = df.groupBy(group, day).agg(F.sum(measure).alias("_day_total"))
    upto = Window.partitionBy("_group").orderBy("_day")
    totals = days.select(
        F.col(group).alias("_group"), F.col(day).alias("_day"), "_day_total"
    ).select("_group", "_day", F.sum("_day_total").over(upto).alias(name))
    same = df[group].eqNullSafe(F.col("_group")) & df[day].eqNullSafe(F.col("_day"))
    return df.join(small_side(totals), same, "left").drop("_group", "_day")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter(F.col("copies") > 1)


def settle_duplicates(df: DataFrame, keys: Sequence[str], action: str, order: Sequence[Column] = ()) -> DataFrame:
    """Rows whose key stands more than once: ``warn`` marks them, ``remove`` keeps the first, ``fail`` ends the job.

    Marks are a column ``is_duplicate``. ``order`` is needed for ``remove`` and
    must settle every tie. Keys are counted before they meet the rows, and only
    the repeated ones do.
    """
    if action == "remove":
        if not order:
            raise ValueError("removing duplicates needs an order")
        return first_per_key(df, keys, order)
    if action not in ("warn", "fail"):
        raise ValueError(f"unknown action {action!r}")
    twice = repeated_keys(df, keys).select(*[F.col(f"`{k}`").alias(f"_twice_{k}") for k in keys], F.lit(True).alias("_twice"))
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_twice_{k}`")) for k in keys])
    marked = df.join(twice, same, "left").withColumn("is_duplicate", F.coalesce("_twice", F.lit(False)))
    marked = marked.drop("_twice", *[f"_twice_{k}" for k in keys])
    if action == "warn":
        return marked
    stop = F.raise_error(F.concat_ws(" ", F.lit(f"a key of {list(keys)} is repeated:"), *[F.col(f"`{k}`").cast("string") for k in keys]))
    return marked.filter(F.when(F.col("is_duplicate"), stop.cast("boolean")).otherwise(F.lit(True))).drop("is_duplicate")


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows, for looking at; partitions beyond those needed are not computed."""
    return df.limit(rows)


def distinct_union(frames: Iterable[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def unpivot(
    df: DataFrame, keep: Sequence[str], columns: Sequence[str], name: str = "name", value: str = "value"
) -> DataFrame:
    """One row per (row, column) with a value. One scan, whatever the number of columns."""
    text = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in columns])
    return text.unpivot(list(keep), list(columns), name, value).filter(F.col(value).isNotNull())


def concat_key(*parts: str) -> Column:
    """Join key glued from columns; NULL when a part is NULL, so it matches nothing."""
    return F.concat(*[F.col(p).cast("string") for p in parts])
