"""Proportional stratified interleaving: every shard gets the mixture of the whole.

The rows of a stratum are shuffled by a seeded hash and ranked; rank r of n has
the fractional rank (2r - 1) / 2n. Sorted by fractional rank, every stretch of
the corpus holds each stratum in proportion, so cutting the sorted rows into
equal counts gives shards that all match the mixture (law ``rows``: counts
differ by one at most).

No stratum is ever sorted as a whole: ranks come from counts per cell of the
hash range plus a row number inside the cell, and the global place likewise
from counts per strip of the fractional rank. The first is ``cells`` rows a
stratum at most, the second ``strips`` rows in all, whatever the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmill.session import shared_dir


def seeded(key: Column, seed: int) -> Column:
    """Hex digest that orders rows at random, alike on every run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))


def interleave(
    rows: DataFrame,
    shards: int,
    *,
    key: str,
    stratum: str,
    seed: int = 1,
    cells: int = 1024,
    strips: int = 4096,
) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0).

    All columns of ``rows`` are carried through two shuffles, so pass narrow
    rows and fetch wide ones by key afterwards. ``rows`` may not have columns
    named ``shard`` or ``slot``; a clash raises ValueError. A null stratum is a
    stratum of its own, a null key is a key like any other, rows with the same
    key are ordered by their other columns, an empty table stays empty.
    """
    clash = {"shard", "slot"} & {c.lower() for c in rows.columns}
    if clash:
        raise ValueError(f"columns would be overwritten: {sorted(clash)}")
    spark = rows.sparkSession
    shared_dir(spark)
    own = rows.columns
    # Own names for the working columns, so that no column of the caller's clashes.
    base = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"),
        F.col(f"`{stratum}`").alias("_stratum"),
        seeded(F.col(f"`{key}`"), seed).alias("_hash"),
    ).withColumn("_cell", F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long") % cells)
    # A cell is a fixed share of the hashes; the shuffled order of a stratum is (cell, hash).
    counted = base.groupBy("_stratum", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy("_stratum").orderBy("_cell")
    starts = counted.select(
        F.col("_stratum").alias("_s"),
        F.col("_cell").alias("_c"),
        (F.sum("_n").over(along) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy("_stratum")).alias("_of"),
    )
    inside = Window.partitionBy("_stratum", "_cell").orderBy("_hash", "_row")
    ranked = (
        base.withColumn("_i", F.row_number().over(inside))
        .join(starts, F.col("_stratum").eqNullSafe(F.col("_s")) & (F.col("_cell") == F.col("_c")))
        .select(
            "_row",
            "_stratum",
            "_hash",
            (2 * (F.col("_before") + F.col("_i")) - 1).alias("_odd"),
            (2 * F.col("_of")).alias("_twice"),
        )
        .withColumn("_strip", F.expr(f"_odd * {strips}L div _twice"))
        # Both the counts of the strips and the rows come from here; ranking runs once.
        .checkpoint()
    )
    in_all = Window.orderBy("_strip").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (
        ranked.groupBy("_strip")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            F.col("_strip").alias("_at"),
            (F.sum("_n").over(Window.orderBy("_strip")) - F.col("_n")).alias("_before"),
            F.sum("_n").over(in_all).alias("_total"),
        )
    )
    strip = Window.partitionBy("_strip").orderBy(F.col("_odd") / F.col("_twice"), "_stratum", "_hash", "_row")
    placed = (
        ranked.withColumn("_i", F.row_number().over(strip))
        .join(offsets, F.col("_strip") == F.col("_at"))
        .withColumn("_place", F.col("_before") + F.col("_i") - 1)
        .withColumn("shard", F.expr(f"cast(_place * {shards} div _total as int)"))
        # First place of shard k: the smallest p with p * shards >= k * total.
        .withColumn("slot", F.expr(f"_place - (shard * _total + {shards - 1}) div {shards}"))
    )
    return placed.select(*[F.col("_row")[c].alias(c) for c in own], "shard", "slot")
