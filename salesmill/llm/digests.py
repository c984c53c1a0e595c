"""Exact duplicates by a tree of merged digest runs.

Every partition turns its texts into one sorted run of digests. Runs then go up
a tree in rounds: a run's place is a number of ``ROUNDS`` digits, and in each
round the places that differ in one digit exchange their runs so that every
digest moves to the place with its own digit there. Runs that meet are merged,
and of each text only the smallest identifier and the number of rows go on.
After the last round a digest's place follows from the digest alone, so each
text is settled once. The answers go back down the same tree.

A run is ordered by a 64-bit digest; what counts as equal is verified by SHA-256
at every level. No key ever meets more rows than one partition holds of a text
(at the leaves) or ``FAN`` rows (above), however many copies there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmill.session import shared_dir

#: Runs that exchange in one round, and the rounds. Places only shape the tree: rows are dealt by place and digest.
FAN = 16
ROUNDS = 2
BLANK = r"[\x20\x09-\x0D]+"
TEXT = ("digest", "sha")


def moved(place: Column, level: int) -> Column:
    """The place after a round: digit ``level`` of ``place`` becomes that of the digest."""
    step = FAN**level
    own = F.expr(f"pmod(digest, {FAN * step}L) div {step}L")
    return place + (own - F.pmod(F.floor(place / step), F.lit(FAN))) * step


def merged(runs: DataFrame, place: str = "place") -> DataFrame:
    """One run per place: each text once, with its first row and its rows; the aggregation sorts by place and digest."""
    return runs.groupBy(place, *TEXT).agg(F.min("first").alias("first"), F.sum("n").alias("n"))


def classes(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept and text_sha256.

    Texts are equal if they are after each stretch of ASCII white space became
    one blank; null is empty. ``keep_id`` is the smallest key of the group, a
    null key being the largest, and ``group_size`` its rows. One row of each
    group is kept; of several rows with the smallest key, the first one read.
    An empty table gives an empty result; other columns are not read.
    """
    shared_dir(docs.sparkSession)
    plain = F.regexp_replace(F.coalesce(F.col(f"`{text}`"), F.lit("")), BLANK, " ")
    rows = (
        docs.select(F.col(f"`{key}`").alias("key"), F.unhex(F.sha2(plain, 256)).alias("sha"))
        .select(
            "key",
            "sha",
            F.xxhash64("sha").alias("digest"),
            F.spark_partition_id().cast("long").alias("part"),
            F.monotonically_increasing_id().alias("row"),
        )
        # Texts are read and hashed once; numbers of partitions and rows stay what they are.
        .checkpoint()
    )
    leaves = merged(
        rows.select("part", *TEXT, F.struct(F.col("key").isNull().alias("none"), "key", "row").alias("first"), F.lit(1).alias("n")), "part"
    )
    levels = [leaves.withColumn("up", moved(F.pmod("part", F.lit(FAN**ROUNDS)), 0))]
    for level in range(1, ROUNDS + 1):
        below = levels[-1].select(F.col("up").alias("place"), *TEXT, "first", "n")
        levels.append(merged(below).withColumn("up", moved(F.col("place"), level) if level < ROUNDS else F.lit(None)))
    settled = levels.pop().select(F.col("place").alias("up"), *TEXT, "first", "n")
    for run in reversed(levels):
        at = "part" if run is levels[0] else "place"
        settled = run.drop("first", "n").join(settled, ["up", *TEXT]).select(F.col(at).alias("up"), *TEXT, "first", "n")
    found = rows.join(settled.withColumnRenamed("up", "part"), ["part", *TEXT])
    return found.select(
        F.col("key").alias(key),
        F.col("first.key").alias("keep_id"),
        F.col("n").cast("long").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
