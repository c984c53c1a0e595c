"""Connected components by stars, as joins and aggregations."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmill.session import shared_dir

#: Edges that one task works on in a round.
EDGES = 250_000


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reachable.

    Every round hangs the larger neighbours of a node, then the smaller ones,
    on the smallest, which shortens all paths at once; it ends when nothing
    moves, after a number of rounds near the logarithm of the longest path.
    Edges are never gathered by node: the smallest neighbour is a map-side
    aggregate, and the join back splits hot nodes. Self-loops and repeated
    edges do no harm, edges with a null end are left out.
    """
    shared_dir(edges.sparkSession)
    large, small = F.greatest("a", "b"), F.least("a", "b")
    now = edges.where("a is not null and b is not null and a <> b").select(large.alias("a"), small.alias("b")).distinct().checkpoint()
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).where("node is not null").distinct()
    # As many tasks as the edges need: rounds are many, and edges never become more.
    parts = math.ceil(max(1, now.count()) / EDGES)
    now, state = now.coalesce(parts), None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        hung = both.join(least, F.col("a") == F.col("n")).where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        hung = hung.coalesce(parts).distinct().coalesce(parts).checkpoint()
        down = hung.groupBy("a").agg(F.min("b").alias("m"))
        moved = hung.join(down.withColumnRenamed("a", "n"), F.col("a") == F.col("n")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = moved.unionByName(down.select("a", F.col("m").alias("b"))).coalesce(parts).distinct().coalesce(parts).checkpoint()
        before, state = state, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == state:
            break
    root = now.select(F.col("a").alias("n"), F.col("b").alias("root"))
    return nodes.join(root, F.col("node") == F.col("n"), "left").select("node", F.coalesce("root", "node").alias("root"))
