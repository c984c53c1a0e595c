"""Near-duplicate vectors through an index of pivot permutations.

A vector is described by which pivots are nearest to it. Pivots come from a
bounded sample of the vectors themselves, and none is close to another, else a
dense group would hold many and its members disagree on the nearest. Their number
grows with that of the vectors, so that a vector meets about as many unrelated ones
in a large table as in a small one. The index is inverted: every vector stands in
the list of each set of ``shared`` pivots among its ``nearest``, so two vectors
meet in some list exactly if they have that many near pivots in common, and
unrelated vectors hardly ever do. What meets is verified by cosine in double
precision, and a pair counts in the first of its common lists only.

Vectors that are equal are one node of the index with a number of copies. Lists
beyond ``block`` rows are cut into blocks, and tasks compare blocks by blocks,
so that none holds a hot list as a whole. Links are counted and joined to
components where they are found; they are never written out as pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmill.session import shared_dir

from .batches import bounded, whole_groups
from .graph import components

#: Vectors that serve as pivots at least, for each number of components, and up to how many vectors that is enough.
PIVOTS, ENOUGH = 512, 5000
#: Beyond, pivots grow with this power of the number of vectors: of p pivots, unrelated vectors share three
#: near ones with a probability of about p ** -2.3 (512 to 4000 random ones in 64 dimensions).
GROWTH = 0.44
#: Vectors drawn to choose pivots from, at least and for each pivot, and the largest cosine between two pivots.
DRAWN, FOR_EACH, APART = 4096, 3, 0.5
NEAREST, SHARED = 8, 3
BLOCK = 2048
#: Lists up to this size are compared many at a time.
SMALL = 48


def pivots_for(vectors: int, least: int = PIVOTS) -> int:
    """How many pivots a table of so many vectors gets."""
    return max(least, math.ceil(least * (vectors / ENOUGH) ** GROWTH))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def spread(drawn: np.ndarray, pivots: int) -> np.ndarray:
    """Up to ``pivots`` of the drawn unit vectors, each apart from those before it."""
    closest = np.full(len(drawn), -1.0)
    chosen = []
    for i in range(len(drawn)):
        if closest[i] <= APART:
            chosen.append(i)
            if len(chosen) == pivots:
                break
            closest = np.maximum(closest, drawn @ drawn[i])
    return drawn[chosen]


def near(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """For each row the numbers of its nearest pivots, ascending; of equally near ones the first."""
    far = -(unit(vectors) @ pivots.T)
    nearest = min(nearest, far.shape[1])
    # All pivots as near as the last of the nearest, then the first of these.
    last = np.partition(far, nearest - 1, axis=1)[:, nearest - 1 : nearest]
    rank = np.where(far < last, 0, np.where(far == last, 1, 2)).astype(np.int8)
    return np.sort(np.argsort(rank, axis=1, kind="stable")[:, :nearest], axis=1)


def first_shared(a: np.ndarray, b: np.ndarray, shared: int) -> np.ndarray:
    """For pairs of pivot lists, which of ``a`` are the first ``shared`` common ones (as places in ``a``)."""
    common = (a[:, :, None] == b[:, None, :]).any(axis=2)
    return np.argsort(~common, axis=1, kind="stable")[:, :shared]


def small_lists(cell: np.ndarray, sets: np.ndarray, x: np.ndarray, pivots: np.ndarray, threshold: float):
    """Pairs of rows in the same list, all lists at once, by shifts of the sorted rows."""
    found = []
    for k in range(1, SMALL):
        i = np.flatnonzero(cell[:-k] == cell[k:])
        if not len(i):
            break
        i = i[np.einsum("ij,ij->i", x[i], x[i + k]) >= threshold]
        if len(i):
            at = first_shared(pivots[i], pivots[i + k], sets.shape[1])
            first = np.take_along_axis(pivots[i], at, axis=1)
            i = i[(first == sets[i]).all(axis=1)]
            found.append(np.stack([i, i + k]))
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


def large_list(side: np.ndarray, cross: bool, pivot_set: np.ndarray, x: np.ndarray, pivots: np.ndarray, threshold: float):
    """Matrix of the links that count in a large list; across sides only if ``cross``."""
    links = np.zeros((len(x), len(x)), bool)
    for a in range(0, len(x), 256):
        links[a : a + 256] = x[a : a + 256] @ x.T >= threshold
    # A pair's first list is this one unless it shares a pivot before the last one of the set.
    row, place = np.nonzero((pivots < pivot_set[-1]) & ~np.isin(pivots, pivot_set))
    pivot = pivots[row, place]
    by_pivot = np.argsort(pivot, kind="stable")
    for rows in np.split(row[by_pivot], np.flatnonzero(np.diff(pivot[by_pivot])) + 1):
        if len(rows) > 1:
            links[np.ix_(rows, rows)] = False
    if cross:
        links &= side[:, None] != side[None, :]
    np.fill_diagonal(links, False)
    return links | links.T


def forest(links: np.ndarray) -> np.ndarray:
    """For each row the first row of its component."""
    root = np.full(len(links), -1)
    for i in range(len(links)):
        if root[i] < 0:
            front = np.array([i])
            while len(front):
                root[front] = i
                front = np.flatnonzero(links[front].any(axis=0) & (root < 0))
    return root


def linked(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.95,
    pivots: int = PIVOTS,
    nearest: int = NEAREST,
    shared: int = SHARED,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: its key, n_links and component_id (the smallest key reachable, itself included).

    Vectors of different lengths do not link. Vectors that are null, empty,
    zero or hold null or non-finite components, and those with a null key, link
    with nothing. ``pivots`` is the number for small tables (see ``pivots_for``). Rows with the same key are the same node for components;
    repeated rows are copies that link. An empty table gives an empty result;
    other columns are not read.
    """
    spark = vectors.sparkSession
    shared_dir(spark)
    bounded(spark, 4096)
    rows = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("v"))
    kind = rows.schema["key"].dataType.simpleString()
    numeric = rows.schema["v"].dataType.simpleString()
    sound = (
        "key is not null and v is not null and size(v) > 0 and exists(v, x -> x <> 0)"
        " and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    )
    members = rows.where(sound).withColumn("h", F.xxhash64("v"))
    # One node for equal vectors, under the smallest key.
    nodes = members.groupBy("h", "v").agg(F.min("key").alias("node"), F.count(F.lit(1)).alias("copies")).checkpoint()
    sample: dict[int, np.ndarray] = {}
    base = 1  # above the number of any pivot
    for r in nodes.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).collect():  # lengths that occur, as a rule one
        want = pivots_for(r["rows"], pivots)
        drawn = nodes.where(F.size("v") == r["n"]).orderBy("h", "node").limit(max(DRAWN, FOR_EACH * want)).select("v").collect()
        sample[r["n"]] = spread(unit(np.array([x["v"] for x in drawn], np.float64)), want)
        base = max(base, len(sample[r["n"]]) + 1)
    if base**shared >= 1 << 63:
        raise ValueError("too many pivots for sets of this size: share fewer")

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["v"].map(len)
            for n in sizes.unique():
                part = batch[sizes == n]
                close = near(np.array(part["v"].tolist(), np.float64), sample[n], nearest)
                yield pd.DataFrame({"node": part["node"].tolist(), "n": int(n), "copies": part["copies"].tolist(), "v": part["v"].tolist(), "near": list(close.astype(np.int32))})

    known = nodes.select("node", "copies", "v").mapInPandas(described, f"node {kind}, n int, copies long, v {numeric}, near array<int>").checkpoint()

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for width, part in batch.groupby(batch["near"].map(len)):
                close = np.array(part["near"].tolist(), np.int64)
                picks = np.array(list(combinations(range(width), min(shared, width))))
                codes = np.zeros((len(close), len(picks)), np.int64)
                for c in range(picks.shape[1]):
                    codes = codes * base + close[:, picks[:, c]] + 1
                yield pd.DataFrame({"node": np.repeat(part["node"].to_numpy(), len(picks)), "n": np.repeat(part["n"].to_numpy(), len(picks)), "code": codes.ravel()})

    entries = known.select("node", "n", "near").mapInPandas(listed, f"node {kind}, n int, code long")
    sizes = entries.groupBy("n", "code").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select(F.col("n").alias("_n"), F.col("code").alias("_c"), "size")
    met = entries.join(sizes, (F.col("n") == F.col("_n")) & (F.col("code") == F.col("_c")))
    # A list of several blocks is compared block by block; every row is with each other block once.
    met = (
        met.withColumn("_blocks", F.expr(f"(size + {block - 1}) div {block}"))
        .withColumn("_mine", F.expr("pmod(xxhash64(node), _blocks)"))
        .withColumn("_other", F.explode(F.expr("sequence(0L, _blocks - 1)")))
        .select("node", "n", "code", F.least("_mine", "_other").alias("lo"), F.greatest("_mine", "_other").alias("hi"), F.expr("if(_mine <= _other, 0, 1)").alias("side"))
    )
    full = met.join(known.select(F.col("node").alias("_k"), "copies", "v", "near"), F.col("node") == F.col("_k")).drop("_k")
    full = full.withColumn("cell", F.xxhash64("n", "code", "lo", "hi")).repartition("cell").sortWithinPartitions("cell", "n", "code", "lo", "hi", "node")

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, ["n", "code", "lo", "hi"]):
            yield from verified(rows)

    def verified(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Whole lists: per node the copies it links with here, and a node of its component."""
        marks = rows[["n", "code", "lo", "hi"]].to_numpy()
        starts = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(axis=1)])
        ends = np.r_[starts[1:], len(rows)]
        small = (ends - starts <= SMALL) & (marks[starts, 2] == marks[starts, 3])
        cell = np.repeat(np.arange(len(starts)), ends - starts)
        for n in np.unique(marks[starts, 0]):
            mine = small & (marks[starts, 0] == n)
            part = rows[np.repeat(mine, ends - starts)]
            if len(part):
                yield from small_part(part, cell[part.index - rows.index[0]])
        for a, b in zip(starts[~small], ends[~small]):
            yield from large_part(rows.iloc[a:b])

    def columns(part: pd.DataFrame):
        close = np.array(part["near"].tolist(), np.int64)
        codes, sets = part["code"].to_numpy().copy(), []
        while codes.any():
            sets.append(codes % base - 1)
            codes //= base
        return np.stack(sets[::-1], axis=1), unit(np.array(part["v"].tolist(), np.float64)), close

    def small_part(part: pd.DataFrame, cell: np.ndarray) -> Iterator[pd.DataFrame]:
        sets, x, close = columns(part)
        i, j = small_lists(cell, sets, x, close, threshold)
        node, copies = part["node"].to_numpy(), part["copies"].to_numpy()
        yield pd.DataFrame({"node": np.r_[node[i], node[j]], "links": np.r_[copies[j], copies[i]], "other": np.r_[node[j], node[i]]})

    def large_part(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        sets, x, close = columns(part)
        cross = part["lo"].iloc[0] != part["hi"].iloc[0]
        links = large_list(part["side"].to_numpy(), cross, sets[0], x, close, threshold)
        node = part["node"].to_numpy()
        count = links.astype(np.float64) @ part["copies"].to_numpy().astype(np.float64)
        keep = count > 0
        yield pd.DataFrame({"node": node[keep], "links": count[keep].astype(np.int64), "other": node[forest(links)][keep]})

    found = full.mapInPandas(compared, f"node {kind}, links long, other {kind}").checkpoint()
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    result = (
        nodes.select("h", "v", "node", "copies")
        .join(links.select(F.col("node").alias("_k"), "links"), F.col("node") == F.col("_k"), "left")
        .drop("_k")
        .join(roots.select(F.col("node").alias("_k"), "root"), F.col("node") == F.col("_k"), "left")
        .select(F.col("node").alias("_node"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    )
    # Members find their node by the smallest key of their vector, not by the vector.
    own = members.select("h", "v", "key").join(nodes.select(F.col("h").alias("_h"), F.col("v").alias("_v"), F.col("node").alias("_m")), (F.col("h") == F.col("_h")) & (F.col("v") == F.col("_v")))
    sound_rows = own.select("key", "_m").join(result, F.col("_m") == F.col("_node")).select("key", "n_links", "component_id")
    unsound = rows.where(f"not coalesce({sound}, false)").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return sound_rows.unionByName(unsound).withColumnRenamed("key", key)
