"""Near-duplicate documents by weighted min-hashing with thrown darts.

A document is the multiset of its five-word runs; a run that stands there w
times is a region of weight w, made of w unit cells. Each cell throws darts as
a random process in its own hash: their heights are arrivals of rate one, each
hits a random coordinate, and a document keeps the lowest dart of each
coordinate. Two documents keep the same dart of a coordinate with the
probability of their weighted Jaccard similarity. A document of total weight W
needs darts up to a height of about k (ln k + 2) / W only, so the cost is that
of reading it, not its weight times the number of coordinates.

Signatures are joined in bands. In each bucket all documents are compared with
one of them, and what is linked that way is a component. Buckets that still
hold several components are searched for candidates between them, signature by
signature inside the tasks; candidates make clusters, and a task gets a cluster
(or two blocks of a large one) with the runs of its documents, verifies the
most similar first, and skips what is connected by then. Pairs of a group are
never written out. What is verified is the runs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmill.session import shared_dir, small_side

from .batches import bounded, whole_groups
from .graph import components
from .hashing import U, mixed, shingles, slices

WIDTH, SIMILAR = 5, 0.8
#: A pair of similarity s shares a band with probability 1 - (1 - s ** ROWS) ** BANDS: at 0.8 all but 3 in a million do.
BANDS, ROWS = 24, 4
#: Equal coordinates, of all, below which a candidate is not verified: five standard deviations below 0.8.
LEAST_EQUAL = 0.59


def cells(text: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every unit cell: the run and which of its occurrences in the text it is."""
    order = np.lexsort((runs, text))
    text, runs = text[order], runs[order]
    n = len(runs)
    if not n:
        return text, runs
    fresh = np.concatenate(([True], (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])))
    starts = np.flatnonzero(fresh)
    nth = np.arange(n) - starts[np.cumsum(fresh) - 1]
    return text, mixed(runs + nth.astype(U) * U(0xD1342543DE82EF95))


def signatures(text: np.ndarray, cell: np.ndarray, n: int, k: int) -> np.ndarray:
    """``n`` rows of the lowest darts of ``k`` coordinates; rows of texts without cells are zero."""
    out = np.zeros((n, k), U)
    weight = np.bincount(text, minlength=n)
    todo = weight > 0
    height = np.zeros(n)
    height[todo] = k * (math.log(k) + 2) / weight[todo]
    while todo.any():
        # All darts below the height of their text, throw after throw of each cell.
        of, at = text[todo[text]], cell[todo[text]]
        rank = np.zeros(len(at))
        spots, ranks, darts = [], [], []
        throw = 0
        while len(at):
            throw += 1
            dart = mixed(at + U(throw * 0xA0761D6478BD642F % 2**64))
            rank = rank - np.log(((dart >> U(11)).astype(np.float64) + 0.5) * 2.0**-53)
            low = rank < height[of]
            of, at, rank, dart = of[low], at[low], rank[low], dart[low]
            name = mixed(dart ^ U(0xE7037ED1A0B428DB))
            spots.append(of * k + (name % U(k)).astype(np.int64))
            ranks.append(rank)
            darts.append(name)
        spot, rank, dart = np.concatenate(spots), np.concatenate(ranks), np.concatenate(darts)
        order = np.lexsort((rank, spot))
        spot, dart = spot[order], dart[order]
        lowest = np.concatenate(([True], spot[1:] != spot[:-1]))
        out.ravel()[spot[lowest]] = dart[lowest]
        # A coordinate without a dart: the same darts and more, up to a greater height.
        missing = np.bincount(spot[lowest] // k, minlength=n) < k
        todo &= missing
        height *= 3
    return out


def _bytes(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode() for t in texts]


def sketches(docs: DataFrame, *, key: str, text: str) -> DataFrame:
    """Per document: key, total weight, two hashes that identify its runs, hashes of its bands, a byte per coordinate."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    salt = mixed(np.arange(1, BANDS * ROWS + 1, dtype=U)) | U(1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = _bytes(batch["text"].tolist())
            for a, b in slices(map(len, raw)):
                n = b - a
                runs, of = shingles(raw[a:b], WIDTH)
                of, cell = cells(of, runs)
                sig = signatures(of, cell, n, BANDS * ROWS)
                bands = mixed((sig * salt).reshape(n, BANDS, ROWS).sum(axis=2, dtype=U) + np.arange(BANDS, dtype=U))
                same = np.zeros((2, n), U)
                np.add.at(same[0], of, mixed(cell))
                np.add.at(same[1], of, mixed(cell ^ U(0x8EBC6AF09C88C6E3)))
                yield pd.DataFrame(
                    {
                        "key": batch["key"].iloc[a:b],
                        "weight": np.bincount(of, minlength=n),
                        "same0": same[0].view(np.int64),
                        "same1": same[1].view(np.int64),
                        "bands": list(bands.view(np.int64)),
                        "sig": [x.tobytes() for x in sig.astype(np.uint8)],
                    }
                )

    return rows.mapInPandas(run, f"key {kind}, weight long, same0 long, same1 long, bands array<long>, sig binary")


def verified(pairs: DataFrame, docs: DataFrame, known: DataFrame, *, key: str, text: str, similarity: float) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) whose weighted Jaccard similarity is at least ``similarity``.

    Hopeless ones go by their weights and signatures; of the rest the runs are
    taken from the texts.
    """
    spark = docs.sparkSession
    kind = known.schema["node"].dataType.simpleString()
    side = lambda s: known.select(F.col("node").alias(f"_{s}"), F.col("weight").alias(f"w{s}"), F.col("sig").alias(f"s{s}"))

    def likely(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, y = (np.frombuffer(b"".join(batch[c]), np.uint8).reshape(len(batch), -1) for c in ("sa", "sb"))
                yield batch.loc[(x == y).mean(axis=1) >= LEAST_EQUAL, ["a", "b"]]

    both = pairs.join(side("a"), F.col("a") == F.col("_a")).join(side("b"), F.col("b") == F.col("_b"))
    both = both.where(F.least("wa", "wb") >= similarity * F.greatest("wa", "wb")).select("a", "b", "sa", "sb")
    likely_pairs = both.mapInPandas(likely, f"a {kind}, b {kind}").checkpoint()
    needed = likely_pairs.select(F.explode(F.array("a", "b")).alias("_n")).distinct()
    sets = cell_sets(docs, needed, key=key, text=text)

    def alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fine = []
            for x, y in zip(batch["ca"], batch["cb"]):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                both = shared_cells(x, y)
                fine.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.loc[np.array(fine, bool), ["a", "b"]]

    bounded(spark)
    joined = (
        likely_pairs.join(sets.select(F.col("n").alias("_a"), F.col("cells").alias("ca")), F.col("a") == F.col("_a"))
        .join(sets.select(F.col("n").alias("_b"), F.col("cells").alias("cb")), F.col("b") == F.col("_b"))
        .select("a", "b", "ca", "cb")
    )
    return joined.mapInPandas(alike, f"a {kind}, b {kind}").checkpoint()


def blocked(rows: DataFrame, group: str, block: int, row_bytes: Column | None = None, block_bytes: int = 0) -> DataFrame:
    """Rows with lo, hi and side, such that every two rows of a group stand together in one (group, lo, hi).

    Groups beyond ``block`` rows, or ``block_bytes`` of their ``row_bytes``, are cut into blocks, and their
    rows repeated for each pair of blocks.
    """
    heavy = F.lit(1) if row_bytes is None else F.ceil(F.sum(row_bytes) / block_bytes)
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / block), heavy).cast("long")
    sizes = rows.groupBy(group).agg(blocks.alias("_blocks")).select(F.col(group).alias("_g"), "_blocks")
    return (
        rows.join(sizes, F.col(group) == F.col("_g"))
        .withColumn("_mine", F.expr("pmod(xxhash64(node), _blocks)"))
        .withColumn("_other", F.explode(F.expr("sequence(0L, _blocks - 1)")))
        .withColumns({"lo": F.least("_mine", "_other"), "hi": F.greatest("_mine", "_other"), "side": F.expr("if(_mine <= _other, 0, 1)")})
        .drop("_g", "_blocks", "_mine", "_other")
    )


#: Rows of a block, and buckets up to which size are searched many at a time.
BLOCK, SMALL = 1024, 48
#: Bytes of cells in a block of a cluster, eight for each; a document with more is a block's worth by itself.
BLOCK_BYTES = 1 << 26


def _pairs(rows: pd.DataFrame, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates (i, j) between components of one group, and their equal coordinates: enough, and weights alike."""
    sig = np.frombuffer(b"".join(rows["sig"]), np.uint8).reshape(len(rows), -1)
    weight, root, side = rows["weight"].to_numpy(), pd.factorize(rows["root"])[0], rows["side"].to_numpy()
    cross = rows["lo"].iloc[0] != rows["hi"].iloc[0]
    least = int(np.ceil(LEAST_EQUAL * sig.shape[1]))
    out = []
    for i in range(len(rows) - 1):
        j = np.arange(i + 1, len(rows))
        fine = (root[j] != root[i]) & (np.minimum(weight[j], weight[i]) >= similarity * np.maximum(weight[j], weight[i]))
        j = j[fine & (side[j] != side[i])] if cross else j[fine]
        if len(j):
            equal = (sig[j] == sig[i]).sum(axis=1)
            enough = equal >= least
            out.append((np.full(int(enough.sum()), i), j[enough], equal[enough]))
    return tuple(np.concatenate([x[k] for x in out]) if out else np.zeros(0, np.int64) for k in range(3))


class Joined:
    """Sets of rows that grow together."""

    def __init__(self, of: np.ndarray):
        self.up = np.unique(of, return_index=True)[1][np.unique(of, return_inverse=True)[1]].tolist()

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def candidates(open_rows: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) that connect what candidates connect, for rows (bucket, node, root, weight, sig)."""
    kind = open_rows.schema["node"].dataType.simpleString()

    def small(rows: pd.DataFrame) -> pd.DataFrame:
        bucket, root, weight = rows["bucket"].to_numpy(), pd.factorize(rows["root"])[0], rows["weight"].to_numpy()
        sig, node = np.frombuffer(b"".join(rows["sig"]), np.uint8).reshape(len(rows), -1), rows["node"].to_numpy()
        found = []
        for k in range(1, SMALL):
            i = np.flatnonzero(bucket[:-k] == bucket[k:])
            if not len(i):
                break
            a, b = weight[i], weight[i + k]
            i = i[(root[i] != root[i + k]) & (np.minimum(a, b) >= similarity * np.maximum(a, b))]
            i = i[(sig[i] == sig[i + k]).mean(axis=1) >= LEAST_EQUAL]
            found.append((i, i + k))
        i, j = (np.concatenate([x[s] for x in found]) if found else np.zeros(0, np.int64) for s in (0, 1))
        return pd.DataFrame({"a": node[i], "b": node[j]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, ["bucket", "lo", "hi"]):
            marks = rows[["bucket", "lo", "hi"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(axis=1)])
            sizes = np.diff(np.r_[starts, len(rows)])
            few = (sizes <= SMALL) & (marks[starts, 1] == marks[starts, 2])
            part = rows[np.repeat(few, sizes)]
            if len(part):
                yield small(part)
            for a, n in zip(starts[~few], sizes[~few]):
                part = rows.iloc[a : a + n]
                node, sets = part["node"].to_numpy(), Joined(np.arange(n))
                i, j, _ = _pairs(part, similarity)
                kept = [k for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())) if sets.join(x, y)]
                yield pd.DataFrame({"a": node[i[kept]], "b": node[j[kept]]})

    spread = blocked(open_rows, "bucket", BLOCK).repartition(F.xxhash64("bucket", "lo", "hi"))
    return spread.sortWithinPartitions("bucket", "lo", "hi", "node").mapInPandas(run, f"a {kind}, b {kind}")


def shared_cells(x: np.ndarray, y: np.ndarray) -> int:
    """Number of equal values of two ascending arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def linked_clusters(rows: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that connect what is linked, for rows (cluster, node, root, weight, sig, cells)."""
    kind = rows.schema["node"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in whole_groups(batches, ["cluster", "lo", "hi"]):
            for _, part in group.groupby(["cluster", "lo", "hi"], sort=False):
                node, sets = part["node"].to_numpy(), Joined(pd.factorize(part["root"])[0])
                cells_of = [np.frombuffer(c, U) for c in part["cells"]]
                i, j, equal = _pairs(part, similarity)
                order = np.argsort(-equal, kind="stable")
                found = []
                for a, b in zip(i[order].tolist(), j[order].tolist()):
                    if sets.find(a) != sets.find(b):
                        x, y = cells_of[a], cells_of[b]
                        both = shared_cells(x, y)
                        if both >= similarity * (len(x) + len(y) - both):
                            sets.join(a, b)
                            found.append((node[a], node[b]))
                if found:
                    yield pd.DataFrame(found, columns=["a", "b"])

    spread = blocked(rows, "cluster", BLOCK, F.col("weight") * 8, BLOCK_BYTES).repartition(F.xxhash64("cluster", "lo", "hi"))
    return spread.sortWithinPartitions("cluster", "lo", "hi", "node").mapInPandas(run, f"a {kind}, b {kind}")


def cell_sets(docs: DataFrame, needed: DataFrame, *, key: str, text: str) -> DataFrame:
    """(n, cells): the sorted cells of the documents whose key is a ``_n`` of ``needed``.

    Texts stay where they are read as long as the keys are few enough to go to
    them (a measured size); beyond that both are shuffled.
    """
    kind = docs.schema[key].dataType.simpleString()

    def taken(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = _bytes(batch["text"].tolist())
            for a, b in slices(map(len, raw)):
                runs, of = shingles(raw[a:b], WIDTH)
                of, cell = cells(of, runs)
                cell = cell[np.lexsort((cell, of))]
                ends = np.searchsorted(of, np.arange(b - a + 1))
                yield pd.DataFrame({"n": batch["n"].iloc[a:b], "cells": [cell[i:j].tobytes() for i, j in zip(ends, ends[1:])]})

    texts = docs.select(F.col(f"`{key}`").alias("n"), F.col(f"`{text}`").alias("text"))
    return texts.join(small_side(needed), F.col("n") == F.col("_n"), "left_semi").mapInPandas(taken, f"n {kind}, cells binary")


def classes(docs: DataFrame, *, key: str = "doc_id", text: str = "text", similarity: float = SIMILAR) -> DataFrame:
    """One row per document: its key, class_id (smallest key of its group) and kept (that key is its own).

    Documents are near-duplicates if their weighted Jaccard similarity over
    five-word runs is at least ``similarity``; groups are what links reach. A
    text of one to four words is one run. Documents without a word (null,
    empty, blank) and those with a null key are groups of their own. Rows with
    the same key are one document; an empty table gives an empty result; other
    columns are not read. Long texts are hashed as a whole, and clusters of them
    are verified in blocks of bounded bytes.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    bounded(spark)
    every = sketches(docs, key=key, text=text).checkpoint()
    worded = every.where("weight > 0 and key is not null")
    # Equal multisets of runs are one node; of these only the smallest key goes on.
    nodes = (
        worded.groupBy("same0", "same1", "weight")
        .agg(F.min("key").alias("node"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
        .checkpoint()
    )
    known = nodes.select("node", "weight", "sig")
    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    full = entries.groupBy("bucket").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = entries.join(full.select(F.col("bucket").alias("_b"), "first"), F.col("bucket") == F.col("_b")).select("bucket", "node", "first").checkpoint()
    stars = met.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = verified(stars, docs, known, key=key, text=text, similarity=similarity)
    roots = components(links).select(F.col("node").alias("_n"), "root")
    described = known.join(roots, F.col("node") == F.col("_n"), "left").select("node", "weight", "sig", F.coalesce("root", "node").alias("root")).checkpoint()
    # Buckets that still hold several components are searched for what may link these.
    placed = met.select("bucket", F.col("node").alias("_m")).join(described, F.col("node") == F.col("_m")).drop("_m").checkpoint()
    several = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select(F.col("bucket").alias("_b"))
    open_rows = placed.join(several, F.col("bucket") == F.col("_b"), "left_semi")
    clusters = components(candidates(open_rows, similarity).distinct().checkpoint()).select(F.col("node").alias("_n"), F.col("root").alias("cluster")).checkpoint()
    sets = cell_sets(docs, clusters.select("_n"), key=key, text=text)
    rows = described.join(clusters, F.col("node") == F.col("_n")).drop("_n").join(sets, F.col("node") == F.col("n")).drop("n")
    more = linked_clusters(rows, similarity).checkpoint()
    roots = components(links.unionByName(more)).select(F.col("node").alias("_n"), "root")
    named = nodes.join(roots, F.col("node") == F.col("_n"), "left").select("same0", "same1", "weight", F.coalesce("root", "node").alias("class_id"))
    named = named.withColumnsRenamed({"same0": "_0", "same1": "_1", "weight": "_w"})
    out = worded.join(named, (F.col("same0") == F.col("_0")) & (F.col("same1") == F.col("_1")) & (F.col("weight") == F.col("_w"))).select("key", "class_id")
    alone = every.where("weight = 0 or key is null").select("key", F.col("key").alias("class_id"))
    return out.unionByName(alone).select(F.col("key").alias(key), "class_id", F.col("key").eqNullSafe(F.col("class_id")).alias("kept"))
