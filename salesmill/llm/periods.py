"""Maximal repetitions of words inside texts, by merging suffix classes.

Suffixes of a text that share their first words form classes. Going from the
longest shared beginnings to shorter ones, classes are united by union-find,
like the edges of Kruskal's algorithm, and each class keeps its positions in
order. Two positions that become neighbours when classes with ``common`` shared
words are united, at a distance of at most ``common``, begin a repetition whose
period is their distance and which ends ``common`` words after the second one.
No other position of the class lies between them, so no shorter period fits; the
smallest such position of one end and period is where the run starts.

A text is one task's work, everything else stays in Spark: texts are never
shuffled.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import bounded

#: Words of the shortest run.
LEAST = 12
#: Of a run with a period q, the first word and the one q later share this many words at least.
SHARED = LEAST // 2
#: Below this many positions they are put into an ordered list one by one.
FEW = 16
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def paired(ranks: np.ndarray, width: int) -> np.ndarray:
    """Ranks, from 1, of windows made of two: here and ``width`` later; past the end is 0."""
    later = np.zeros(len(ranks), np.int64)
    later[: max(0, len(ranks) - width)] = ranks[width:]
    return np.unique(ranks.astype(np.int64) * (len(ranks) + 1) + later, return_inverse=True)[1].astype(np.int64) + 1


def neighbours(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Suffixes in order and the words each shares with the next; None if no window of ``SHARED`` words occurs twice."""
    levels = [ids.astype(np.int64) + 1]
    for width in (1, 2):
        levels.append(paired(levels[-1], width))
    n, four = len(ids), levels[-1]
    windows = n - SHARED + 1
    if windows < 2 or len(np.unique(four[:windows] * (n + 1) + four[SHARED - 4 :][:windows])) == windows:
        return None
    while levels[-1].max() < n:
        levels.append(paired(levels[-1], 1 << (len(levels) - 1)))
    order = np.argsort(levels[-1])
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        # Equal windows of two places lie inside the text, since one that is cut off occurs once.
        there = np.flatnonzero((a < n) & (b < n))
        same = there[levels[k][a[there]] == levels[k][b[there]]]
        common[same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return order, common


def runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``LEAST`` words, in order."""
    found = neighbours(ids)
    if found is None:
        return []
    order, common = found
    edges = np.flatnonzero(common >= SHARED)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    root = list(range(len(order)))
    # Of a run the first positions share most, so its classes grow at the end of their lists.
    classes = [[p] for p in order.tolist()]
    firsts: dict[tuple[int, int], int] = {}

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for edge, shared in zip(edges.tolist(), common[edges].tolist()):
        x, y = top(edge), top(edge + 1)
        if len(classes[x]) < len(classes[y]):
            x, y = y, x
        large, small = classes[x], classes[y]
        root[y] = x
        classes[y] = []
        for i, p in enumerate(small):
            k = bisect_left(large, p)
            for q, near in (
                (large[k - 1], i == 0 or small[i - 1] < large[k - 1]) if k else (0, False),
                (large[k], i + 1 == len(small) or small[i + 1] > large[k]) if k < len(large) else (0, False),
            ):
                period = abs(p - q)
                if near and period <= shared:
                    at = (shared + max(p, q), period)
                    firsts[at] = min(firsts.get(at, at[0]), p, q)
        if len(small) < FEW:
            for p in small:
                large.insert(bisect_left(large, p), p)
        else:
            large += small
            large.sort()
    return sorted((s, end - s, q) for (end, q), s in firsts.items() if end - s >= LEAST)


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def found(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    reorder: Callable[[int, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """One row per document: key, n_words, runs (start, length, period; in order) and collapsed.

    Words are what lies between ASCII white space. ``collapsed`` is the text
    with single blanks and without the words of a run after its first period.
    ``reorder(key, n)`` may give the word order to read instead of the written
    one; it is not asked for null keys. Null and empty texts have no words and
    no runs; repeated rows are judged one by one; an empty table gives an empty
    result; other columns are not read.
    """
    bounded(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans, left = [], [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = t.as_py().split()
                order = reorder(k, len(words)) if reorder and words and k is not None else None
                if order is not None:
                    words = [words[i] for i in order.tolist()]
                out = runs(numbered(words)) if len(words) >= LEAST else []
                if out:
                    edges = np.zeros(len(words) + 1, np.int64)
                    for start, length, period in out:
                        edges[start + period] += 1
                        edges[start + length] -= 1
                    kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()
                    words, n = [words[i] for i in kept], len(words)
                else:
                    n = len(words)
                counts.append(n)
                spans.append([{"start": s, "length": m, "period": q} for s, m, q in out])
                left.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(spans, RUNS), pa.array(left, pa.binary())],
                ["key", "n_words", "runs", "collapsed"],
            )

    kinds = f"key {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    return rows.mapInArrow(run, kinds).withColumn("collapsed", F.col("collapsed").cast("string")).withColumnRenamed("key", key)
