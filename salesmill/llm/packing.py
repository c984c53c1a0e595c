"""Best-two-fit packing of documents into sequences of fixed length.

Only the numbers of pieces of each length matter for packing, and there are no
more lengths than tokens in a sequence. So the plan is made from that histogram
alone, which is as small for any corpus, and says how often each filling of a
sequence occurs; pieces of a length are then numbered in parallel and dealt to
the places the plan has for their length.

A sequence is filled greedily, the longest piece that fits first. Then its
smallest piece gives way to two unpacked ones, if a pair fits the gap it leaves
more tightly.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmill.session import shared_dir

from .batches import bounded

END = 0
#: Shares of the pieces of one length that are numbered by themselves.
CELLS = 1024


@lru_cache
def tokenizer(path: str) -> tokenizers.Tokenizer:
    """The tokenizer of a file, as it is."""
    return tokenizers.Tokenizer.from_file(path)


@lru_cache
def added(path: str) -> tuple[str, ...]:
    """Strings that the tokenizer takes out of a text before anything else."""
    return tuple(t.content for t in tokenizer(path).get_added_tokens_decoder().values())


@lru_cache
def quick(path: str) -> tiktoken.Encoding | None:
    """The same byte-level pairs from the ``.tiktoken`` file beside the tokenizer's, where there is one."""
    ranks = Path(path).with_suffix(".tiktoken")
    if not ranks.exists():
        return None
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.read_bytes().splitlines())}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def encoded(text: str, path: str) -> np.ndarray:
    """Ids that the tokenizer gives a text, without special tokens around it.

    The quick encoding gives the same ids four times as fast, for texts that
    hold no added token; its regex engine gives up on runs of about a million
    characters. Both kinds of text go to the tokenizer itself.
    """
    fast = quick(path)
    if fast is not None and not any(t in text for t in added(path)):
        try:
            return fast.encode_to_numpy(text, disallowed_special=())
        except ValueError:
            pass
    return np.array(tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4")


def cut(docs: DataFrame, path: str, *, size: int, key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """Pieces of all documents: key, piece, start, length, ids_crc32 and, if asked for, ids.

    A document is its tokens by the tokenizer at ``path`` and then id 0. One that is longer than ``size`` is
    cut so that all pieces but the first are full. A null text is empty, and so
    one token; repeated rows are cut one by one.
    """
    bounded(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, t in zip(batch["key"], batch["text"]):
                found = np.append(encoded(t or "", path), END).astype("<u4")
                first = len(found) % size or size
                edges = [0, *range(min(first, len(found)), len(found) + 1, size)]
                for i, (a, b) in enumerate(zip(edges, edges[1:])):
                    row = (k, i, a, b - a, zlib.crc32(found[a:b].tobytes()))
                    out.append((*row, found[a:b].tolist()) if ids else row)
            yield pd.DataFrame(out, columns=names)

    names = ["key", "piece", "start", "length", "ids_crc32", *["ids"] * ids]
    kinds = f"key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * ids
    return rows.mapInPandas(run, kinds).withColumnRenamed("key", key)


def plan(counts: np.ndarray, size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Fillings of a sequence as ([(length, pieces)...], sequences), until no piece is left.

    ``counts[n]`` is the number of pieces of length n, from 0 (none) to ``size``.
    """
    left = counts.astype(np.int64).copy()
    lengths = np.arange(size + 1)
    fillings = []
    while left.any():
        used = np.zeros(size + 1, np.int64)
        gap = size
        while True:
            # The longest that fits, as often as it fits and lasts.
            fit = np.flatnonzero(left[: gap + 1] - used[: gap + 1] > 0)
            if not len(fit):
                break
            n = int(fit[-1])
            times = int(min(left[n] - used[n], gap // n))
            used[n] += times
            gap -= n * times
        small = int(np.flatnonzero(used)[0])
        if gap:
            # Longest partner of each length within the widened gap, by a running maximum.
            free = left - used
            room = gap + small
            there = np.where(free > 0, lengths, 0)
            longest = np.maximum.accumulate(there)
            a = np.flatnonzero(free[: room] > 0)
            if len(a):
                b = longest[room - a]
                single = (b == a) & (free[a] < 2)
                if single.any():
                    below = np.concatenate(([0], longest[:-1]))
                    b = np.where(single, below[np.minimum(a, room - a)], b)
                total = np.where(b > 0, a + b, 0)
                best = int(np.argmax(total))
                if total[best] > small:
                    used[small] -= 1
                    used[a[best]] += 1
                    used[b[best]] += 1
        held = np.flatnonzero(used)
        times = int((left[held] // used[held]).min())
        left[held] -= used[held] * times
        fillings.append(([(int(n), int(used[n])) for n in held[::-1]], times))
    return fillings


def places(fillings: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, from, to, each, sequence, offset): pieces numbered ``from`` up to ``to`` of a length
    go ``each`` to a sequence, from ``sequence`` on, the first at ``offset``."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for filling, times in fillings:
        offset = 0
        for n, each in filling:
            start = taken.get(n, 0)
            rows.append((n, start, start + each * times, each, sequence, offset))
            taken[n] = start + each * times
            offset += n * each
        sequence += times
    return rows


def packed(pieces: DataFrame, *, size: int, key: str = "doc_id") -> DataFrame:
    """``pieces`` with sequence_id and offset; lengths are from 1 to ``size``.

    Equal lengths are told apart by key, piece and the other columns, so ties
    and repeated rows get a place each; no piece gives no row. Only the
    histogram of lengths, ``size`` rows at most, passes through the driver.
    """
    spark = pieces.sparkSession
    shared_dir(spark)
    own = pieces.columns
    rows = pieces.checkpoint()  # numbering and histogram must see the same pieces, tokenized once
    rows = rows.withColumn("_cell", F.pmod(F.xxhash64(f"`{key}`", "piece"), F.lit(CELLS)))
    cells = rows.groupBy("length", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    counts = np.zeros(size + 1, np.int64)
    for r in cells.groupBy("length").agg(F.sum("_n").alias("n")).collect():  # at most ``size`` rows
        counts[r["length"]] = r["n"]
    before = cells.select(
        F.col("length").alias("_l"),
        F.col("_cell").alias("_c"),
        (F.sum("_n").over(Window.partitionBy("length").orderBy("_cell")) - F.col("_n")).alias("_before"),
    )
    number = F.row_number().over(Window.partitionBy("length", "_cell").orderBy(*[F.col(f"`{c}`") for c in own if c != "ids"]))
    numbered = (
        rows.withColumn("_i", number)
        .join(before, (F.col("length") == F.col("_l")) & (F.col("_cell") == F.col("_c")))
        .withColumn("_i", F.col("_before") + F.col("_i") - 1)
    )
    # As many rows as fillings times the lengths in each, both bounded by ``size`` alone.
    table = spark.createDataFrame(
        places(plan(counts, size)), "_n long, _from long, _to long, _each long, _seq long, _off long"
    )
    found = numbered.join(
        F.broadcast(table), (F.col("length") == F.col("_n")) & (F.col("_i") >= F.col("_from")) & (F.col("_i") < F.col("_to"))
    )
    return found.select(
        *[F.col(f"`{c}`") for c in own],
        F.expr("_seq + (_i - _from) div _each").alias("sequence_id"),
        F.expr("_off + ((_i - _from) % _each) * length").alias("offset"),
    )
