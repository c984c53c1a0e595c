"""Packing: pieces against the other tokenizer library, sequences against their contract."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesmill.llm import packing
from salesmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, size):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for seq in by.values():
        seq.sort()
        at = 0
        for offset, length in seq:
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def best_fit(lengths, size):
    """Sequences that best fit of sorted lengths takes, one by one."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(size - n)
    return len(gaps)


def test_every_document(spark):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op3_best_fit_packing"](spark, SF).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert len(by) == len(docs)
    for d in docs:
        ids = [*model.encode(d.text or "", add_special_tokens=False).ids, 0]
        got = sorted(by[d.doc_id], key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(len(got)))
        assert sum(r.length for r in got) == len(ids) and all(r.length == 2048 for r in got[1:])
        at = 0
        for r in got:
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert len(got) == -(-len(ids) // 2048)
    bins = check(rows, 2048)
    assert bins <= -(-sum(r.length for r in rows) // 2048) * 1.005 + 1


@pytest.mark.parametrize("seed", range(8))
def test_plans_use_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    size = 64
    counts = np.zeros(size + 1, np.int64)
    for n in rng.integers(1, size + 1, rng.integers(1, 400)):
        counts[n] += rng.integers(1, 50) if seed % 2 else 1
    fillings = packing.plan(counts, size)
    used = Counter()
    for filling, times in fillings:
        assert times > 0 and sum(n * k for n, k in filling) <= size
        for n, k in filling:
            used[n] += k * times
    assert all(used[n] == counts[n] for n in range(size + 1))
    slots = packing.places(fillings)
    for n in set(used):
        mine = sorted((a, b) for m, a, b, *_ in slots if m == n)
        assert mine[0][0] == 0 and mine[-1][1] == used[n] and all(x[1] == y[0] for x, y in zip(mine, mine[1:]))


def test_a_pair_replaces_the_smallest():
    counts = np.zeros(11, np.int64)
    for n in (6, 3, 2, 2):
        counts[n] += 1
    # Greedy: 6 + 3, then 2 + 2. The pair 2 + 2 fills the gap that 3 leaves.
    assert packing.plan(counts, 10)[0] == ([(6, 1), (2, 2)], 1)


def test_odd_rows(spark):
    rng = random.Random(1)
    texts = [None, "", "same", "same", "x " * 9000, "<|endoftext|>", *[" ".join(["ab"] * rng.randint(0, 60)) for _ in range(200)]]
    df = spark.createDataFrame([(7 if t == "same" else i, t, "u") for i, t in enumerate(texts)], "doc_id long, text string, length string")
    pieces = packing.cut(df, PATH, size=64, ids=True)
    rows = packing.packed(pieces, size=64).collect()
    bins = check(rows, 64)
    assert bins <= best_fit([r.length for r in rows], 64)
    assert sum(r.length == 1 for r in rows if r.doc_id in (0, 1)) == 2
    assert all(len(r.ids) == r.length for r in rows)
    assert next(r for r in rows if r.doc_id == 5).ids == [50256, 0]
    empty = packing.packed(packing.cut(df.limit(0), PATH, size=64), size=64)
    assert empty.count() == 0


def test_one_length_is_packed_whole(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(30).cast("long").alias("length"))
    rows = packing.packed(df, size=64).collect()
    assert check(rows, 64) == 2500 and len(rows) == 5000


def test_runs_of_any_length(spark):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n = 2_000_000
    texts = ["one" + " " * n + "two", "one" + "\n" * n + "two", "a" * n]
    texts += [texts[0] + " <|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext|", "x<|endoftext|>\n\n y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    by = defaultdict(list)
    for r in packing.cut(df, PATH, size=2048).collect():
        by[r.doc_id].append(r)
    assert model.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    for i, t in enumerate(texts):
        ids = np.array([*model.encode(t, add_special_tokens=False).ids, 0], "<u4")
        got = sorted(by[i], key=lambda r: r.piece)
        assert sum(r.length for r in got) == len(ids)
        for r in got:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
