"""Repeated passages against looking up every window."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmill.llm import repeats
from salesmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(data, length=50):
    """data: (key, bytes); rows of the same key are one document."""
    first = {}
    for k, raw in data:
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            first[w] = min(first.get(w, k), k)
    out = []
    for k, raw in data:
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if first[raw[p : p + length]] < k:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((k, len(raw), sum(gone), spans, kept))
    return out


def test_every_document(spark):
    data = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = sorted((k, n, g, s, hashlib.sha256(t).hexdigest()) for k, n, g, s, t in brute(data))
    got = QUERIES["op1_suffix_array_dedup"](spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect())) == want


def passages(rng):
    line = "this line stands in very many documents, whatever stands around it, é ö ü. "
    blocks = ["".join(rng.choices("abcdefgh ", k=rng.randint(30, 160))) for _ in range(40)]
    texts = []
    for i in range(260):
        t = "".join(rng.choices("abcdefgh é", k=rng.randint(0, 90)))
        for _ in range(rng.randint(0, 3)):
            t += rng.choice(blocks) + "".join(rng.choices("xyz ", k=rng.randint(0, 60)))
        if i % 3 == 0:
            t = t[:20] + line + t[20:]
        texts.append(t)
    texts += texts[:30] + ["a" * 700, "a" * 60, "a" * 50, "a" * 49, "ab" * 300, "", None, "same " * 400, "x" + "same " * 400]
    return texts


@pytest.mark.parametrize("hot", [3, 1000])
def test_passages(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "CHUNK", 4000)
    monkeypatch.setattr(repeats, "PACKET", 1)
    rng = random.Random(hot)
    texts = passages(rng)
    rng.shuffle(texts)
    data = [(i * 7 % 1009 - 300, t) for i, t in enumerate(texts)] + [(5000, texts[3]), (5000, texts[3]), (None, texts[5] or "z" * 80), (None, None)]
    df = spark.createDataFrame([(k, t, "s") for k, t in data], "doc_id long, text string, source string")
    got = repeats.cleaned(df, keep=("source",), hot=hot).collect()
    want = brute([(repeats.LAST if k is None else k, (t or "").encode()) for k, t in data])
    mine = sorted((repeats.LAST if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got)
    assert mine == sorted(want)
    assert {r.source for r in got} == {"s"}


def test_a_copy_takes_no_other_text_of_its_key(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 200)
    monkeypatch.setattr(repeats, "PACKET", 1)
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefgh ", k=120)) for _ in range(60)]
    data = [(1, texts[0]), (2, texts[1]), (7, texts[0]), (7, texts[2]), (7, texts[3] + texts[1]), (None, texts[1]), (None, texts[1])]
    data += [(None, t) for t in texts[4:]]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = repeats.cleaned(df).collect()
    want = brute([(repeats.LAST if k is None else k, t.encode()) for k, t in data])
    assert sorted((repeats.LAST if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(want)
    assert {bytes(r.kept).decode() for r in got if r.doc_id is None} == {"", *texts[4:]}


def test_characters_stay_whole(spark):
    a = "é" * 40
    df = spark.createDataFrame([(1, "x" + a + "tail"), (2, "€" + a + "end"), (3, "à" + "é" * 40)], "doc_id int, text string")
    for r in repeats.cleaned(df, whole_characters=True).collect():
        bytes(r.kept).decode()
    assert repeats.cleaned(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        repeats.cleaned(df.withColumn("kept", F.lit(1)), keep=("kept",))


@pytest.mark.parametrize("seed", range(6))
def test_index_against_lookup(seed):
    rng = np.random.default_rng(seed)
    pool = [bytes(rng.integers(97, 99 + seed, rng.integers(6, 40)).astype(np.uint8)) for _ in range(6)]
    strings = [b"".join(pool[i] for i in rng.integers(0, 6, rng.integers(1, 4))) for _ in range(60)]
    length = 8
    strings = [s for s in strings if len(s) >= length]
    keys = rng.integers(-50, 50, len(strings))
    got = repeats.smallest_keys(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]), keys, length)
    first = {}
    for k, s in zip(keys, strings):
        for p in range(len(s) - length + 1):
            first[s[p : p + length]] = min(k, first.get(s[p : p + length], k))
    at = 0
    for k, s in zip(keys, strings):
        for p in range(len(s)):
            assert got[at + p] == (first[s[p : p + length]] if p + length <= len(s) else k)
        at += len(s)


def test_the_largest_key_is_not_a_missing_one(spark):
    long = "".join(chr(97 + i * i % 26) for i in range(80))
    data = [(repeats.LAST, "once " * 3 + long), (None, "none"), (3, long), (None, long + "!")]
    got = repeats.cleaned(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, bytes(r.kept)) for r in got), key=str) == sorted(
        [(repeats.LAST, b"once " * 3), (None, b"none"), (3, long.encode()), (None, b"!")], key=str
    )


def test_edges_of_buckets_follow_the_hash():
    for buckets in (1, 3, 1000):
        limits = [-(-(b << (8 * repeats.HASH_BYTES)) // buckets) for b in range(buckets)]
        values = np.unique(np.array([x + d for x in limits for d in (-1, 0, 1) if x + d >= 0], np.uint64))
        assert repeats.bucket_edges(values, buckets).tolist() == [*np.searchsorted(values, np.array(limits, np.uint64)).tolist(), len(values)]


@pytest.mark.parametrize("buckets", [1, 40, 5000, 10**6])
def test_packets_of_hashes(buckets):
    rng = np.random.default_rng(buckets)
    values = np.unique(rng.integers(0, 1 << 8 * repeats.HASH_BYTES, 20_000, dtype=np.uint64))
    counts = rng.integers(1, 70_000, len(values))
    packets = repeats.packed_hashes(values, counts, repeats.bucket_edges(values, buckets))
    # One packet a bucket at most, one an anchor at most, and a few bytes for each of both.
    assert len(packets) <= min(buckets, len(values)) and sum(len(d) for _, d in packets) <= 8 * len(values) + 64
    assert [b for b, _ in packets] == sorted({int(v) * buckets >> 8 * repeats.HASH_BYTES for v in values})
    found, seen, sizes = repeats.unpacked_hashes([d for _, d in packets])
    assert (found == values).all() and (seen == np.minimum(counts, 65535)).all() and sizes.sum() == len(values)
    for raw in (b"", b"x", b"x" * 511, b"x" * 512, bytes(range(256)) * 9):
        assert repeats.unsqueezed(repeats.squeezed(raw)) == raw


def test_chunks_of_a_few_documents_each(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 500)
    monkeypatch.setattr(repeats, "LARGEST", 500)
    texts = passages(random.Random(8))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], bytes(r["kept"])) for r in repeats.cleaned(df, hot=20).collect()}
    want = {k: (g, t) for k, _, g, _, t in brute([(i, (t or "").encode()) for i, t in enumerate(texts)])}
    assert got == want
