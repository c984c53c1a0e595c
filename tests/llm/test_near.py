"""Near-duplicates: signatures against the similarity they stand for, groups against brute force."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from salesmill.llm import hashing, near
from salesmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def runs(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similar(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def brute(data, least=0.8):
    docs = {k: runs(t) for k, t in data}
    parent = {k: k for k in docs}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    by = {}
    for k in sorted(docs):
        for r in docs[k]:
            by.setdefault(r, []).append(k)
    seen = set()
    for keys in by.values():
        for i, a in enumerate(keys):
            for b in keys[:i]:
                if (b, a) not in seen:
                    seen.add((b, a))
                    if similar(docs[a], docs[b]) >= least:
                        x, y = sorted((find(a), find(b)))
                        parent[y] = x
    return {k: find(k) for k in docs}


def test_every_document(spark):
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op8_minhash_near_dedup"](spark, SF).collect()
    assert {r.doc_id: r.class_id for r in got} == brute(data)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_of_copies(spark):
    rng = random.Random(1)
    data = []
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    texts = [edited(rng, base, rng.randint(0, 12)) for _ in range(250)]
    for _ in range(30):
        w = [f"v{rng.randrange(5000)}" for _ in range(rng.randint(1, 120))]
        texts += [edited(rng, w, rng.randint(0, max(1, len(w) // 30))) for _ in range(rng.randint(1, 6))]
    chain = [f"c{i}" for i in range(200)]
    for _ in range(12):
        chain = edited(rng, chain, 3).split(" ")
        texts.append(" ".join(chain))
    texts += ["a b", "a b", "a  b\n", "b a", "x", None, "", " \t", None, "same line here now\n" * 60, "same line here now\n" * 61, "same line here now\n" * 90]
    rng.shuffle(texts)
    data = list(enumerate(texts, 1))
    df = spark.createDataFrame([*data, (None, "x")], "doc_id long, text string").withColumn("weight", F.lit(1))
    got = near.classes(df).collect()
    assert len(got) == len(data) + 1
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == brute(data)
    assert near.classes(df.limit(0)).count() == 0


def test_blocks_are_bounded_by_bytes(spark):
    rows = spark.createDataFrame([("x", i, 1000 if i < 40 else 10) for i in range(400)] + [("y", 1000, 10**6)], "g string, node long, weight long")
    out = near.blocked(rows, "g", 1024, F.col("weight") * 8, 64_000).toPandas()
    x = out[out["g"] == "x"]
    held = x.groupby(["lo", "hi"])["weight"].sum() * 8
    assert x["hi"].max() + 1 == -(-8 * (40 * 1000 + 360 * 10) // 64_000) and held.max() < 4 * 64_000
    # Every two nodes stand together, on two sides or in one block.
    cells = x.groupby("node").apply(lambda r: set(zip(r["lo"], r["hi"])), include_groups=False)
    assert all(cells[a] & cells[b] for a in range(0, 400, 7) for b in range(a, 400, 11))
    # A document beyond the bound still meets itself and all others of its group.
    assert len(out[out["g"] == "y"]["lo"].unique()) > 1


def test_a_cluster_of_long_texts_in_many_blocks(spark, monkeypatch):
    """Verified by itself, as if no star had linked any of its documents."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(150_000)]
    texts = [" ".join(words)]
    for _ in range(5):  # a chain: its ends are below 0.8
        for _ in range(2_000):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    assert min(map(len, texts)) > 1_000_000
    data = list(enumerate(texts, 1))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    monkeypatch.setattr(near, "BLOCK_BYTES", 1 << 21)
    near.bounded(spark)
    known = near.sketches(docs, key="doc_id", text="text").select(F.col("key").alias("node"), F.col("key").alias("root"), "weight", "sig")
    sets = near.cell_sets(docs, known.select(F.col("node").alias("_n")), key="doc_id", text="text")
    rows = known.join(sets, F.col("node") == F.col("n")).drop("n").withColumn("cluster", F.lit(0))
    assert near.blocked(rows, "cluster", near.BLOCK, F.col("weight") * 8, near.BLOCK_BYTES).agg(F.max("hi")).first()[0] >= 2
    found = {(r.a, r.b) for r in near.linked_clusters(rows, 0.8).collect()}
    sets_of = {k: runs(t) for k, t in data}
    assert found and all(similar(sets_of[x], sets_of[y]) >= 0.8 for x, y in found)
    assert similar(sets_of[1], sets_of[6]) < 0.8
    roots = near.Joined(np.arange(len(data)))
    for x, y in found:
        roots.join(x - 1, y - 1)
    assert [roots.find(k - 1) + 1 for k, _ in data] == list(brute(data).values())


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(5)
    a = [rng.randrange(60) for _ in range(300)]
    b = a[:240] + [rng.randrange(60, 90) for _ in range(60)]
    x, y = Counter(a), Counter(b)
    both = sum((x & y).values())
    want = both / (len(a) + len(b) - both)
    text = np.repeat([0, 1], [len(a), len(b)])
    of, cell = near.cells(text, hashing.mixed(np.array(a + b, np.uint64)))
    sig = near.signatures(of, cell, 3, 4096)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03
    assert not sig[2].any() and (sig[:2] != 0).all()


def test_hashes_do_not_depend_on_the_place():
    texts = [b"one two  three\tfour five six", b"", b"zero one two three four five six", b"one two", "é ö\nü".encode()]
    h, of = hashing.shingles(texts)
    by = [set(h[of == i].tolist()) for i in range(len(texts))]
    assert [len(x) for x in by] == [2, 0, 3, 1, 1] and by[0] < by[2]
    alone = hashing.shingles([texts[3]])[0]
    assert set(alone.tolist()) == by[3]
    assert list(hashing.slices([5, 5, 20, 1, 1], 10)) == [(0, 2), (2, 3), (3, 5)]
