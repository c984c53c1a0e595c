"""Links of vectors and components against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmill.llm import embeddings, graph
from salesmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def sound(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(data, threshold=0.95):
    links, root = {}, {}
    good = [(k, np.asarray(v, float)) for k, v in data if k is not None and sound(v)]
    parent = {k: k for k, _ in data}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, (a, v) in enumerate(good):
        for b, w in good[:i]:
            if len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold:
                links[a] = links.get(a, 0) + 1
                links[b] = links.get(b, 0) + 1
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: (links.get(k, 0), find(k)) for k, _ in data}


def clustered(rng, n, groups, dim=64, noise=0.02):
    out = [rng.normal(size=dim) for _ in range(n)]
    for size in groups:
        c = rng.normal(size=dim)
        out += [c + rng.normal(size=dim) * noise * rng.integers(0, 12) for _ in range(size)]
    return [list(map(float, np.float32(v))) for v in out]


def result(df, **more):
    return {r.vec_id: (r.n_links, r.component_id) for r in embeddings.linked(df, **more).collect()}


def test_every_vector(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want = brute([(r.vec_id, r.embedding) for r in rows])
    got = QUERIES["op5_embedding_links"](spark, SF).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("block", [2048, 40])
def test_recall_on_groups(spark, block):
    rng = np.random.default_rng(1)
    vectors = clustered(rng, 300, [2, 3, 5, 20, 150])
    vectors += vectors[-30:] + vectors[:3] * 4
    data = list(enumerate(vectors))
    rng.shuffle(data)
    want = brute(data)
    got = result(spark.createDataFrame(data, "vec_id long, embedding array<float>"), block=block)
    assert set(got) == set(want)
    assert all(got[k][0] <= want[k][0] for k in want)
    assert sum(g for g, _ in got.values()) >= 0.98 * sum(w for w, _ in want.values())
    assert sum(got[k][1] == want[k][1] for k in want) >= 0.98 * len(want)


def met(vectors, pivots):
    """Pairs that share three of their eight nearest pivots, of rows against a tenth of them."""
    close = embeddings.near(vectors, pivots, embeddings.NEAREST)
    mark = np.zeros((len(close), len(pivots)), np.float32)
    np.put_along_axis(mark, close, 1, axis=1)
    return int((mark[::10] @ mark.T >= embeddings.SHARED).sum()) - len(mark[::10])


def test_pairs_of_a_vector_do_not_grow_with_the_table():
    rng = np.random.default_rng(4)
    all_rows = embeddings.unit(rng.normal(size=(20_000, 64)))
    each, fixed = [], []
    for n in (5_000, 20_000):
        rows = all_rows[:n]
        want = embeddings.pivots_for(n)
        each.append(met(rows, embeddings.spread(rows[: max(4096, 3 * want)], want)) / (n / 10))
        fixed.append(met(rows, embeddings.spread(rows[:4096], 512)) / (n / 10))
    assert embeddings.pivots_for(5_000) == embeddings.pivots_for(10) == 512 < embeddings.pivots_for(20_000)
    assert fixed[1] > 3 * fixed[0] and each[1] < 1.5 * each[0]


def test_recall_with_many_pivots():
    """Pairs exactly at the threshold, the hardest, with the pivots of 100,000 vectors."""
    rng = np.random.default_rng(5)
    pivots = embeddings.unit(rng.normal(size=(embeddings.pivots_for(100_000), 64)))
    x = embeddings.unit(rng.normal(size=(3_000, 64)))
    z = rng.normal(size=x.shape)
    z = embeddings.unit(z - (z * x).sum(axis=1, keepdims=True) * x)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * z
    a, b = (embeddings.near(v, pivots, embeddings.NEAREST) for v in (x, y))
    assert ((a[:, :, None] == b[:, None, :]).any(axis=2).sum(axis=1) >= embeddings.SHARED).mean() > 0.97


def test_nearest_pivots_with_ties():
    pivots = np.array([[0.0, 1.0], [1.0, 0.0], [0.0, 1.0], [-1.0, 0.0], [1.0, 0.0]])
    assert embeddings.near(np.array([[1.0, 0.0], [0.0, 3.0]]), pivots, 3).tolist() == [[0, 1, 4], [0, 1, 2]]
    assert embeddings.near(np.array([[1.0, 0.0]]), pivots, 8).tolist() == [[0, 1, 2, 3, 4]]


def test_more_pivots_than_the_least(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "ENOUGH", 50)
    rng = np.random.default_rng(6)
    data = list(enumerate(clustered(rng, 400, [2, 30, 200]) + clustered(rng, 40, [5], dim=16)))
    want = brute(data)
    got = result(spark.createDataFrame(data, "vec_id long, embedding array<float>"), block=64, pivots=48)
    assert all(got[k][0] <= want[k][0] for k in want)
    assert sum(g for g, _ in got.values()) >= 0.98 * sum(w for w, _ in want.values())
    with pytest.raises(ValueError, match="share fewer"):
        embeddings.linked(spark.createDataFrame(data, "vec_id long, embedding array<float>"), shared=12, nearest=12)


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    data = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]), (6, [float("inf"), 1.0, 1.0])]
    data += [(7, v), (8, [2.0, 4.0, 6.0]), (9, [1.0, 2.0]), (10, v), (11, [-1.0, -2.0, -3.0]), (12, [1e30, 2e30, 3e30]), (13, [1.0, 2.0, 3.1])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("node", F.lit("x"))
    assert result(df) == brute(data)
    with_null = spark.createDataFrame([(None, v), (1, v)], "vec_id long, embedding array<double>")
    assert result(with_null) == {None: (0, None), 1: (0, 1)}
    assert embeddings.linked(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components_against_union(spark, seed):
    rng = np.random.default_rng(seed)
    n = 300
    edges = [(int(a), int(b)) for a, b in rng.integers(0, n, (140, 2))] + [(i, i + 1) for i in range(400, 460)] + [(900, i) for i in range(901, 960)] + [(5, 5)]
    parent = {x: x for e in edges for x in e}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    df = spark.createDataFrame([*edges, (None, 3), (1, None)], "a long, b long")
    got = {r.node: r.root for r in graph.components(df).collect()}
    want = {x: find(x) for x in parent}
    assert {k: v for k, v in got.items() if k in want} == want
