"""Archives: what is read back against what was written, with marks inside payloads."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from salesmill.llm import warc
from salesmill.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"


def test_pages_match_sql(spark):
    duckdb.sql(f"create or replace view pages as select * from '{SF}/pages.parquet'")
    got = QUERIES["op2_warc"](spark, SF)
    want = duckdb.sql(f"select {', '.join(got.columns)} from ({SQL['op2_warc']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_payloads_with_marks(spark, tmp_path, monkeypatch, compression):
    rng = random.Random(7)
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: "
    bits = ["WARC/1.1\r\n", fake + "3\r\n\r\nabc\r\n\r\n", fake + "900000\r\n\r\n", "é", "\r\n\r\n", "x" * 50, "WARC/1.1", fake + "0\r\n\r\n\r\n\r\n" * 2]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 8))) for _ in range(300)]
    texts += [None, "", "WARC/1.1\r\n", "y" * 1500, "y" * 1500, "y" * 999, "y" * 999, "z" * 300_000 + fake + "5\r\n\r\n12345\r\n\r\n"] + ["copy " * 300] * 40
    data = [(i, None if i % 7 == 0 else f"http://h/{i}\n?é", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    path = str(tmp_path / "a")
    warc.written(df.repartition(3), path, compression=compression)
    monkeypatch.setattr(warc, "RANGE", 4096)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = warc.records(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    largest = {}
    for i, t in enumerate(texts):
        largest[t or ""] = i
    assert len(got) == len(texts)
    by = {r.record_id: r for r in got}
    for i, t in enumerate(texts):
        r, raw = by[f"<urn:page:{i}>"], (t or "").encode()
        revisit = len(raw) >= 1000 and largest[t] != i
        assert r.type == ("revisit" if revisit else "response")
        assert r.declared_digest == hashlib.sha1(raw).hexdigest() and r.http_bytes == len(raw)
        assert r.refers_to == (f"<urn:page:{largest[t]}>" if revisit else "")
        if not revisit:
            assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())


def test_parts_are_found_however_files_are_cut(spark, tmp_path):
    texts = [f"{i} " + "WARC/1.1\r\n".join(["part %d " % (i % 5) * 40] * 3) for i in range(400)]
    df = spark.createDataFrame([(i, "u", t) for i, t in enumerate(texts)], "page_id long, url string, html string")
    path = str(tmp_path / "a")
    warc.written(df.repartition(5), path, compression="none")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        found = warc.records(spark, path)
        # The second read, cut differently, as with other executors.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        got = {r.record_id: (r.payload_bytes, r.payload_digest) for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"<urn:page:{i}>": (len(t), hashlib.sha1(t.encode()).hexdigest()) for i, t in enumerate(texts)}


def chain(edges, start=0):
    out = []
    while start in edges:
        out.append(start)
        start = edges[start]
    return out


def test_chains_against_walking(spark):
    rng = random.Random(3)
    data, want = [], set()
    for f in range(6):
        offs = sorted({0, *rng.sample(range(1, 5000), 400)}) if f else list(range(0, 5000, 7))
        edges = {o: rng.choice([x for x in offs if x > o][:4] or [o + 9]) if f else o + 7 for o in offs}
        if f == 5:
            edges.pop(0)
        data += [(f"f{f}", o, n) for o, n in edges.items()]
        want |= {(f"f{f}", o) for o in chain(edges)}
    df = spark.createDataFrame(data, "file string, off long, nxt long")
    for size in (64, 1000, 1 << 20):
        assert {tuple(r) for r in warc.chained(df, bytes_in_range=size).collect()} == want


def test_odd_tables(spark, tmp_path):
    df = spark.createDataFrame([(None, None, None), (1, "u", "a" * 1200), (1, "u", "a" * 1200), (None, "u", "a" * 1200)], "page_id long, url string, html string")
    warc.written(df, str(tmp_path / "odd"))
    got = sorted((r.record_id, r.type) for r in warc.records(spark, str(tmp_path / "odd")).collect())
    assert got == [("<urn:page:1>", "response")] * 2 + [("<urn:page:null>", "response"), ("<urn:page:null>", "revisit")]
    warc.written(df.limit(0), str(tmp_path / "none"))
    assert warc.records(spark, str(tmp_path / "none")).count() == 0
