"""Exact copies by tree merge, periodic runs and the conversation trie against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from salesmill.llm import digests, periods, tries
from salesmill.llm.queries import QUERIES, cycled

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- exact copies ---


def test_copies_of_odd_rows(spark):
    rng = random.Random(1)
    texts = [None, "", " ", "\t\n ", "a b", "a \n b", " a b", "a b", "x " * 200_000, "x\t" * 200_000]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice(texts), "z", 0) for _ in range(400)] + [(9, "only", "z", 0)]
    names = "doc_id long, text string, keep_id string, group_size int"
    got = digests.classes(spark.createDataFrame(rows, names).repartition(7)).collect()
    groups = defaultdict(list)
    for k, t, *_ in rows:
        groups[sha(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""))].append(k)
    assert len(got) == len(rows)
    seen = defaultdict(list)
    for r in got:
        seen[r.text_sha256].append(r)
    assert set(seen) == set(groups)
    for g, members in groups.items():
        ids = [k for k in members if k is not None]
        first = min(ids) if ids else None
        assert sorted(map(str, members)) == sorted(str(r.doc_id) for r in seen[g])
        assert {(r.keep_id, r.group_size) for r in seen[g]} == {(first, len(members))}
        assert [r.doc_id for r in seen[g] if r.kept] == [first]  # one row, also of repeated ones
    assert digests.classes(spark.createDataFrame([], names)).collect() == []


def test_digest_alone_gives_the_last_place(spark):
    places = digests.FAN**digests.ROUNDS
    df = spark.range(5000).selectExpr("xxhash64(id) as digest", f"pmod(id * 7, {places}) as place")
    for level in range(digests.ROUNDS):
        df = df.withColumn("place", digests.moved(df.place, level))
    assert df.where(f"place <> pmod(digest, {places})").count() == 0


# --- periodic runs ---


def runs_by_definition(words):
    """All (start, length, period), from the definition, per period."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                part = words[i : j + q]
                if all(any(part[x] != part[x + d] for x in range(len(part) - d)) for d in range(1, q)):
                    out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out)


def digest_row(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = runs_by_definition(words)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *top, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(kept))


def random_texts(rng):
    for _ in range(1500):
        n, letters = rng.randint(0, 120), rng.choice(["ab", "abc", "abcdefgh"])
        words = rng.choices(letters, k=n)
        for _ in range(rng.randint(0, 4)):
            unit = rng.choices(letters, k=rng.randint(1, 15))
            at = rng.randint(0, n)
            words[at:at] = (unit * 9)[: rng.randint(1, 60)]
        yield words


def test_runs_of_random_words():
    rng = random.Random(3)
    for words in random_texts(rng):
        assert periods.runs(periods.numbered([w.encode() for w in words])) == runs_by_definition(words), words


def test_fibonacci_and_very_long_words():
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    assert periods.runs(np.frombuffer(b.encode(), np.uint8) - 97) == runs_by_definition(b)
    assert periods.runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    unit = np.arange(1000)
    assert periods.runs(np.tile(unit, 200)[:-7]) == [(0, 199_993, 1000)]


def test_runs_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    short = [r for r in docs if len(WORD.findall(r.text or "")) <= 700]
    assert len(short) > 700 and sum(got[r.doc_id][1] > 0 for r in short) > 50
    for r in short:
        assert got[r.doc_id] == digest_row(r.doc_id, r.text), r.doc_id


def test_runs_of_odd_rows(spark):
    again = "one two three four five six " * 3
    texts = [None, "", " \n", "w", "w " * 11, "w " * 12, again, again + "x " + again, "é  " * 12, "x y " * 60_000]
    rows = [(k, t, "own", 7) for t in texts for k in (None, 5, 5)]
    names = "doc_id long, text string, runs string, start int"
    got = periods.found(spark.createDataFrame(rows, names)).collect()
    assert len(got) == len(rows)
    by_text = defaultdict(set)
    for (k, t, *_), r in zip(sorted(rows, key=str), sorted(got, key=lambda r: str(r.doc_id))):
        by_text[r.n_words].add((tuple(map(tuple, r.runs)), r.collapsed))
    assert by_text[11] == {((), " ".join("w" * 11))}
    assert by_text[12] == {(((0, 12, 1),), "w"), (((0, 12, 1),), "é ")}
    assert by_text[18] == {(((0, 18, 6),), "one two three four five six")}
    assert by_text[120_000] == {(((0, 120_000, 2),), "x y")}
    assert by_text[0] == {((), "")}
    assert periods.found(spark.createDataFrame([], names), reorder=cycled).collect() == []


# --- trie ---


def trie_by_definition(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    made = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + mine[h:]
    nodes = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            nodes[tuple(made[c][:d])].append(c)
    children = defaultdict(list)
    for p in nodes:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        saved[p] = sum(saved[x] for x in children[p]) + ((len(nodes[p]) - 1) * len(WORD.findall(p[-1][1])) if p else 0)
        ends = ",".join(str(c) for c in nodes[p] if len(made[c]) == len(p))
        up = nodes[p[:-1]][0] if p else None
        out[nodes[p][0], len(p)] = (up, len(nodes[p]), len(children[p]), leaves[p], saved[p], sha(ends))
    return out


def as_dict(df):
    got = df.collect()
    out = {(r.conv_id, r.depth): tuple(r)[2:] for r in got}
    assert len(out) == len(got)
    return out


def test_trie_of_conversations(spark):
    for sf in (SF, "/root/testdata/sf0.1"):
        rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        got = QUERIES["op12_conversation_prefix_trie"](spark, sf)
        assert [t for _, t in got.dtypes[:7]] == ["bigint"] * 7
        assert as_dict(got) == trie_by_definition(rows)


@pytest.mark.parametrize("whole", [1, 3, 4096])
def test_trie_by_rounds_of_splitting(spark, whole, monkeypatch):
    """Long, wide and mixed tries with every bound on what a task takes whole."""
    monkeypatch.setattr(tries, "BLOCK", 4)
    rng = random.Random(whole)
    rows = []
    for c in range(-25, 45):
        turns = [rng.choice("ab") for _ in range(rng.choice([1, 1, 2, 5, 9]))] if c % 3 else ["a"] * rng.randint(1, 12)
        rows += [(c, rng.choice([i, i, None]), rng.choice(["u", None]), rng.choice([t, t, t + " t", None])) for i, t in enumerate(turns)]
    rows += [(41, i, "u", "a") for i in range(60)] + [(43, i, "u", "a") for i in range(60)]
    rows += [(None, 1, "u", "a"), (7, None, None, None), (7, None, None, None), (-60, 3, "u", "x " * 100_000)]
    df = spark.createDataFrame([(*r, "own", 1) for r in rows], "conv_id long, turn long, role string, text string, depth string, words int")
    assert as_dict(tries.trie(df.repartition(5), whole=whole)) == trie_by_definition(rows)


def test_trie_of_one_long_and_of_equal_conversations(spark):
    rows = [(1, i, "u", f"w{i}") for i in range(3000)] + [(c, 0, "u", "same") for c in range(2, 900)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert as_dict(tries.trie(df, whole=16)) == trie_by_definition(rows)


def test_empty_table_has_no_trie(spark):
    assert tries.trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
