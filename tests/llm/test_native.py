"""Quality rules, chat formatting, personal data and sharding against plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from salesmill.llm import chat, pii, quality, sharding
from salesmill.llm.arrays import with_starts
from salesmill.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(df, key):
    out = [r.asDict(recursive=True) for r in df.collect()]
    return {r[key]: r for r in out}


# --- quality rules ---


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 10 or 100 * len(covered) > 20 * len(words),
    }


def test_counts_of_every_document(spark, documents):
    got = rows(QUERIES["op6_quality_rules"](spark, SF), "doc_id")
    assert set(got) == set(documents)
    for i, r in documents.items():
        want = counts(r.text)
        assert {k: got[i][k] for k in want} == want, i
        assert not (got[i]["base_failed"] and got[i]["kept"])


def test_thresholds_reject_outliers_only(spark, documents):
    got = rows(QUERIES["op6_quality_rules"](spark, SF), "doc_id")
    noisy = {i for i, r in documents.items() if 1000 * got[i]["n_symbols"] > 900 * max(got[i]["n_words"], 1)}
    assert noisy and not any(got[i]["kept"] for i in noisy)
    good = [r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()]
    assert len(good) > 100 and sum(got[i]["kept"] or got[i]["base_failed"] for i in good) >= 0.98 * len(good)


def plain_text(rng, words=100, longest=9):
    return [rng.choice("abcdefghij") * rng.randint(1, longest) + str(i) for i in range(words)]


def test_every_measure_rejects_by_limits_of_its_group(spark):
    """Two sources with other habits: what is odd in one is usual in the other, and each measure finds its outlier."""
    rng = random.Random(4)
    data = []
    for i in range(1000):
        short = plain_text(rng, longest=3)
        dense = [w if k % 3 else "#" + w for k, w in enumerate(plain_text(rng))]
        data += [(i, " ".join(short), "en", "plain", 0), (2000 + i, " ".join(dense), "en", "code", 0)]
    word = " ".join(plain_text(rng, longest=3))
    again = word.split()[:9]
    odd = {
        5001: ("code", " ".join(dense)),
        5002: ("plain", " ".join(dense)),  # symbols
        5003: ("plain", " ".join(w * 9 for w in plain_text(rng))),  # word length
        5004: ("plain", "\n".join([word, *["one two"] * 9])),  # lines
        5005: ("plain", " ".join([*plain_text(rng, 90, 3), *again, "x", *again])),  # windows, fewer than the base allows
        5006: ("plain", " ".join(plain_text(rng, longest=3))),
    }
    data += [(i, t, "en", s, 0) for i, (s, t) in odd.items()]
    docs = spark.createDataFrame(data, DOCS)
    got = rows(quality.judged(docs), "doc_id")
    assert {i for i in odd if not got[i]["kept"]} == {5002, 5003, 5004, 5005}
    assert not any(got[i]["base_failed"] for i in odd)
    assert sum(not got[i]["kept"] for i in got if i < 5000) == 0
    # Limits differ between the sources, and without the sketch of its own the same text is judged otherwise.
    moved = docs.withColumn("source", F.when(F.col("doc_id") == 5002, "code").otherwise(F.col("source")))
    assert rows(quality.judged(moved), "doc_id")[5002]["kept"]
    assert not rows(quality.judged(docs.where("source = 'plain'").withColumn("source", F.lit("code"))), "doc_id")[5002]["kept"]


def test_clean_documents_stay_and_every_measure_rejects(spark):
    folder = "/root/testdata/sf0.1"
    counted = quality.measured(spark.read.parquet(f"{folder}/documents.parquet"), "text", ["doc_id", "lang", "source"])
    counted = counted.withColumnsRenamed({"_k0": "key", "_k1": "lang", "_k2": "source"}).withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")).cache()
    limits = quality.thresholds(quality.sketched(counted))
    beyond = [F.count_if((F.expr(quality.bucket(m.value)) > F.col(f"high{i}")) | (F.expr(m.value) < F.col(f"low{i}"))).alias(m.name) for i, m in enumerate(quality.MEASURES)]
    rejected = counted.where("not base_failed").join(limits, ["lang", "source"]).agg(*beyond).first()
    assert all(n > 0 for n in rejected), rejected
    assert limits.select("high0").distinct().count() > 2 and limits.select("high3").distinct().count() > 1
    good = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1")
    kept = quality.judged(spark.read.parquet(f"{folder}/documents.parquet")).join(good, "doc_id")
    share = kept.where("not base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert share >= 0.98
    counted.unpersist()


def test_quality_of_odd_rows(spark):
    plain = " ".join(f"word{i}" for i in range(40))
    data = [
        (1, None, "en", "a", 0),
        (2, "", None, None, 0),
        (3, " 　" + " x" * 3, "en", "a", 1),
        (4, plain, "en", None, 1),
        (4, plain, "en", None, 1),
        (5, "\n".join([plain] * 3), None, "a", 1),
        (None, plain + "\t\x0b\x0c\r " + plain[::-1], "en", "a", 1),
        (6, "aé😀 " * 30000, "en", "a", 1),
    ]
    docs = spark.createDataFrame(data, DOCS).withColumn("kept", F.lit("mine"))
    got = quality.judged(docs).collect()
    assert len(got) == len(data)
    by = {r.doc_id: r.asDict() for r in got}
    for i, text, *_ in data:
        want = counts(text)
        assert {k: by[i][k] for k in want} == want, i
    assert by[4]["kept"] and by[None]["kept"] and not by[6]["kept"]
    assert quality.judged(docs.limit(0)).count() == 0


def test_sketches_merge_to_the_same_result(spark):
    data = [(i, "en", f"s{i % 3}", int(1.4**i) % 9973) for i in range(60)]
    df = spark.createDataFrame(data, "i int, lang string, source string, v long")
    lows = {r.i: (r.v, r.low) for r in df.withColumn("low", F.expr(quality.bucket("v"))).collect()}
    assert all(low <= v and 32 * (v - low) <= v for v, low in lows.values())


# --- chat ---


def test_conversations_match_sql(spark):
    want = duckdb.sql(
        f"create or replace view conversations as select * from '{SF}/conversations.parquet'"
    ) or duckdb.sql(SQL["op4_chat_formatting"]).fetchall()
    got = QUERIES["op4_chat_formatting"](spark, SF)
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_any_text_reads_back(spark):
    rng = random.Random(3)
    parts = ["<", "/", "s", ">", "s>", "[", "INST]", "\\", "]", " ", "</s>", "[/INST]", "<s>", "[INST]", "<\\s>", "[\\\\/INST]", "é", "\n", "$1"]
    data = [
        (c, t, rng.choice(["user", "assistant", None, "", "to </s>ol", " [/INST]"]), None if rng.random() < 0.1 else "".join(rng.choices(parts, k=rng.randint(0, 9))))
        for c in range(60)
        for t in range(rng.randint(1, 6))
    ]
    data += [(None, None, "user", "a"), (None, None, "user", "a"), (None, 1, "assistant", "x" * 200_000 + "</s>")]
    data += [(1000, i % 5, "assistant", "same") for i in range(200)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    out = chat.trained(chat.formatted(df)).collect()
    for r in out:
        mine = sorted(
            [(-1 if t is None else t, role or "", text or "") for c, t, role, text in data if c == r.conv_id],
            key=lambda x: (x[0], x[1].encode(), x[2].encode()),
        )
        assert [(x.role, x.text) for x in r.turns] == [x[1:] for x in mine]
        assert r.loss == "".join(x[2] for x in mine if x[1] == "assistant")
        for x in r.turns:
            shown = r.formatted[x.start : x.start + x.length]
            assert not re.search(chat.BARE, shown)
    assert len(out) == 62
    assert chat.formatted(df.limit(0)).count() == 0


def test_plain_turns_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, 0, "user", "a < b [x]")], "conv_id long, turn long, role string, text string")
    assert chat.formatted(df).first().formatted == "<s>[INST] user [/INST]a < b [x]</s>"


# --- personal data ---


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def check_base(got, text):
    base = [(s["kind"], s["start"], s["end"]) for s in got if s["kind"] in ("email", "ip", "card", "phone")]
    assert base == base_spans(text)


def test_base_spans_of_every_document(spark, documents):
    got = rows(pii.found(spark.read.parquet(f"{SF}/documents.parquet")), "doc_id")
    query = rows(QUERIES["op9_pii"](spark, SF), "doc_id")
    total = 0
    for i, r in documents.items():
        check_base(got[i]["spans"], r.text)
        want = base_spans(r.text)
        total += len(want)
        q = query[i]
        assert q["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert [q[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(w[0] == k for w in want) for k in ("email", "ip", "card", "phone")]
    assert total > 20


def test_base_spans_of_random_texts(spark):
    rng = random.Random(5)
    parts = ["a", "b.c", "@", ".", "-", "_", "1", "12", "255", "256", "4111111111111111", "4111 1111 1111 1111", "+", " ", "(", ")", "é", "😀", "0", "%", "+1 (555) 123-4567", "1.2.3.4"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(rng.choices("0123456789 -.", k=60)) for _ in range(500)] + [None, "", "5" * 50_000 + "@", "a@b.c " * 3000, "a" * 100_000 + "@b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in rows(pii.found(df), "doc_id").values():
        check_base(r["spans"], r["text"])


def test_checksums_and_context_confirm(spark):
    texts = {
        "pay to DE89370400440532013000 now": ["iban"],
        "pay to DE89370400440532013001 now": [],
        "the account DE89370400440532013001": [],
        "GB82 WEST 1234 5698 7654 32 here": ["iban"],
        "SSN: 123-45-6789": ["ssn"],
        "part 123-45-6789": [],
        'token = "1eb9c654e721b4f812088970e66a6345cee33dd6"': ["secret"],
        "commit 1eb9c654e721b4f812088970e66a6345cee33dd6": [],
    }
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in pii.found(df).collect():
        assert [s.kind for s in r.spans] == texts[r.text], r.text


def test_redaction(spark):
    data = [(1, "mail é@ joe.doe@x.example.com or +1 (555) 123-4567!", "k"), (2, None, "k"), (3, "nothing", "k"), (4, "a@1.2.3.4 x", "k")]
    df = spark.createDataFrame(data, "doc_id long, text string, _x string")
    got = {r.doc_id: r for r in pii.redacted(df).collect()}
    assert got[1].text == "mail é@ [EMAIL] or [PHONE]!"
    assert got[2].text is None and got[3].text == "nothing"
    assert got[4].text == "[EMAIL] x" and got[4]._x == "k"
    assert pii.redacted(df.limit(0)).columns == df.columns
    with pytest.raises(ValueError):
        pii.found(df.withColumn("spans", F.lit(1)))


# --- sharding ---


def test_shards_of_all_documents(spark, documents):
    got = rows(QUERIES["op7_stratified_interleaving"](spark, SF), "doc_id")
    assert set(got) == set(documents)
    sources = Counter(r.source for r in documents.values())
    by = {}
    for i, r in got.items():
        text = (documents[i].text or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 16, zlib.crc32(text), "rows", None)
        by.setdefault(r["shard"], []).append(i)
    assert sorted(by) == list(range(40))
    assert {len(x) for x in by.values()} == {25}
    for shard, ids in by.items():
        assert sorted(got[i]["slot"] for i in ids) == list(range(len(ids)))
        mine = Counter(documents[i].source for i in ids)
        for s, n in sources.items():
            assert abs(mine[s] - n / 40) < 2, (shard, s)


def brute_places(data, seed, shards):
    by = {}
    for k, s in data:
        by.setdefault(s, []).append((hashlib.md5(f"{seed}:{'null' if k is None else k}".encode()).hexdigest(), k))
    out = []
    for s, keys in by.items():
        cells = sorted((int(h[:8], 16) % 1024, h, k) for h, k in keys)
        out += [((2 * i + 1) / (2 * len(keys)), s or "", h, k) for i, (_, h, k) in enumerate(cells)]
    out.sort(key=lambda x: x[:3])
    return {k: (p * shards // len(out)) for p, (_, _, _, k) in enumerate(out)}


@pytest.mark.parametrize("n,shards", [(1, 4), (7, 3), (501, 7), (3, 10)])
def test_shards_against_brute_force(spark, n, shards):
    data = [(i, None if i % 5 == 0 else "hot" if i % 3 else f"s{i % 11}") for i in range(n)]
    df = spark.createDataFrame(data, "id long, src string").withColumn("_cell", F.lit(1))
    got = {r.id: r for r in sharding.interleave(df, shards, key="id", stratum="src", seed=9).collect()}
    assert {k: r.shard for k, r in got.items()} == brute_places(data, 9, shards)
    sizes = Counter(r.shard for r in got.values())
    assert max(sizes.values()) - min([sizes[k] for k in range(shards)]) <= 1
    for k in sizes:
        assert sorted(r.slot for r in got.values() if r.shard == k) == list(range(sizes[k]))


def test_shards_of_odd_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (None, None), (2, None)], "id long, src string")
    got = sharding.interleave(df, 2, key="id", stratum="src").collect()
    assert sorted(Counter(r.shard for r in got).values()) == [2, 3]
    assert sharding.interleave(df.limit(0), 2, key="id", stratum="src").count() == 0
    with pytest.raises(ValueError):
        sharding.interleave(df.withColumn("slot", F.lit(1)), 2, key="id", stratum="src")


def test_running_sums_of_arrays_of_any_length(spark):
    sizes = [0, 1, 2, 63, 64, 65, 128, 4095, 4096, 4097, 9000, 200_000]
    made = spark.createDataFrame([(n,) for n in sizes], "n int").withColumn("s", F.expr("if(n = 0, array(), transform(sequence(1, n), x -> cast(x * 7 % 11 as bigint)))"))
    for r in with_starts(made, "s", "before").select("n", "s", "before").collect():
        assert r["before"] == [0, *itertools.accumulate(r["s"])][: r["n"]], r["n"]
    assert with_starts(spark.createDataFrame([(None,)], "s array<bigint>"), "s", "before").first()["before"] is None


def test_a_text_of_two_hundred_thousand_addresses(spark):
    count, one = 200_000, "u@x.io "
    df = spark.createDataFrame([(1, one * count)], "doc_id long, text string")
    found = pii.found(df).selectExpr("size(spans) as n", "spans[size(spans) - 1].start as last").first()
    assert (found["n"], found["last"]) == (count, (count - 1) * len(one))
