"""Encoding by the prefix table against the library."""

import hashlib
import random

import public_tokenizers
import pytest

from salesmill.llm.pieces import Pieces, encoded, library
from salesmill.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pieces():
    return Pieces(PATH)


def test_every_document(spark):
    model = library(PATH)
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op10_sentencepiece"](spark, SF).collect()}
    assert set(got) == set(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, text in docs.items():
        ids = model.encode(text)
        want = (len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids)))
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want, i


def test_odd_rows(spark):
    rng = random.Random(2)
    parts = [" ", "  ", "▁", "a", "the", "é", "😀", "中文", "\n", "\t", "\x00", "ing", "1", "<s>", "</s>", "<unk>", "<0x0A>", "\u0301", "ﷺ"]
    texts = [None, "", " ", "▁", "x" * 60_000, "ab " * 40_000, " " * 3000, "same", "same"]
    texts += ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(400)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x300, 0xD7FF), rng.randint(0x10000, 0x1FFFF), 32])) for _ in range(9)) for _ in range(300)]
    df = spark.createDataFrame([(i % 600 if i else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    model = library(PATH)
    got = encoded(df, PATH).collect()
    assert len(got) == len(texts)
    want = sorted((str(i % 600 if i else None), model.encode(t or ""), model.decode(model.encode(t or ""))) for i, t in enumerate(texts))
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in got) == want
    assert encoded(df.limit(0), PATH).count() == 0


def test_pairs_against_merging(pieces):
    rng = random.Random(4)
    pool = [*list(pieces.halves)[:2500], *"abcdeinrst", *["▁", "▁▁", "▁▁▁▁", "▁" * 8] * 30]
    for _ in range(20_000):
        a, b = rng.choice(pool), rng.choice(pool)
        assert pieces.compatible(a, b) == (pieces.merged(a + b) == [a, b]), (a, b)


def test_random_units_against_merging(pieces):
    rng = random.Random(6)
    for _ in range(3000):
        unit = "".join(rng.choices("▁▁etaoinshr", k=rng.randint(1, 14)))
        assert pieces.tokens(unit) == pieces.merged(unit)


def test_generations_keep_results(spark, pieces, monkeypatch):
    import salesmill.llm.pieces as module

    monkeypatch.setattr(module, "REMEMBERED", 3)
    fresh = Pieces(PATH)
    text = " ".join(f"w{i % 11} and the {i}" for i in range(200))
    assert fresh.round_trip(text) == pieces.round_trip(text)


def test_a_pair_is_decided_once(monkeypatch):
    """Words of an invented language: of all pairs that meet, each is decided once, whatever the number of words."""
    fresh, rng, asked = Pieces(PATH), random.Random(8), []
    decide = fresh.compatible
    monkeypatch.setattr(fresh, "compatible", lambda a, b: asked.append((a, b)) or decide(a, b))
    words = ["".join(rng.choices(["the", "tion", "ing", "er", "an", "st", "e", "o"], k=6)) for _ in range(3000)]
    model = library(PATH)
    for w in words:
        ids, back = fresh.round_trip(w)
        assert (list(memoryview(ids).cast("i")), back) == (model.encode(w), w)
    assert asked and len(asked) == len(set(asked))


def test_other_models_are_refused(tmp_path):
    bad = tmp_path / "x.model"
    from sentencepiece import sentencepiece_model_pb2

    m = sentencepiece_model_pb2.ModelProto()
    m.trainer_spec.model_type = 1
    bad.write_bytes(m.SerializeToString())
    with pytest.raises(ValueError):
        Pieces(str(bad))
