"""The pipeline against the same stages in plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_native import base_spans, counts
from test_near import brute as near_brute
from test_packing import check
from test_repeats import brute as repeats_brute

SF = "/root/testdata/sf0.001"


def low(v):
    shift = max(v.bit_length() - 6, 0)
    return v >> shift << shift


def measures(c, text):
    lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (text or "").split("\n"))
    n = max(c["n_words"], 1)
    return [10 * c["word_chars"] // n, 1000 * c["n_symbols"] // n, 1000 * c["n_dup_lines"] // max(lines, 1), 1000 * c["n_repeat_words"] // n]


# Of each measure: edge and middle percentile, tenths of their distance that are kept beyond the edge, least distance,
# least documents of a group, and whether there is a limit below too.
LIMITS = [(75, 25, 60, 1, 100, True), (75, 50, 40, 10, 100, False), (99, 90, 5, 10, 400, False), (99, 90, 5, 10, 400, False)]


def quality_brute(docs):
    """Ids of kept documents."""
    rows = [(d, c := counts(d.text), measures(c, d.text)) for d in docs]
    groups = defaultdict(list)
    for d, c, m in rows:
        if not c["base_failed"]:
            for g in ((d.lang, d.source), d.lang, None):
                groups[g].append(m)
    out = set()
    for d, c, m in rows:
        if c["base_failed"]:
            continue
        fine = True
        for i, (v, (edge, middle, reach, step, least, below)) in enumerate(zip(m, LIMITS)):
            group = next((groups[g] for g in ((d.lang, d.source), d.lang) if len(groups[g]) >= least), groups[None])
            s = sorted(low(x[i]) for x in group)
            upper, mid = (s[-(-p * len(s) // 100) - 1] for p in (edge, middle))
            far = reach * max(upper - mid, step, 1 + upper // 32) // 10
            fine &= low(v) <= upper + far and (not below or v >= mid - far)
        if fine:
            out.add(d.doc_id)
    return out


def mod97(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def redact_brute(text):
    spans = base_spans(text)
    near_words = lambda m, words: re.search(words, text[max(0, m.start() - 48) : m.start()].lower())
    for m in re.finditer(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", text):
        if mod97(m.group()):
            spans.append(("iban", *m.span()))
    for m in re.finditer(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,128}+(?![A-Za-z0-9+/_=-])", text):
        if near_words(m, r"(?:token|secret|password|passwd|api[_ -]?key|private[_ -]?key)[ \t]*[:=][ \t]*.?$"):
            spans.append(("secret", *m.span()))
    out, at, last = "", 0, None
    for s, e, kind in sorted((s, e, k) for k, s, e in spans):
        if last is not None and s < at:
            at = max(at, e)
            continue
        out += text[at:s] + f"[{kind.upper()}]"
        at = last = e
    return out + text[at:]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(docs.collect())
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == corpus_pipeline.COLUMNS
    return [*out, docs.collect()]


def test_rules_and_near_duplicates(stages):
    given, good, single, *_ = stages
    assert {d.doc_id for d in good} == quality_brute(given)
    assert set(good) <= set(given) and 0 < len(good) < len(given)
    groups = near_brute([(d.doc_id, d.text) for d in good])
    assert {d.doc_id for d in single} == {k for k, c in groups.items() if k == c}
    assert set(single) <= set(good)


def test_passages_and_personal_data(stages):
    _, _, single, cut, clean, _ = stages
    after = {d.doc_id: d for d in cut}
    removed = 0
    for k, _, gone, _, left in repeats_brute([(d.doc_id, (d.text or "").encode()) for d in single]):
        removed += gone
        text = after[k].text.encode()
        # Characters that are only partly repeated stay.
        assert text == left if all(b < 128 for b in text + left) else len(text) >= len(left)
    assert removed > 0 and len(cut) == len(single)
    for d in clean:
        assert d.text == redact_brute(after[d.doc_id].text) and d.n_chars == len(d.text)
        assert (d.lang, d.source) == (after[d.doc_id].lang, after[d.doc_id].source)
    assert len(clean) == len(cut)


def test_packing(stages):
    clean, pieces = stages[-2:]
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = defaultdict(list)
    for r in pieces:
        got[r.doc_id].append(r)
    assert Counter(len(d) > 0 for d in got.values())[True] == len(clean)
    for d in clean:
        ids = np.array([*model.encode(d.text, add_special_tokens=False).ids, 0], "<u4")
        for r in got[d.doc_id]:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        assert sum(r.length for r in got[d.doc_id]) == len(ids)
    assert check(pieces, 2048) <= -(-sum(r.length for r in pieces) // 2048) * 1.01 + 1


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[-1]))


def test_odd_documents(spark):
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    plain = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(None, plain, None, None, None), (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, plain + " é", "en", None, 1), (3, plain + " é", "en", None, 1)], kinds)
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF)
        assert (now.count() == 0) == empty


@pytest.mark.parametrize("shift", [0, -(1 << 62) - 5])
def test_rows_without_an_id_of_their_own(spark, tmp_path, shift):
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    a, b, c, d, e = ("_" + " ".join(f"{x}{i:02}" for i in range(30)) for x in "abcde")
    data = [(None, a), (None, a), (None, b), (9, b), (None, "too few"), (3, c), (3, c), (3, d), (3, "too few"), (4, c + " more"), (2, e), (None, e)]
    data = [(None if k is None else k + shift, t) for k, t in data]
    docs = spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in data], kinds)
    out = []
    for name, stage in corpus_pipeline.STAGES[:2]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        out.append(Counter((r.doc_id, r.text) for r in docs.collect()))
    assert out[0] == Counter((k, t) for k, t in data if t != "too few")
    assert out[1] == Counter([(None, a), (9 + shift, b), (3 + shift, c), (3 + shift, d), (2 + shift, e)])
