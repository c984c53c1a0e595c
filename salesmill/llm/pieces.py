"""Encoding and decoding with a byte-pair model of sentencepiece, by a table over prefixes.

The encoding of every prefix of a text ends in one token only. That token is
found from the vocabulary's matches that end at the prefix (one pass of an
automaton): it is the match whose predecessor, the last token of the prefix
before it, is compatible with it, two tokens being compatible when encoding
their concatenation gives just these two. So a text is encoded in one pass
without merging anything, and its tokens are read backwards from the table.

No token of such a vocabulary has a space mark behind another character, so
texts fall into independent units, a word with the spaces before it. Units
recur; each process remembers those it has seen, up to a bound.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from .batches import bounded

SPACE = "▁"
#: Remembered units and the longest remembered; both bound memory only.
REMEMBERED, LONGEST = 200_000, 32
NORMAL, UNKNOWN, BYTE, BPE = 1, 2, 6, 2


class Pieces:
    """A vocabulary with encoder and decoder."""

    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        plain = rules.name == "identity" and rules.escape_whitespaces and not rules.remove_extra_whitespaces
        if model.trainer_spec.model_type != BPE or not plain or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only byte-pair models that leave texts as they are")
        if any(p.type not in (NORMAL, UNKNOWN, BYTE, 3) for p in model.pieces):
            raise ValueError("only normal, byte, control and unknown pieces")
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.surface = {i: p.piece.replace(SPACE, " ") for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.value = {i: b for b, i in self.byte.items()}
        self.packed = [struct.pack("<i", i) for i in range(len(model.pieces))]
        self.whole = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.mark = "" if self.whole else self.prefix
        # Tokens that merging never yields cannot be anyone's last token.
        self.matches = ahocorasick.Automaton()
        self.halves: dict[str, tuple[str, str]] = {}
        for p in self.ids:
            if len(p) > 1 and self.merged(p, steps := []) == [p]:
                # With what is known of its left neighbours.
                self.matches.add_word(p, (p, len(p), {}))
                self.halves[p] = steps[-1]
        self.matches.make_automaton()
        self.asked = 0
        # Two generations: what is still in use moves on when the older is dropped.
        self.seen: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}

    def merged(self, text: str, steps: list[tuple[str, str]] | None = None) -> list[str]:
        """Plain merging: the pair with the best score first, of equals the leftmost. ``steps`` gets the merges."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            if steps is not None:
                steps.append((parts[at], parts[at + 1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` ends in these two.

        It does unless a merge across the border comes first at some time. The
        times at which the border stood between other parts are found by taking
        back the later of the two sides' last merges; a merge across it counts
        if it is better than what was taken back, or as good and further left.
        """
        score, halves = self.score, self.halves
        a, b, limit, ties = left, right, None, True
        while True:
            across = score.get(a + b)
            if across is not None and (limit is None or across > limit or (ties and across == limit)):
                return False
            over, under = halves.get(a), halves.get(b)
            if over is None and under is None:
                return True
            if under is None or (over is not None and score[a] < score[b]):
                a, limit, ties = over[1], score[a], False
            else:
                b, limit, ties = under[0], score[b], True

    def asked_first(self, left: str, right: str, known: dict[str, bool]) -> bool:
        """``compatible``, noted among what is ``known`` of the right token."""
        if self.asked >= REMEMBERED:
            for _, _, others in self.matches.values():
                others.clear()
            self.asked = 0
        self.asked += 1
        fits = known[left] = self.compatible(left, right)
        return fits

    def tokens(self, unit: str) -> list[str]:
        """Tokens of a unit as strings; a character outside the vocabulary is one by itself."""
        last: list[str] = list(unit)
        found = -1
        # Matches come by their ends; one of those that end together fits at most.
        for end, (token, size, known) in self.matches.iter(unit):
            if end == found:
                continue
            if end >= size:
                left = last[end - size]
                fits = known.get(left)
                if fits is None:
                    fits = self.asked_first(left, token, known)
                if not fits:
                    continue
            last[end] = token
            found = end
        out, end = [], len(unit) - 1
        while end >= 0:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def numbers(self, token: str) -> list[int]:
        i = self.ids.get(token)
        if i is not None:
            return [i]
        return [self.byte[b] for b in token.encode()] if self.byte else [self.unknown]

    def decoded(self, ids: list[int]) -> str:
        """Text of ids; runs of byte tokens are UTF-8, what is not is replaced byte by byte."""
        try:
            return "".join([self.surface[i] for i in ids])
        except KeyError:
            pass
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i in self.value:
                run.append(self.value[i])
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run.clear()
            if i is not None:
                out.append(self.surface.get(i, " ⁇ " if i == self.unknown else ""))
        return "".join(out)

    def unit(self, unit: str) -> tuple[bytes, str]:
        """Ids of a unit (without its first mark) as four-byte numbers, and their text; for units not among the newer ones."""
        got = self.older.get(unit)
        if got is None:
            tokens = self.tokens(self.mark + unit)
            try:
                ids = [self.ids[token] for token in tokens]
            except KeyError:
                ids = [i for token in tokens for i in self.numbers(token)]
            got = b"".join([self.packed[i] for i in ids]), self.decoded(ids)
        if len(unit) <= LONGEST:
            if len(self.seen) >= REMEMBERED:
                self.seen, self.older = {}, self.seen
            self.seen[unit] = got
        return got

    def units(self, text: str) -> list[str]:
        """Units of a text, each without the mark that all of them begin with."""
        if self.mark and SPACE not in text and "  " not in text and text[0] != " " != text[-1]:
            return text.split(" ")
        text = self.prefix + text.replace(" ", SPACE)
        if self.whole:
            return [text]
        return [unit[len(self.mark) :] for unit in UNITS.findall(text)]

    def round_trip(self, text: str) -> tuple[bytes, str]:
        """Ids of a text as four-byte numbers, and the text decoded from them."""
        if not text:
            return b"", ""
        slow = self.unit
        parts = [self.seen.get(u) or slow(u) for u in self.units(text)]
        ids, back = b"".join([p[0] for p in parts]), "".join([p[1] for p in parts])
        return ids, back[len(self.prefix) :] if back.startswith(" ") else back


UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_loaded: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    """The vocabulary, read once per process."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def encoded(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, ``ids`` without begin and end, and ``decoded``, read back from the ids.

    Null texts are empty; an empty text has no ids; repeated rows and keys are
    encoded one by one; an empty table gives an empty result; other columns are
    not read. ``path`` is a model file that every executor has.
    """
    bounded(docs.sparkSession)
    rows = docs.select(docs[f"`{key}`"].alias("key"), docs[f"`{text}`"].alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(path)
        for batch in batches:
            done = [pieces.round_trip(t or "") for t in batch.column(1).to_pylist()]
            offsets = np.zeros(len(done) + 1, "<i4")
            np.cumsum([len(ids) // 4 for ids, _ in done], out=offsets[1:])
            values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join([x[0] for x in done]))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), values), pa.array([x[1] for x in done], pa.string())],
                names=["key", "ids", "decoded"],
            )

    return rows.mapInArrow(run, f"key {kind}, ids array<int>, decoded string").withColumnRenamed("key", key)


def library(path: str) -> sentencepiece.SentencePieceProcessor:
    """The library's own reader of the same file, to compare with."""
    return sentencepiece.SentencePieceProcessor(model_file=path)
