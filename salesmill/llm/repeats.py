"""Repeated passages of documents, found in a run-compressed Burrows-Wheeler index.

A byte goes if it lies in a string of ``length`` bytes that also starts in a
document with a smaller key. No string is looked at by itself:

1. Every window of ``length`` bytes has an anchor, its smallest hashed stretch
   of ``ANCHOR`` bytes. Equal windows have equal anchors at equal places, so
   windows fall into a tenth as many runs, and only runs whose anchor stands in
   several documents can hold a repeat. Tasks find these from the anchors'
   hashes alone.
2. The bytes under such runs go to the bucket of their anchor, equal ones of a
   chunk once. The bucket sorts all their suffixes and takes the Burrows-Wheeler
   transform. Only at the ends of its runs, which are few in repetitive text,
   the common prefix with the suffix before is compared and sampled; along the
   text it shrinks by one from sample to sample, which streams it to every
   suffix. Suffixes between two places where it is below ``length`` start with
   the same window, and the smallest key among them decides.
3. Chunks take the answers for their runs and cut the bytes.

Documents are dealt to chunks by key (those without one by their text), and chunks and buckets meet in packets of
packed arrays. A document equal to one with a smaller key goes whole and takes
no part. Anchors of very many documents are spread by window, so that no bucket
gets a hot line with all its surroundings.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmill.session import shared_dir

from .batches import bounded
from .hashing import U, mixed, running, slices, stretch

LENGTH, ANCHOR = 50, 32
#: Documents from which on an anchor is spread by window.
HOT = 1000
#: Bytes of an anchor's hash that are compared at first; equal ones by chance only cost a closer look.
HASH_BYTES = 5
#: Bytes of text in a chunk at least, and the mean bytes of text a chunk has for one bucket beyond that.
CHUNK, PACKET = 1 << 20, 1 << 14
#: Bytes of text in a chunk at most (or of one document), and of text that is hashed or indexed at once.
LARGEST, STEP = 1 << 23, 1 << 19
#: Stands for a missing key in comparisons; whether a key was missing is carried beside it.
LAST = (1 << 63) - 1
PACKET_TYPE = "chunk int, bucket int, data binary"


class Runs:
    """Runs of windows of the documents of a chunk that have the same anchor.

    anchor: 64-bit hash; low, high: first and last window start and at: place
    of the anchor, in the joined text; doc: number of the document.
    """

    def __init__(self, texts: list[bytes], length: int):
        self.text = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts])
        parts = [self._of(texts[a:b], a, int(self.ends[a - 1]) if a else 0, length) for a, b in slices(map(len, texts), STEP)]
        join = lambda i, kind: np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, kind)
        self.anchor, self.low, self.high, self.at, self.doc, self.bytes = (join(i, k) for i, k in enumerate([U, int, int, int, int, U]))
        self.length = length

    @staticmethod
    def _of(texts: list[bytes], number: int, shift: int, length: int):
        data = np.frombuffer(b"".join(texts), np.uint8)
        n = len(data)
        ends = np.cumsum([len(t) for t in texts])
        if n < length:
            return (np.zeros(0, U), *[np.zeros(0, int)] * 4, np.zeros(0, U))
        sums = running(data)
        starts = np.arange(n - ANCHOR + 1)
        hashes = stretch(sums, starts, starts + ANCHOR)
        bits = U(max(1, n.bit_length()))
        least = (hashes >> bits << bits) | starts.astype(U)
        # Smallest of the stretches of each window, by doubling the width.
        width, want = 1, length - ANCHOR + 1
        while width < want:
            step = min(width, want - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        window = np.arange(n - length + 1)
        doc = np.searchsorted(ends, window, side="right")
        fits = window + length <= ends[doc]
        window, doc = window[fits], doc[fits]
        at = (least[window] & ((U(1) << bits) - U(1))).astype(np.int64)
        if not len(at):
            return (np.zeros(0, U), *[np.zeros(0, int)] * 4, np.zeros(0, U))
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        low, high = window[first], window[np.concatenate((first[1:], [len(at)])) - 1]
        at = at[first]
        return hashes[at], low + shift, high + shift, at + shift, doc[first] + number, stretch(sums, low, high + length)

    def spread(self, hot: np.ndarray) -> None:
        """Replace the runs marked ``hot`` by one run for each of their windows, anchored in itself."""
        if not hot.any():
            return
        many = self.high[hot] - self.low[hot] + 1
        low = np.repeat(self.low[hot], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        doc = np.repeat(self.doc[hot], many)
        codes = np.zeros(len(low), U)
        for k in range(self.length):
            codes = codes * U(0x9E3779B97F4A7C15) + self.text[low + k].astype(U) + U(1)
        codes = mixed(codes)
        old = ~hot
        self.low, self.high = np.concatenate((self.low[old], low)), np.concatenate((self.high[old], low))
        self.at, self.doc = np.concatenate((self.at[old], low - 1)), np.concatenate((self.doc[old], doc))
        self.anchor, self.bytes = np.concatenate((self.anchor[old], codes)), np.concatenate((self.bytes[old], codes))

    def keep(self, mask: np.ndarray) -> None:
        for name in ("anchor", "low", "high", "at", "doc", "bytes"):
            setattr(self, name, getattr(self, name)[mask])


def short(anchor: np.ndarray) -> np.ndarray:
    return anchor >> U(64 - 8 * HASH_BYTES)


def bucket_edges(values: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's share of the sorted short hashes begins; one more for the end."""
    limits = ((np.arange(buckets, dtype=U) << U(8 * HASH_BYTES)) + U(buckets - 1)) // U(buckets)
    return np.concatenate((np.searchsorted(values, limits), [len(values)]))


#: Packets below this size are not worth compressing. There are at most as many of them as anchors.
LITTLE = 512
ENTRY = HASH_BYTES + 2


def squeezed(raw: bytes, level: int = 1) -> bytes:
    return raw + b"\0" if len(raw) < LITTLE else zstandard.compress(raw, level) + b"\1"


def unsqueezed(data: bytes) -> bytes:
    return zstandard.decompress(data[:-1]) if data[-1] else data[:-1]


def packed_hashes(values: np.ndarray, counts: np.ndarray, edges: np.ndarray) -> list[tuple[int, bytes]]:
    """Packets of hashes and counts: one for each bucket that has any, hashes lying between its edges."""
    rows = np.empty((len(values), ENTRY), np.uint8)
    rows[:, :HASH_BYTES] = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
    rows[:, HASH_BYTES:] = np.minimum(counts, 65535).astype("<u2").view(np.uint8).reshape(-1, 2)
    raw = rows.tobytes()
    some = np.flatnonzero(edges[1:] > edges[:-1])
    cuts = zip(some.tolist(), edges[some].tolist(), edges[some + 1].tolist())
    # Byte by byte the hashes compress; little packets keep their rows.
    return [
        (b, raw[i * ENTRY : j * ENTRY] + b"\0" if (j - i) * ENTRY < LITTLE else zstandard.compress(rows[i:j].T.tobytes(), 1) + b"\1") for b, i, j in cuts
    ]


def unpacked_hashes(packets: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and counts of all packets, one after the other, and how many each holds."""
    parts = [np.frombuffer(zstandard.decompress(d[:-1]), np.uint8).reshape(ENTRY, -1).T.tobytes() if d[-1] else d[:-1] for d in packets]
    rows = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, ENTRY)
    hashes = np.zeros((len(rows), 8), np.uint8)
    hashes[:, :HASH_BYTES] = rows[:, :HASH_BYTES]
    counts = np.ascontiguousarray(rows[:, HASH_BYTES:]).view("<u2").ravel()
    return hashes.view("<u8").ravel().astype(U), counts, np.fromiter(map(len, parts), np.int64, len(parts)) // ENTRY


def unique_anchors(runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Short hashes of all anchors of a chunk, ascending, and in how many documents each stands."""
    values = short(runs.anchor)
    order = np.lexsort((runs.doc, values))
    values, doc = values[order], runs.doc[order]
    once = np.concatenate(([True], (values[1:] != values[:-1]) | (doc[1:] != doc[:-1]))) if len(values) else np.zeros(0, bool)
    values = values[once]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, int)
    return values[first], np.diff(np.append(first, len(values)))


def shared_anchors(rows: pd.DataFrame, hot: int) -> pd.DataFrame:
    """For one bucket: per packet and hash whether one document has it (0), several (1) or very many (2)."""
    values, counts, sizes = unpacked_hashes(list(rows["data"]))
    found, place = np.unique(values, return_inverse=True)
    docs = np.bincount(place, weights=counts, minlength=len(found))
    state = ((docs > 1).astype(np.uint8) + (docs >= hot))[place].astype(np.uint8).tobytes()
    ends = np.cumsum(sizes).tolist()
    data = [squeezed(state[i:j]) for i, j in zip([0, *ends], ends)]
    return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"], "data": data})


class Entries:
    """Distinct byte strings under the runs that are shared, with the smallest key of each."""

    def __init__(self, runs: Runs, keys: np.ndarray):
        self.runs = runs
        key = keys[runs.doc]
        place = runs.at - runs.low
        order = np.lexsort((key, place, runs.bytes, runs.anchor))
        a, b, p = runs.anchor[order], runs.bytes[order], place[order]
        fresh = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (p[1:] != p[:-1]))) if len(a) else np.zeros(0, bool)
        self.of = np.empty(len(a), np.int64)
        self.of[order] = np.cumsum(fresh) - 1
        self.first = order[fresh]  # ascending by anchor
        self.smallest = key[self.first]

    def packets(self, buckets: int) -> list[tuple[int, bytes]]:
        r, first = self.runs, self.first
        edges = bucket_edges(short(r.anchor[first]), buckets)
        out = []
        for bucket in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
            a, b = edges[bucket], edges[bucket + 1]
            runs = first[a:b]
            low, n = r.low[runs], r.high[runs] - r.low[runs] + r.length
            take = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            head = np.concatenate((n.astype("<u2"), (r.at[runs] - low).astype("<i2").view("<u2")))
            raw = (b - a).item().to_bytes(4, "little") + head.tobytes() + self.smallest[a:b].astype("<i8").tobytes() + r.text[take].tobytes()
            out.append((bucket, squeezed(raw, 3)))
        return out


def unpacked_entries(data: bytes):
    raw = unsqueezed(data)
    n = int.from_bytes(raw[:4], "little")
    head = np.frombuffer(raw, "<u2", 2 * n, 4)
    return head[:n].astype(np.int64), head[n:].view("<i2").astype(np.int64), np.frombuffer(raw, "<i8", n, 4 + 4 * n), raw[4 + 12 * n :]


SYMBOLS = 7


def suffixes(text: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of strings joined in ``text``, each ending before its place in ``ends``.

    A string's end sorts before all bytes, equal suffixes by their place. Also
    the ranks by the first 7, 14, 28, ... bytes, up to ``depth``.
    """
    n = len(text)
    rest = np.repeat(ends, np.diff(np.concatenate(([0], ends)))) - np.arange(n)
    padded = np.concatenate((text.astype(U) + U(1), np.zeros(SYMBOLS, U)))
    code = np.zeros(n, U)
    for k in range(SYMBOLS):
        code = (code << U(9)) | np.where(rest > k, padded[k : k + n], U(0))
    rank = np.unique(code, return_inverse=True)[1].astype(np.int64) + 1
    ranks, known = [rank], SYMBOLS
    while known < depth:
        after = np.zeros(n, np.int64)
        more = np.flatnonzero(rest > known)
        after[more] = rank[more + known]
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        ranks.append(rank)
        known *= 2
    return np.argsort(rank, kind="stable"), ranks


def common(ranks: list[np.ndarray], rest: np.ndarray, a: np.ndarray, b: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes ``a`` and ``b``, from the ranks."""
    a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    left = np.minimum(rest[a], rest[b])
    for level in range(len(ranks) - 1, -1, -1):
        step = SYMBOLS << level
        same = np.flatnonzero(left - out >= step)
        same = same[ranks[level][a[same]] == ranks[level][b[same]]]
        out[same] += step
        a[same] += step
        b[same] += step
    for _ in range(SYMBOLS):
        same = np.flatnonzero(left > out)
        same = same[text[a[same]] == text[b[same]]]
        if not len(same):
            break
        out[same] += 1
        a[same] += 1
        b[same] += 1
    return out


def smallest_keys(text: np.ndarray, sizes: np.ndarray, keys: np.ndarray, length: int) -> np.ndarray:
    """For every byte at which a window of ``length`` starts inside its string: the smallest key
    of a string that holds the window. Other bytes get their own string's key."""
    ends = np.cumsum(sizes)
    n = len(text)
    string = np.repeat(np.arange(len(sizes)), sizes)
    rest = ends[string] - np.arange(n)
    order, ranks = suffixes(text, ends, int(sizes.max()))
    # The transform: the byte before each suffix; a string's first byte has an end mark of its own before it.
    starts = ends - sizes
    head = np.zeros(n, bool)
    head[starts] = True
    before = text[order - 1]
    run = np.concatenate(([True], (before[1:] != before[:-1]) | head[order[1:]] | head[order[:-1]]))
    at = np.flatnonzero(run)
    sampled = common(ranks, rest, order[at[1:]], order[at[1:] - 1], text)
    # Along the text from sample to sample the common prefix shrinks by one a byte.
    sample = np.full(n, -1, np.int64)
    sample[order[at[0]]] = 0
    sample[order[at[1:]]] = sampled
    place = np.arange(n)
    latest = np.maximum.accumulate(np.where(sample >= 0, place, -1))
    prefix = np.maximum(sample[latest] - (place - latest), 0)
    border = prefix[order] < length
    border[0] = True
    least = np.minimum.reduceat(keys[string[order]], np.flatnonzero(border))
    out = np.empty(n, np.int64)
    out[order] = least[np.cumsum(border) - 1]
    return np.where(rest >= length, out, keys[string])


def hashed(packet: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each string of a packet, and of its anchor; a spread window is its own."""
    sizes, place, _, raw = packet
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sums = running(np.frombuffer(raw, np.uint8))
    whole, spread = stretch(sums, starts, ends), place < 0
    low = starts + np.where(spread, 0, place)
    return whole, np.where(spread, whole, stretch(sums, low, np.where(spread, ends, low + ANCHOR)))


def answers(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """For one bucket: per packet a bit for each window, set if a document with a smaller key has it too."""
    parts = [unpacked_entries(d) for d in rows["data"]]
    sizes, place, keys = (np.concatenate([p[i] for p in parts]) for i in range(3))
    whole, anchor = (np.concatenate(x) for x in zip(*map(hashed, parts)))
    text = np.frombuffer(b"".join([p[3] for p in parts]), np.uint8)
    starts = np.cumsum(sizes) - sizes
    order = np.lexsort((keys, place, whole, anchor))
    a, w, p = anchor[order], whole[order], place[order]
    new_anchor = np.concatenate(([True], a[1:] != a[:-1]))
    fresh = new_anchor | np.concatenate(([True], (w[1:] != w[:-1]) | (p[1:] != p[:-1])))
    first = order[fresh]  # one of equal strings, with the smallest key; ascending by anchor
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(fresh) - 1
    windows = sizes - length + 1
    begin = np.cumsum(windows) - windows
    out = keys[first][of].repeat(windows)  # by string, then window
    # Strings whose anchor has no other string need no index: all their windows have the string's smallest key.
    several = np.add.reduceat(fresh.astype(np.int64), np.flatnonzero(new_anchor))[np.cumsum(new_anchor) - 1][fresh] > 1
    indexed = np.flatnonzero(several)
    # Equal windows have the same anchor, so anchors are indexed a few at a time.
    cuts = np.flatnonzero(np.concatenate(([True], anchor[first[indexed]][1:] != anchor[first[indexed]][:-1]))) if len(indexed) else []
    held = np.cumsum(sizes[first[indexed]])
    by_group = np.argsort(of, kind="stable")
    group_at = np.searchsorted(of[by_group], np.arange(len(first) + 1))
    i = 0
    while i < len(indexed):
        limit = (held[i - 1] if i else 0) + STEP
        # As many whole anchors as fit, one at least.
        ends = np.append(cuts[np.searchsorted(cuts, i, side="right") :], len(indexed))
        j = int(ends[max(0, np.searchsorted(held[ends - 1], limit, side="right") - 1)])
        mine = first[indexed[i:j]]
        n = sizes[mine]
        take = np.repeat(starts[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        least = smallest_keys(text[take], n, keys[mine], length)
        # To every string equal to one of these.
        groups = np.repeat(np.arange(i, j), np.diff(group_at)[indexed[i:j]])
        strings = np.concatenate([by_group[group_at[g] : group_at[g + 1]] for g in indexed[i:j]])
        m = windows[strings]
        offset = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        out[np.repeat(begin[strings], m) + offset] = least[np.repeat((np.cumsum(n) - n)[groups - i], m) + offset]
        i = j
    bits = out < keys.repeat(windows)
    edges = np.cumsum([p[0].sum() - len(p[0]) * (length - 1) for p in parts])
    data = [squeezed(np.packbits(x).tobytes()) for x in np.split(bits, edges[:-1])]
    return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"], "data": data})


def cleaned(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, keep: tuple[str, ...] = (), whole_characters: bool = False, hot: int = HOT
) -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans, kept (bytes), and the columns ``keep``.

    Texts are UTF-8 bytes, null being empty; keys are whole numbers, a null key
    counts as the largest and is the same as 2**63 - 1; rows with the same key are the same document and
    take nothing from each other; texts below ``length`` bytes stay; an empty
    table gives an empty result. Matches are judged on the input. With
    ``whole_characters`` a character goes only if all its bytes do. Columns
    ``keep`` may not have the names of the result's.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    bounded(spark)
    if {k.lower() for k in keep} & {"n_bytes", "n_removed", "n_spans", "kept", "chunk", "key", "none", "raw"}:
        raise ValueError("a kept column has the name of one of the result's")
    number = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LAST))
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    chunks = max(1, math.ceil(total / min(LARGEST, max(CHUNK, math.sqrt(PACKET * total)))))
    # Rows without a key would all meet in one chunk; a null is skipped by the hash.
    spread = F.when(F.col(f"`{key}`").isNull(), raw)
    chunk = F.pmod(F.xxhash64(number, spread), F.lit(chunks)).cast("int")
    none = F.col(f"`{key}`").isNull()
    rows = docs.select(chunk.alias("chunk"), number.alias("key"), none.alias("none"), raw.alias("raw"), *[F.col(f"`{c}`") for c in keep])
    # Documents equal to one with a smaller key, by two hashes and the length.
    narrow = rows.select("chunk", "key", F.xxhash64("raw").alias("x"), F.md5("raw").alias("m"), F.octet_length("raw").alias("n")).where(F.col("n") >= length)
    first = narrow.groupBy("x", "m", "n").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    same = narrow.join(first.withColumnsRenamed({"x": "_x", "m": "_m", "n": "_n"}), (F.col("x") == F.col("_x")) & (F.col("m") == F.col("_m")) & (F.col("n") == F.col("_n")))
    # A key may have other texts too, so a copy is named by key and text.
    named = F.concat_ws(" ", F.col("key").cast("string"), F.col("m")).cast("binary")
    copies = same.where("key > first").select("chunk", F.lit(-1).alias("bucket"), named.alias("data")).distinct().checkpoint()

    def chunk_runs(docs: pd.DataFrame, packets: pd.DataFrame):
        """Documents in a fixed order, their copies of others marked, the runs of the rest, and packets by bucket."""
        docs = docs.sort_values(["key", "none", "raw"], ignore_index=True)
        gone = {bytes(d) for b, d in zip(packets["bucket"], packets["data"]) if b < 0}
        keys = {int(d.split()[0]) for d in gone}
        copy = np.zeros(len(docs), bool)
        for i in np.flatnonzero(docs["key"].isin(keys).to_numpy() & (docs["raw"].map(len).to_numpy() >= length)):
            copy[i] = f"{docs['key'].iloc[i]} {hashlib.md5(docs['raw'].iloc[i]).hexdigest()}".encode() in gone
        runs = Runs([b"" if c else r for c, r in zip(copy, docs["raw"])], length)
        return docs, copy, runs

    def by_bucket(packets: pd.DataFrame, kind: int) -> list[bytes]:
        mine = packets[(packets["bucket"] >= 0) & (packets["kind"] == kind)].sort_values("bucket")
        return [unsqueezed(d) for d in mine["data"]]

    def propose(_, docs: pd.DataFrame, packets: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame({"chunk": [], "bucket": [], "data": []})
        values, counts = unique_anchors(chunk_runs(docs, packets)[2])
        found = packed_hashes(values, counts, bucket_edges(values, chunks))
        return pd.DataFrame([(docs["chunk"].iloc[0], b, d) for b, d in found], columns=["chunk", "bucket", "data"])

    def entries_of(docs: pd.DataFrame, packets: pd.DataFrame):
        docs, copy, runs = chunk_runs(docs, packets)
        values, _ = unique_anchors(runs)
        state = np.frombuffer(b"".join(by_bucket(packets, 0)), np.uint8)
        mine = state[np.searchsorted(values, short(runs.anchor))] if len(values) else np.zeros(0, np.uint8)
        runs.keep(mine > 0)
        runs.spread((mine == 2)[mine > 0])
        return docs, copy, Entries(runs, docs["key"].to_numpy(np.int64))

    def inquire(_, docs: pd.DataFrame, packets: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame({"chunk": [], "bucket": [], "data": []})
        found = entries_of(docs, packets)[2].packets(chunks)
        return pd.DataFrame([(docs["chunk"].iloc[0], b, d) for b, d in found], columns=["chunk", "bucket", "data"])

    def cut(_, docs: pd.DataFrame, packets: pd.DataFrame) -> pd.DataFrame:
        docs, copy, entries = entries_of(docs, packets)
        runs = entries.runs
        windows = runs.high - runs.low + 1
        size = windows[entries.first]
        # Bits come packed bucket by bucket; entries are in the order of buckets.
        edges = bucket_edges(short(runs.anchor[entries.first]), chunks)
        bits, ahead_of, parts = by_bucket(packets, 1), np.concatenate(([0], np.cumsum(size))), []
        for mine, b in zip(bits, np.flatnonzero(edges[1:] > edges[:-1]).tolist()):
            parts.append(np.unpackbits(np.frombuffer(mine, np.uint8), count=int(ahead_of[edges[b + 1]] - ahead_of[edges[b]])))
        bit = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        keys = docs["key"].to_numpy(np.int64)
        # A document behind the smallest of an entry loses the whole run, the smallest what the bits say.
        behind = keys[runs.doc] > entries.smallest[entries.of]
        low, high = [runs.low[behind]], [runs.high[behind]]
        ahead = np.flatnonzero(~behind)
        if len(ahead):
            marked = np.flatnonzero(bit)
            begin = (np.cumsum(size) - size)[entries.of[ahead]]
            i, j = np.searchsorted(marked, begin), np.searchsorted(marked, begin + windows[ahead])
            n = j - i
            at = np.repeat(i - (np.cumsum(n) - n), n) + np.arange(n.sum())
            low.append(marked[at] - np.repeat(begin, n) + np.repeat(runs.low[ahead], n))
            high.append(low[-1])
        depth = np.zeros(len(runs.text) + 1, np.int32)
        np.add.at(depth, np.concatenate(low), 1)
        np.add.at(depth, np.concatenate(high) + length, -1)
        cover = np.cumsum(depth[:-1], dtype=np.int32) > 0
        out, at = [], 0
        for raw, whole in zip(docs["raw"], copy):
            if whole:
                out.append((len(raw), len(raw), 1, b""))
                continue
            mask = cover[at : at + len(raw)]
            at += len(raw)
            if not mask.any():
                out.append((len(raw), 0, 0, raw))
                continue
            data = np.frombuffer(raw, np.uint8)
            if whole_characters:
                lead = np.flatnonzero((data & 0xC0) != 0x80)
                mask = np.repeat(np.logical_and.reduceat(mask, lead), np.diff(np.append(lead, len(data))))
            spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
            out.append((len(raw), int(mask.sum()), spans, data[~mask].tobytes()))
        result = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])
        result.insert(0, "key", docs["key"])
        result.insert(1, "none", docs["none"])
        return result.assign(**{c: docs[c] for c in keep})

    own = lambda kind, of: of.withColumn("kind", F.lit(kind))
    # The texts are dealt to chunks once; the three steps below share that exchange.
    texts = rows.groupBy("chunk")
    marks = own(-1, copies)
    asked = texts.cogroup(marks.groupBy("chunk")).applyInPandas(propose, PACKET_TYPE)
    states = own(0, asked.groupBy("bucket").applyInPandas(lambda rows: shared_anchors(rows, hot), PACKET_TYPE))
    known = marks.unionByName(states)
    inquiries = texts.cogroup(known.groupBy("chunk")).applyInPandas(inquire, PACKET_TYPE)
    replies = own(1, inquiries.groupBy("bucket").applyInPandas(lambda rows: answers(rows, length), PACKET_TYPE))
    kinds = {c: docs.schema[c].dataType.simpleString() for c in keep}
    schema = "key long, none boolean, n_bytes long, n_removed long, n_spans long, kept binary" + "".join(f", `{c}` {k}" for c, k in kinds.items())
    out = texts.cogroup(known.unionByName(replies).groupBy("chunk")).applyInPandas(cut, schema)
    kind = docs.schema[key].dataType.simpleString()
    back = F.when(~F.col("none"), F.col("key")).cast(kind)
    return out.select(back.alias(key), "n_bytes", "n_removed", "n_spans", "kept", *[F.col(f"`{c}`") for c in keep])
