"""Hashes of words and byte windows of many texts at once.

A polynomial in an odd number modulo 2**64 has inverse powers, so the hash of
any stretch of bytes is a difference of two running sums times one power,
wherever the stretch stands. Everything is a few passes of numpy.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15
U = np.uint64
#: Bytes of text worked on at once.
SLICE = 1 << 21
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U), np.ones(1, U))
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers (the finisher of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n."""
    global _powers
    if len(_powers[0]) <= n:
        both = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(max(n, SLICE) + 1, base, U)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        if n > 4 * SLICE:
            return both[0], both[1]  # for one very long text; not kept
        _powers = both[0], both[1]
    return _powers


def running(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``stretch`` takes hashes; one longer than ``data``."""
    out = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * powers(len(data))[0][: len(data)], out=out[1:])
    return out


def stretch(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from ``start`` to ``end``."""
    return mixed((sums[end] - sums[start]) * powers(len(sums))[1][start])


def slices(sizes: Iterable[int], most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``most`` bytes together, or of one text."""
    start = held = 0
    i = -1
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if i >= start:
        yield start, i + 1


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word, words being runs of bytes that are no ASCII white space."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    blank = BLANK[data]
    solid = np.concatenate(([False], ~blank, [False]))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return stretch(running(data), starts, ends), np.searchsorted(text_ends, starts, side="right")


def shingles(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of ``width`` words; a text of fewer words is one run."""
    hashes, text = words(texts)
    n = len(hashes)
    counts = np.bincount(text, minlength=len(texts)) if n else np.zeros(len(texts), np.int64)
    factors = mixed(np.arange(1, width + 1, dtype=U)) | U(1)
    short = np.flatnonzero((counts > 0) & (counts < width))
    first = np.cumsum(counts) - counts
    if n >= width:
        start = np.flatnonzero(text[: n - width + 1] == text[width - 1 :])
        runs = np.zeros(len(start), U)
        for k in range(width):
            runs += hashes[start + k] * factors[k]
    else:
        start, runs = np.zeros(0, np.int64), np.zeros(0, U)
    few = np.zeros(len(short), U)
    for k in range(width - 1):
        more = counts[short] > k
        few[more] += hashes[first[short[more]] + k] * factors[k]
    out = mixed(np.concatenate([runs, few + counts[short].astype(U)]))
    return out, np.concatenate([text[start], short])
