"""Words of Arrow text columns as 64-bit hashes, without a Python object for each word.

A word's hash is a polynomial over its bytes, each byte mapped to a random number, modulo 2^64. Prefix sums over a
piece of text give the hashes of all its words at once: the power of a word's first place is divided out, which
an odd base allows. Pieces hold a few MB, so memory does not depend on the batch; longer texts are cut at blanks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_random = np.random.default_rng(8675309)
_BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[int, np.ndarray] = {}


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        size = max(PIECE + 1, n)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = _powers[int(base)] = np.cumprod(known, dtype=np.uint64)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, data = column.buffers()
    if len(column) == 0 or where is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(where, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)), offsets


def ranges(offsets: np.ndarray, piece: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``piece`` bytes; a longer text is a run of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + piece, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def span_hashes(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Hashes of the byte runs between consecutive edges, upper and lower case apart."""
    part = data[edges[0]:edges[-1]]
    sums = np.empty(len(part) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[part] * _power_table(_BASE, len(part)), out=sums[1:])
    at = edges - edges[0]
    hashes = (sums[at[1:]] - sums[at[:-1]]) * _power_table(_INVERSE, len(part) + 1)[at[:-1]]
    return mix(hashes + np.diff(at).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """Words of the texts of one run: hash, index of the text, first and last byte + 1; words and first word of a text."""

    def __init__(self, hashes: np.ndarray, text: np.ndarray, start: np.ndarray, stop: np.ndarray, texts: int):
        self.hashes, self.text, self.start, self.stop = hashes, text, start, stop
        self.counts = np.bincount(text, minlength=texts)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])


def _one_piece(data: np.ndarray, bounds: np.ndarray, at: int) -> tuple[np.ndarray, ...]:
    n = len(data)
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    blank = BLANK[data]
    inside = ~blank
    begins = inside.copy()
    begins[1:] &= blank[:-1]
    heads = bounds[:-1][bounds[:-1] < n]
    begins[heads] = inside[heads]
    ends = inside.copy()
    ends[:-1] &= blank[1:]
    heads = heads[heads > 0] - 1
    ends[heads] = inside[heads]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * _power_table(_BASE, n), out=sums[1:])
    hashes = (sums[stop] - sums[start]) * _power_table(_INVERSE, n)[start]
    hashes = mix(hashes + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(bounds, start, side="right") - 1, start + at, stop + at


def words(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> Words:
    """Words of the texts ``lo`` to ``hi``, with A-Z in lower case; ``text`` counts from ``lo``."""
    a, b = int(offsets[lo]), int(offsets[hi])
    if b - a <= 2 * PIECE or hi - lo > 1:
        return Words(*_one_piece(LOWER[data[a:b]], offsets[lo:hi + 1] - a, a), hi - lo)
    parts = []
    while a < b:  # one long text
        cut = min(a + PIECE, b)
        if cut < b:
            blanks = np.flatnonzero(BLANK[data[a:cut]])
            if len(blanks):
                cut = a + int(blanks[-1]) + 1
            while cut < b and not len(blanks):  # a word longer than a piece stays whole
                blanks = np.flatnonzero(BLANK[data[cut:cut + PIECE]])
                cut = min(cut + (int(blanks[0]) + 1 if len(blanks) else PIECE), b)
        parts.append(_one_piece(LOWER[data[a:cut]], np.array([0, cut - a]), a))
        a = cut
    return Words(*(np.concatenate(x) for x in zip(*parts)), 1)


def spans(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased bytes of the given spans one after another, and where each begins."""
    size = stop - start
    ends = np.cumsum(size)
    where = np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    return LOWER[data[where]], np.concatenate([[0], ends])


def tails(data: np.ndarray, found: Words) -> np.ndarray:
    """The last two bytes of each word as a number."""
    before = np.where(found.stop - found.start > 1, LOWER[data[np.maximum(found.stop - 2, 0)]], 0).astype(np.int64)
    return before * 256 + LOWER[data[found.stop - 1]]
