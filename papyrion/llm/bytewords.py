"""Words of whole texts, found and hashed over UTF-8 bytes with numpy.

An Arrow string column is already one buffer of UTF-8 bytes.  Word limits that
are ASCII classes can be found in those bytes directly: every byte of a longer
code point is at least 0x80.  A word's hash is a polynomial over its bytes,
taken as a difference of prefix sums, so no word is ever made a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Work on about this many bytes at a time, so that temporaries stay in cache.
PIECE = 1 << 20
#: Hash about so many bytes at a time, so that tables of powers and sums are small.
_WINDOW = 1 << 18
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_M64 = (1 << 64) - 1


def _class(separators: str) -> np.ndarray:
    out = np.ones(256, bool)
    out[[ord(c) for c in separators]] = False
    return out


#: Bytes of words that match ``[^\x20\x09-\x0D]+``.
SPACED = _class(" \t\n\x0b\x0c\r")
#: Bytes of words that match ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z is lower case.
ALNUM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
#: A-Z to a-z, other bytes unchanged.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (splitmix64's end)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


#: One 64-bit value for each byte.
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_VALUE_LOWER = _VALUE[LOWER]


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Piece:
    """Some whole rows of a column: their bytes, and where each row's bytes begin."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets
        self.rows = len(offsets) - 1

    def words(self, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, offsets): words' byte limits, and where each row's words begin."""
        m = is_word[self.data]
        if not len(m):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(self.rows + 1, np.int64)
        begins, finishes = m.copy(), m.copy()
        begins[1:] &= ~m[:-1]
        finishes[:-1] &= ~m[1:]
        edges = self.offsets[:-1][self.offsets[1:] > self.offsets[:-1]]
        begins[edges] = m[edges]
        last = np.append(edges[1:], len(m)) - 1
        finishes[last] = m[last]
        starts = np.flatnonzero(begins)
        return starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, self.offsets)

    def hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
        """A 64-bit hash of each [start, end) span; spans must be in order."""
        out = np.empty(len(starts), np.uint64)
        value, at = _VALUE_LOWER if lower else _VALUE, 0
        while at < len(starts):
            base = int(starts[at])
            to = max(at + 1, int(np.searchsorted(ends, base + _WINDOW, "right")))
            n = int(ends[at:to].max()) - base
            up, down = _powers(1 << max(16, (n + 1).bit_length()))
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(value[self.data[base : base + n]] * up[:n], out=sums[1:])
            s, e = starts[at:to] - base, ends[at:to] - base
            out[at:to] = (sums[e] - sums[s]) * down[s]
            at = to
        return mix(out ^ (ends - starts).astype(np.uint64))


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[Piece]:
    """The rows of a string column in order, in pieces of about ``limit`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield Piece(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of one row's word hashes.

    Fewer than k words are one shingle; no words are none.
    """
    n = len(hashes)
    if not n:
        return hashes
    k = min(k, n)
    out = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        out = out * np.uint64(0xD1342543DE82EF95) + hashes[j : n - k + 1 + j]
    out = mix(out)
    out.sort()
    return out[np.append(True, out[1:] != out[:-1])]
