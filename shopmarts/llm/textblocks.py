"""Whole texts as byte arrays, in blocks of bounded size, and word hashes over them.

A word is a run of bytes other than 0x20 and 0x09-0x0D (the pattern ``[^\\x20\\x09-\\x0D]+``), which is
the same for UTF-8 bytes and for characters because those separators are ASCII.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
U64 = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def space_mask(data: np.ndarray) -> np.ndarray:
    """Marks the bytes that separate words."""
    return _SPACE[data]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _byte_codes(lower: bool) -> np.ndarray:
    codes = mix64(np.arange(1, 257, dtype=np.uint64) * U64(0xD1342543DE82EF95))
    if lower:
        codes[65:91] = codes[97:123]
    return codes


_CODES = {False: _byte_codes(False), True: _byte_codes(True)}


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES):
    """Yield (first row, end row, bytes, offsets) of whole rows, about ``block_bytes`` together."""
    data, offsets = text_arrays(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + block_bytes, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end
    pa.default_memory_pool().release_unused()


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words never cross rows."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~_SPACE[data]
    fresh = np.ones(n + 1, bool)  # no word goes on into this position
    fresh[1:n] = ~inside[:-1]
    fresh[offsets[:-1][offsets[:-1] < n]] = True
    start = np.flatnonzero(inside & fresh[:n])
    stop = np.ones(n, bool)
    stop[:-1] = ~inside[1:] | fresh[1:n]
    end = np.flatnonzero(inside & stop) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


class SpanHasher:
    """64-bit hashes of any spans of a byte block, from one running polynomial sum."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        n = len(data)
        powers = np.full(n, U64(_BASE))
        inverse = np.full(n + 1, U64(_BASE_INVERSE))
        if n:
            powers[0] = 1
        inverse[0] = 1
        np.cumprod(powers, out=powers)
        self.inverse = np.cumprod(inverse)
        powers *= _CODES[lower][data]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(powers, out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix64(h + (end - start).astype(np.uint64))


def gram_hashes(words: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every run of ``size`` words within one row."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(row[:n] == row[size - 1 :])
    h = words[first]
    for k in range(1, size):
        h = mix64(h * U64(0x9FB21C651E98DF25) + words[first + k])
    return h, first
