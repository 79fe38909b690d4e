"""Whole columns of text as one byte array: words and hashes without a loop over characters.

A column's UTF-8 bytes lie end to end in Arrow. Sums of table values times powers of an odd number,
modulo 2**64, give the hash of any stretch as a difference of two sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
CHUNK = 1 << 20  # bytes of text worked on at once, unless one text alone is longer


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(33)
    return x


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int, which: str) -> np.ndarray:
    have = _POWERS.get(which)
    if have is None or len(have) < n:
        factor = BASE if which == "up" else pow(BASE, -1, 1 << 64)
        size = max(n, CHUNK + 1)
        steps = np.full(size, factor, np.uint64)
        steps[0] = 1
        have = _POWERS[which] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


class Hasher:
    """Hashes of any stretches of a byte array."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        values = (_LOWER if lower else _TABLE)[data]
        values *= _powers(len(data), "up")
        np.cumsum(values, out=self.sums[1:])
        self.down = _powers(len(data) + 1, "down")

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, size: int = CHUNK):
    """(first row, last row, bytes, offsets) of stretches of rows of about ``size`` bytes."""
    data, offsets = buffers(column)
    first, n = 0, len(column)
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal stretches of True bytes; none crosses a row's end."""
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    first = np.zeros(n + 1, bool)
    first[offsets] = True  # a row's first byte begins a run even if the byte before it is inside
    begins = inside & first[:n]
    begins[1:] |= inside[1:] & ~inside[:-1]
    start = np.flatnonzero(begins)
    ends = inside & np.append(first[1:n], True)
    ends[:-1] |= inside[:-1] & ~inside[1:]
    end = np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return start, end, row


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the words between ASCII white space."""
    return runs(~_SPACE[data], offsets)


def shingles(word: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each row's n-word shingles; a shorter row is one shingle as a whole."""
    total = len(word)
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    factors = [np.uint64(pow(BASE, 2 * i + 3, 1 << 64)) for i in range(n)]
    count = np.bincount(row)
    sizes = count[count > 0]
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    length = np.minimum(sizes, n)
    in_row = np.repeat(sizes, sizes)
    at = np.arange(total) - np.repeat(first, sizes)
    keep = np.where(in_row >= n, at <= in_row - n, at == 0)
    start = np.flatnonzero(keep)
    size = np.repeat(length, sizes)[start]
    value = size.astype(np.uint64)
    for i in range(n):
        there = i < size
        value += np.where(there, word[np.where(there, start + i, 0)] * factors[i], np.uint64(0))
    return mix(value), row[start]
