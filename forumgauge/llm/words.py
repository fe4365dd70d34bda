"""Words of Arrow string columns, as numpy arrays.

A word is a run of bytes other than the space and 0x09-0x0D.  All functions work
on whole texts; ``chunks`` only decides how many rows are handled at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
GRAM_BASE = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(count: int) -> list[np.ndarray]:
    """The base's powers and their inverses, ``count`` of them at least; kept for the next call."""
    if len(_POWERS[0]) < count:
        for i, x in enumerate((_BASE, _BASE_INVERSE)):
            table = np.full(count + count // 4, x, dtype=np.uint64)
            table[0] = 1
            _POWERS[i] = np.cumprod(table)
    return _POWERS


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows [first, last) of about ``limit`` bytes, with their bytes and offsets from 0."""
    data, offsets = buffers(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the row it is in."""
    word = ~separator[data]
    if not len(word):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] = word[cuts]
    last[cuts - 1] = word[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of 64-bit values, the same wherever the range lies."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word; ``lower`` takes A-Z as a-z."""
    return range_hashes((_BYTE_LOWER if lower else _BYTE)[data], starts, ends)


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words, whatever rows they are in."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out, power = np.zeros(count, np.uint64), 1
    for i in range(size):
        out += words[i:i + count] * np.uint64(power)
        power = power * int(GRAM_BASE) % (1 << 64)
    return mix(out + np.uint64(size))


def row_bounds(rows: np.ndarray, count: int) -> np.ndarray:
    """Where each of ``count`` rows begins in a sorted array of row numbers, and its end."""
    return np.searchsorted(rows, np.arange(count + 1))


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of each row's values."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
