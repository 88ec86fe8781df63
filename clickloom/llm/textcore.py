"""Text inside a task, as NumPy arrays over UTF-8 bytes: words, hashes, windows.

Nothing here loops over words in Python.  A word is a run of bytes other than
``[\\x20\\x09-\\x0D]``; such bytes never occur inside a longer UTF-8 sequence.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64


def trim() -> None:
    """Give freed memory back to the system; a worker waiting for its next task else keeps it."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse, self.up, self.down = base, pow(base, -1, 1 << 64), np.ones(1, _U), np.ones(1, _U)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", self.base), ("down", self.inverse)):
                grown = np.full(size, base, _U)
                grown[0] = 1
                setattr(self, name, np.multiply.accumulate(grown))
        return self.up[:n], self.down[:n]


BYTE_POWERS = Powers(0x9E3779B97F4A7C15)
BYTE_VALUES = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))
WINDOW_POWERS = (Powers(0xC2B2AE3D27D4EB4F | 1), Powers(0x165667B19E3779F9 | 1))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row starts (one more entry than rows); null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), starts


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row starts) of consecutive rows of at most ``limit`` bytes, or of one longer row."""
    if not len(column):
        return
    data, starts = text_bytes(column)
    row, n = 0, len(column)
    while row < n:
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + limit, "right")) - 1)
        end = min(end, n)
        yield row, end, data[starts[row] : starts[end]], starts[row : end + 1] - starts[row]
        row = end


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop) of every word, and the index of each row's first word (one more entry than rows)."""
    return spans(~WHITE[data], starts)


def spans(solid: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of every stretch of solid bytes within a row."""
    rows = starts[:-1][starts[:-1] < starts[1:]]
    begin, last = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    begin[rows] = solid[rows]
    last[:-1] &= ~solid[1:]
    ends = starts[1:][starts[:-1] < starts[1:]] - 1
    last[ends] = solid[ends]
    start = np.flatnonzero(begin)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, starts)


class SpanHashes:
    """64-bit hashes of spans of the same bytes, however many times they are asked for."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = BYTE_POWERS(len(data) + 1)
        self.total = np.zeros(len(data) + 1, _U)
        np.cumsum(BYTE_VALUES[data] * up[:-1], out=self.total[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.total[stop] - self.total[start]) * self.down[start] + (stop - start).astype(_U))


def span_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span."""
    return SpanHashes(data)(start, stop)


def windows(hashes: np.ndarray, first: np.ndarray, size: int, kind: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``size`` consecutive words starting at each word, and whether they lie in one row."""
    n = len(hashes)
    value, inside = np.zeros(n, _U), np.zeros(n, bool)
    if n < size:
        return value, inside
    up, down = WINDOW_POWERS[kind](n + 1)
    total = np.zeros(n + 1, _U)
    np.cumsum(mix(hashes + _U(kind)) * up[:-1], out=total[1:])
    value[: n - size + 1] = mix((total[size:] - total[:-size]) * down[: n - size + 1])
    end = np.repeat(first[1:], np.diff(first))
    return value, np.arange(n) + size <= end


def run_hashes(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The hash that ``windows`` gives (kind 0) of runs of words of any length."""
    up, down = WINDOW_POWERS[0](len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, _U)
    np.cumsum(mix(hashes) * up[:-1], out=total[1:])
    return mix((total[stop] - total[start]) * down[start])


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` consecutive values, by doubling; the last ``size - 1`` entries are not meant."""
    out, span = values.copy(), 1
    while span < size:
        step = min(span, size - span)
        out[: len(out) - step] = np.minimum(out[: len(out) - step], out[step:])
        span += step
    return out


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and each row's first index."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))


def span_strings(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    """The bytes of each span as a string column."""
    size = stop - start
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    out = np.ascontiguousarray(data[at])
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out))
