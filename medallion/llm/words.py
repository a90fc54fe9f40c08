"""Words of Arrow text columns in numpy, whole columns at a time.

A text column is one byte buffer with row offsets. Words, their rows and
their 64-bit hashes are computed on that buffer without a Python object per
word. Callers feed a few megabytes at a time (:func:`slices`), so memory is
bounded by the chunk and by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from medallion.llm.common import row_ranges

CHUNK_BYTES = 4 << 20
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: space, tab, line feed, vertical tab, form feed, carriage return
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a text or binary array; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive row ranges."""
    data, at = buffers(column)
    for i, j in row_ranges(at, max_bytes):
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span [start, end), from one running sum."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of a run of texts: byte spans, first word of each row (length
    rows + 1) and hashes."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross a row's edge."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:n]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:n]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def words(data: np.ndarray, at: np.ndarray, lower: bool = False, space: np.ndarray = SPACE) -> Words:
    """White-space separated words of the rows."""
    data = LOWER[data] if lower else data
    starts, ends = runs(~space[data], at)
    first = np.searchsorted(starts, at)
    return Words(data, starts, ends, first, span_hashes(data, starts, ends))


def whole_hash(chain: np.ndarray, n_words: np.ndarray | int) -> np.ndarray:
    """Hash of a text of few words, from that of its words in a window."""
    return mix(chain + np.asarray(n_words).astype(np.uint64))


def windows(w: Words, size: int, whole_if_short: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, hash) of every window of ``size`` words inside a row.

    ``whole_if_short``: a row with 1 to size - 1 words gives one window of
    all its words.
    """
    counts = w.counts
    many = np.maximum(counts - size + 1, 0)
    row = np.repeat(np.arange(len(counts)), many)
    start = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(w.first[:-1], many)
    h = np.zeros(len(row), np.uint64)
    for k in range(size):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + w.hashes[start + k])
    if whole_if_short:
        short = np.flatnonzero((counts > 0) & (counts < size))
        if len(short):
            own = np.zeros(len(short), np.uint64)
            for k in range(size - 1):
                more = counts[short] > k
                own[more] = mix(own[more] * np.uint64(0xD6E8FEB86659FD93) + w.hashes[w.first[short[more]] + k])
            own = whole_hash(own, counts[short])
            row, start, h = np.append(row, short), np.append(start, w.first[short]), np.append(h, own)
            order = np.argsort(row, kind="stable")
            row, start, h = row[order], start[order], h[order]
    return row, start, h


def span_strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans [start, end) as an Arrow text array."""
    at = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=at[1:])
    taken = np.arange(at[-1]) + np.repeat(starts - at[:-1], ends - starts)
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data[taken])])
