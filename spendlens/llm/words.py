"""Words and their 64-bit names, read straight from Arrow buffers.

A word is a run of bytes other than space and \\x09-\\x0D. Its name is a function of its bytes
alone, so equal words have equal names in every task and in every run.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, size=256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x5851F42D4C957F2D
_BACK = pow(_BASE, -1, 2**64)
CHUNK_BYTES = 2 << 20
#: Powers that are kept; those of higher places are products of two.
_SPAN = 1 << 14


def _first_powers(base: int, number: int) -> np.ndarray:
    factors = np.full(number, base % 2**64, dtype=np.uint64)
    factors[:1] = 1
    return np.cumprod(factors)


_UP, _DOWN = _first_powers(_BASE, _SPAN), _first_powers(_BACK, _SPAN)


def _totals(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The sums of the bytes' values times the powers of their places, before each place and at the end."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    for i, a in enumerate(range(0, len(data), _SPAN)):
        part = total[a + 1:a + 1 + _SPAN]
        part[:] = values[data[a:a + _SPAN]]
        part *= _UP[:len(part)]
        part *= U64(pow(_BASE, i * _SPAN, 2**64))
        part[:1] += total[a:a + 1]
        part[:] = np.cumsum(part)
    return total


def _names(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    higher = _first_powers(pow(_BACK, _SPAN, 2**64), (len(total) // _SPAN) + 1)
    names = (total[end] - total[start]) * _DOWN[start & (_SPAN - 1)] * higher[start // _SPAN]
    return scramble(names + (end - start).astype(np.uint64) * U64(0xD1342543DE82EF95))


def scramble(x: np.ndarray) -> np.ndarray:
    """A one-to-one scattering of 64-bit values."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x ^= x >> U64(27)
    x *= U64(0x81DADEF4BC2DD44D)
    x ^= x >> U64(33)
    return x


def join_names(left: np.ndarray, right: np.ndarray, salt: int = 1) -> np.ndarray:
    """The name of an ordered pair."""
    return scramble(left * U64(0x9E3779B97F4A7C15 ^ (2 * salt)) + scramble(right + U64(salt)))


def word_ranges(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word starts and ends, and where the words of each document begin (see :class:`Words`)."""
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = ~SPACE[data]
    flips = inside[1:] != inside[:-1]
    starts = flips & inside[1:]
    ends = flips & inside[:-1]
    cuts = edges[1:-1]  # a word never reaches over the edge of a document
    cuts = cuts[(cuts > 0) & (cuts < n)]
    both = cuts[inside[1:-1][cuts] & inside[1:-1][cuts - 1]] if len(cuts) else cuts
    starts[both] = True
    ends[both] = True
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends), np.searchsorted(start, edges)


class Words:
    """The words of some documents: ``names``, byte range ``start``/``end`` of each in ``data``,
    and ``first``: where the words of document i begin (one more entry than documents)."""

    def __init__(self, data: np.ndarray, edges: np.ndarray, lower: bool):
        """``edges``: the byte where each document begins, and where the last ends."""
        self.data = data
        self.start, self.end, self.first = word_ranges(data, edges)
        self.names = _names(_totals(data, _BYTE[LOWER] if lower else _BYTE), self.start, self.end)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def range_names(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The names of byte ranges, as :class:`Words` gives them to words."""
    return _names(_totals(data, _BYTE), start, end)


def gather(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of ranges, one range after another."""
    return np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null counts as empty."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    if column.null_count:
        size = np.where(np.asarray(column.is_null()), 0, np.diff(offsets))
        if (size != np.diff(offsets)).any():  # bytes under a null
            return buffers(column.fill_null(""))
    return data, offsets


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text each; a longer document is
    a part of its own."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def release() -> None:
    """Give memory that this worker does not use any more back to the system: workers outlive their
    tasks, and what one stage has left free would add to what the next one takes."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries can
        ctypes.CDLL(None).malloc_trim(0)


def words_of(column: pa.Array, lower: bool = False) -> Words:
    data, offsets = buffers(column)
    return Words(data[offsets[0]:offsets[-1]], offsets - offsets[0], lower)
