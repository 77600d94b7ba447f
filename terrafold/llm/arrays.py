"""Numpy kernels over whole text columns, used inside Arrow tasks.

A column is handled as one run of bytes with offsets, in slices of a few megabytes, so that memory per task
does not depend on the number of rows in a batch. One row is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(values: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads all bits (splitmix finaliser)."""
    x = np.asarray(values, dtype=_U64).copy()
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=_U64) * _U64(_BASE))

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: ASCII letters and digits, and every byte of a longer UTF-8 sequence.
WORD_BYTE = np.zeros(256, dtype=bool)
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    WORD_BYTE[_low:_high] = True


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple]:
    """(first row, bytes, offsets) for runs of rows of about ``limit`` bytes; null counts as empty."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, where, held = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple:
    """Starts and ends of the maximal runs of bytes marked in ``inside``, cut at row ends, and the index
    of each row's first run (one more entry than rows)."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    keep = inside[data]
    begin, stop = keep.copy(), keep.copy()
    begin[1:] &= ~keep[:-1]
    stop[:-1] &= ~keep[1:]
    filled = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    begin[heads] = keep[heads]
    stop[tails] = keep[tails]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offsets)


class SpanHasher:
    """64-bit hashes of many spans of one byte run: differences of a running polynomial, mixed."""

    def __init__(self):
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        step = np.full(n, _BASE, dtype=_U64)
        back = np.full(n, _INVERSE, dtype=_U64)
        step[0] = back[0] = 1
        self.powers, self.inverses = np.cumprod(step, dtype=_U64), np.cumprod(back, dtype=_U64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(data)
        if n >= len(self.powers):
            self._grow(n + n // 2 + 1)
        running = np.zeros(n + 1, dtype=_U64)
        np.cumsum(BYTE_VALUES[data] * self.powers[:n], dtype=_U64, out=running[1:])
        plain = (running[ends] - running[starts]) * self.inverses[starts]
        return mix(plain + (ends - starts).astype(_U64) * _U64(0xD6E8FEB86659FD93))


def rolling(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` neighbouring 64-bit values, by position of the first."""
    total = max(0, len(values) - n + 1)
    out = np.zeros(total, dtype=_U64)
    for k in range(n):
        out = out * _U64(0x100000001B3) + values[k : k + total]
    return mix(out)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal neighbours in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    return starts, np.diff(np.append(starts, len(keys)))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the ranges [start, start + length), one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
