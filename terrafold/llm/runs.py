"""Periodic runs by the branching-tandem test on an enhanced suffix array.

Tasks take documents in slices. The words of a slice become numbers of their own document, each document closed by a
number that occurs once, so one suffix array serves the slice and no match leaves its document.

1. Ranks of 1, 2, 4, ... words are refined until all differ; only places whose gram still repeats are
   sorted again. The last ranks are the inverse suffix array (ISA), and all of them answer how far two places agree.
2. Common prefixes of neighbours give the LCP intervals, from nearest smaller values; there are no tree nodes. Every suffix i
   of an interval of depth d but those of its largest child checks whether ISA[i + d] or ISA[i - d] lies in the
   interval too. If so, a square of period d starts at i or i - d, and it branches if another word follows.
3. A branching square is the last one of its run. Rotating it to the left as long as words agree finds the start;
   squares with one start and end are one run, whose period is the least.

Depths under four are left out: a run of at least twelve words whose period is 1, 2 or 3 has a branching square of six
words too, so it is found there and gets its least period by comparing the run with itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.arrays import SPACE, SpanHasher, ranges, text_slices, word_spans
from terrafold.llm.arrays import runs as stretches

_DEPTH = 4  # least depth of the intervals that are tested
_TABLE = 2  # the rank table of that many words: 2 ** _TABLE == _DEPTH


@dataclass(frozen=True)
class RunSettings:
    least: int = 12  # words of a run; not under 12, which the least depth of intervals relies on

    def __post_init__(self):
        if self.least < 12:
            raise ValueError("runs of fewer than 12 words are not looked for")


#: (ids, numbers of words) -> (first word, period) per document; period 0 leaves a document as it is.
Rewrite = Callable[[list, np.ndarray], tuple[np.ndarray, np.ndarray]]


def find_runs(
    docs: DataFrame, settings: RunSettings = RunSettings(), rewrite: Rewrite | None = None,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per row: id, n_words, runs (start, length, period; by start, then period), collapsed (the words that no run
    holds after its first period, joined by one space).

    Words are stretches without ASCII white space and are compared byte by byte. Null, empty and blank texts have no
    words, no runs and an empty ``collapsed``. Repeated rows and ids, null ids among them, are rows of their own.
    Documents never share a run. A text of any length is one piece. Other columns are ignored whatever
    their names; an empty table gives no rows. ``rewrite`` may ask for words from a place on to be repeated with a period.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(
        _search(settings, rewrite),
        f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string",
    ).withColumnRenamed("id", id_column)


def _search(settings: RunSettings, rewrite: Rewrite | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            ids = batch.column(0)
            for first, data, offsets in text_slices(batch, "text"):
                rows = len(offsets) - 1
                begins, ends, heads = word_spans(data, offsets, ~SPACE)
                n = np.diff(heads)
                source = np.arange(len(begins))
                if rewrite:
                    source = _repeated(source, heads, *rewrite(ids.slice(first, rows).to_pylist(), n))
                begins, ends = begins[source], ends[source]
                row, start, length, period = slice_runs(word_numbers(data, begins, ends, hasher), heads, settings.least)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, rows), pa.array(n), _lists(row, start, length, period, rows),
                     _joined(data, begins, ends, heads, _kept(row, start, length, period, heads))],
                    names=["id", "n_words", "runs", "collapsed"],
                )

    return run


def _repeated(source: np.ndarray, heads: np.ndarray, first: np.ndarray, period: np.ndarray) -> np.ndarray:
    n = np.diff(heads)
    p, a = np.repeat(period, n), np.repeat(heads[:-1] + first, n)
    return np.where((p > 0) & (source >= a), a + (source - a) % np.maximum(p, 1), source)


def word_numbers(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, hasher: SpanHasher) -> np.ndarray:
    """Equal numbers for equal words: grouped by hash and compared with the group's first word."""
    _, first, number = np.unique(hasher(data, begins, ends), return_index=True, return_inverse=True)
    like, size = first[number], ends - begins
    if (size != size[like]).any() or (data[ranges(begins, size)] != data[ranges(begins[like], size)]).any():
        seen: dict[bytes, int] = {}
        return np.array([seen.setdefault(data[a:b].tobytes(), len(seen)) for a, b in zip(begins, ends)])
    return number


def slice_runs(words: np.ndarray, heads: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """row, start (in its row), length and period of every run, by row, start and period."""
    rows, none = len(heads) - 1, tuple(np.zeros(0, np.int64) for _ in range(4))
    if not len(words):
        return none
    top = int(words.max()) + 1
    text = np.empty(len(words) + rows, np.int64)
    closing = heads[1:] + np.arange(rows)
    inner = np.ones(len(text), bool)
    inner[closing] = False
    text[closing] = np.arange(rows) * (top + 1) + top
    text[inner] = words + np.repeat(np.arange(rows), np.diff(heads)) * (top + 1)
    tables = rank_tables(text)
    start, depth = branching_squares(text, tables)
    if not len(start):
        return none
    end = start + 2 * depth
    start = start - agreement(tables, start, start + depth, back=True)
    order = np.lexsort([depth, end, start])
    start, end, period = start[order], end[order], depth[order]
    new = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))
    start, end, period = start[new], end[new], period[new]
    for small in range(_DEPTH - 1, 0, -1):
        fits = agreement(tables, start, start + small) >= end - start - small
        period = np.where(fits & (small < period), small, period)
    good = end - start >= np.maximum(least, 2 * period)
    start, end, period = start[good], end[good], period[good]
    row = np.searchsorted(closing, start)
    own = start - heads[row] - row
    order = np.lexsort([period, own, row])
    return row[order], own[order], (end - start)[order], period[order]


def rank_tables(text: np.ndarray) -> list[np.ndarray]:
    """Ranks of the grams of 1, 2, 4, ... numbers from each place, up to the first table without equal ranks, which is
    the inverse suffix array. A rank is the number of places that come before its group."""
    order = np.argsort(text, kind="stable")
    first, sizes = stretches(text[order])
    rank = np.empty(len(text), np.int32)
    rank[order] = np.repeat(first, sizes)
    live = order[np.repeat(sizes > 1, sizes)]
    tables, reach = [rank], 1
    while len(live):  # a gram that repeats holds no closing number, so there is a place behind it
        key = rank[live].astype(np.int64) * len(text) + rank[live + reach]
        turn = np.argsort(key, kind="stable")
        live, key = live[turn], key[turn]
        first, sizes = stretches(key)
        group, members = stretches(key // len(text))
        before = first - np.repeat(group, members)[first]
        finer = rank.copy()
        finer[live] = np.repeat(rank[live[first]] + before, sizes)
        live = live[np.repeat(sizes > 1, sizes)]
        rank = finer
        tables.append(rank)
        reach *= 2
    return tables


def agreement(tables: list[np.ndarray], one: np.ndarray, two: np.ndarray, back: bool = False) -> np.ndarray:
    """How many numbers agree from two different places on, or before them."""
    far, top = np.zeros(len(one), np.int64), len(tables[0]) - 1
    for k in range(len(tables) - 1, -1, -1):
        a, b = (one - far - (1 << k), two - far - (1 << k)) if back else (one + far, two + far)
        same = (a >= 0) & (b >= 0) & (a <= top) & (b <= top)
        same &= tables[k][np.clip(a, 0, top)] == tables[k][np.clip(b, 0, top)]
        far += same.astype(np.int64) << k
    return far


def branching_squares(text: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Start and period (at least ``_DEPTH``) of every square that another number follows than its period asks for."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(tables) <= _TABLE + 1:
        return none
    suffix = np.empty(len(text), np.int64)
    suffix[tables[-1]] = np.arange(len(text))
    deep = tables[_TABLE][suffix]
    joined = np.append(False, deep[1:] == deep[:-1])  # agrees with the suffix before it in the least depth
    use = joined | np.append(joined[1:], False)
    suffix, joined = suffix[use], joined[use]
    m = len(suffix)
    if not m:
        return none
    common = np.zeros(m, np.int64)
    at = np.flatnonzero(joined)
    common[at] = agreement(tables, suffix[at - 1], suffix[at])
    left, right = nearest_smaller(common)
    # Borders between children, grouped by interval: same first suffix, same depth.
    border = at[np.lexsort([at, common[at], left[at]])]
    key = np.flatnonzero(np.append(True, (left[border][1:] != left[border][:-1]) | (common[border][1:] != common[border][:-1])))
    count = np.diff(np.append(key, len(border)))
    low, high, depth = left[border[key]], right[border[key]], common[border[key]]
    begin = np.insert(border, key, low)  # children: from the interval's start or a border ...
    stop = np.insert(border, np.append(key[1:], len(border)), high)  # ... to the next border or its end
    interval = np.repeat(np.arange(len(key)), count + 1)
    size = stop - begin
    order = np.lexsort([np.arange(len(size)), -size, interval])
    small = np.ones(len(size), bool)
    small[order[np.append(0, np.cumsum(count + 1)[:-1])]] = False  # the largest child of each interval
    which = np.repeat(interval[small], size[small])
    i = suffix[ranges(begin[small], size[small])]
    inverse = np.full(len(text), -1, np.int64)
    inverse[suffix] = np.arange(m)
    d, a, b, last = depth[which], low[which], high[which], len(text) - 1
    found = []
    for one, two in ((i, i + d), (i - d, i)):  # a square from ``one``: both halves are in the interval
        ok = (one >= 0) & (two <= last)
        ok &= (inverse[np.clip(one, 0, last)] >= a) & (inverse[np.clip(one, 0, last)] < b)
        ok &= (inverse[np.clip(two, 0, last)] >= a) & (inverse[np.clip(two, 0, last)] < b)
        one, span = one[ok], d[ok]
        branches = text[one + span] != text[one + 2 * span]
        found.append((one[branches], span[branches]))
    start, period = (np.concatenate(c) for c in zip(*found))
    return start, period


def nearest_smaller(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest ones with a smaller value before (else 0) and behind (else the length)."""
    held = values.tolist()
    left, right, open_ = [0] * len(held), [len(held)] * len(held), []
    for p, now in enumerate(held):
        while open_ and held[open_[-1]] > now:
            right[open_.pop()] = p
        if open_:
            left[p] = left[open_[-1]] if held[open_[-1]] == now else open_[-1]
        open_.append(p)
    return np.array(left, np.int64), np.array(right, np.int64)


def _kept(row: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Words that no run holds after its first period."""
    depth = np.zeros(int(heads[-1]) + 1, np.int64)
    np.add.at(depth, heads[row] + start + period, 1)
    np.add.at(depth, heads[row] + start + length, -1)
    return np.cumsum(depth)[:-1] == 0


def _lists(row, start, length, period, rows: int) -> pa.Array:
    entries = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], ["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)), entries)


def _joined(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, heads: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each row with one space between them."""
    begin, size = begins[kept], (ends - begins)[kept]
    count = np.concatenate([[0], np.cumsum(kept)])[heads]  # kept words before each row
    place = np.concatenate([[0], np.cumsum(size + 1)])  # every word with a space behind it
    out = np.full(int(place[-1]), 0x20, np.uint8)
    out[ranges(place[:-1], size)] = data[ranges(begin, size)]
    first = place[count]
    filled = count[1:] > count[:-1]
    drop = first[1:][filled] - 1  # the space behind a row's last word
    out = np.delete(out, drop)
    bounds = first - np.concatenate([[0], np.cumsum(filled)])
    return pa.LargeStringArray.from_buffers(
        len(heads) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out)
    ).cast(pa.string())
