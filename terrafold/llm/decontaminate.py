"""Benchmark decontamination: q-gram counting in diagonal bands, then banded alignment.

An item of m bytes that occurs in a text with at most k edits shares m + 1 - q (k + 1) of its q-grams with it,
and they lie on diagonals (position in the text less position in the item) at most k apart. Hits are therefore counted
in bands of 2w diagonals that overlap by w >= k; only bands that reach the bound are kept, and the item is
aligned there within the band. Both sides are compared lower-cased, with every run of other characters than letters and
digits as one space.

Items shorter than a q-gram have no budget and are found exactly, as whole words, by their first and last bytes.

Tasks normalise the items and pack them into numbered files of bounded size in the shared folder. A task looks for the items of
one file at a time in each batch of texts, so neither memory nor a broadcast grows with the benchmark. Texts
never move.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.arrays import WORD_BYTE, mix, ranges, runs, text_slices
from terrafold.llm.store import fresh_folder, make_folder, put_bytes, read_bytes

_U64 = np.uint64
Q = 8  # bytes of a q-gram: one 64-bit number, so hits are exact
_BITS = 22
_TOGETHER = 16  # neighbouring bands that are aligned in one region


@dataclass(frozen=True)
class MatchSettings:
    error: float = 0.1  # edits allowed per byte of an item
    block_bytes: int = 4 << 20  # normalised bytes of the items that are searched at once
    at_once: int = 1_000_000  # q-gram hits a task counts at once


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised rows, each closed by a zero byte, and the input position of every byte."""
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(offsets))
    wide = np.full(len(data) + rows, 0x20, np.uint8)
    place = np.arange(len(data)) + row
    wide[place] = np.where(WORD_BYTE[data], data, 0x20)
    close = offsets[1:] + np.arange(rows)
    word = wide != 0x20
    keep = word.copy()
    keep[1:] |= word[:-1]
    keep[close] = True
    wide[close] = 0
    source = np.zeros(len(wide), np.int64)
    source[place] = np.arange(len(data))
    source[close] = offsets[1:]
    return wide[keep], source[keep]


def grams(text: np.ndarray) -> np.ndarray:
    """All q-grams of a byte array as numbers."""
    x = text.astype(_U64)
    for width in (1, 2, 4):
        if len(x) <= width:
            return np.zeros(0, _U64)
        x = x[:-width] | (x[width:] << _U64(8 * width))
    return x


class ItemIndex:
    """Sorted q-grams of a block of items."""

    def __init__(self, items: list[tuple[int, bytes]], settings: MatchSettings):
        short = [x for x in items if len(x[1]) < Q]
        self.short = _ShortItems([t for _, t in short], len(items) - len(short))
        long_ = [x for x in items if len(x[1]) >= Q]
        self.items = items = long_ + short
        items = long_
        length = np.array([len(t) for _, t in items], np.int64)
        budget = np.minimum((length * settings.error).astype(np.int64), length // Q - 1)
        self.length, self.budget = length, budget
        self.bound = length + 1 - Q * (budget + 1)
        self.width = np.maximum(budget + 1, 8)
        held = [grams(np.frombuffer(t, np.uint8)) for _, t in items]
        sizes = np.array([len(g) for g in held], np.int64)
        all_grams = np.concatenate(held or [np.zeros(0, _U64)])
        order = np.argsort(all_grams, kind="stable")
        starts, self.many = runs(all_grams[order])
        self.grams, self.first = all_grams[order][starts], starts
        self.item = np.repeat(np.arange(len(items)), sizes)[order]
        self.place = ranges(np.zeros(len(items), np.int64), sizes)[order]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[mix(self.grams) >> _U64(64 - _BITS)] = True

    def bands(self, text: np.ndarray, at_once: int) -> Iterator[tuple[int, int, int]]:
        """(item, first diagonal, last diagonal) of the runs of bands that reach the bound, long runs in parts that share a band."""
        g = grams(text) if len(self.grams) else np.zeros(0, _U64)
        spots = np.flatnonzero(self.seen[mix(g) >> _U64(64 - _BITS)]) if len(g) else np.zeros(0, np.int64)
        if not len(spots):
            return
        at = np.minimum(np.searchsorted(self.grams, g[spots]), len(self.grams) - 1)
        hit = self.grams[at] == g[spots]
        spots, at = spots[hit], at[hit]
        keys, numbers = [], []
        for a, b in _portions(self.many[at], at_once):
            own = ranges(self.first[at[a:b]], self.many[at[a:b]])
            item = self.item[own]
            diagonal = np.repeat(spots[a:b], self.many[at[a:b]]) - self.place[own] + self.length[item]
            band = diagonal // self.width[item]
            key = (item.astype(np.int64) << 40) | band
            k, n = np.unique(np.concatenate([key, key[band > 0] - 1]), return_counts=True)
            keys.append(k), numbers.append(n)
        if not keys:
            return
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(back, weights=np.concatenate(numbers))
        key = key[total >= self.bound[key >> 40]]
        for part in np.split(key, np.flatnonzero(np.diff(key) > 1) + 1):  # neighbouring bands are aligned together
            for at in range(0, max(len(part) - 1, min(len(part), 1)), _TOGETHER - 1):
                one, last = int(part[at]), int(part[min(at + _TOGETHER, len(part)) - 1])
                item, mask = one >> 40, (1 << 40) - 1
                width, length = int(self.width[item]), int(self.length[item])
                yield item, (one & mask) * width - length, ((last & mask) + 2) * width - length


class _ShortItems:
    """Items of fewer bytes than a q-gram: every place where one stands as whole words."""

    def __init__(self, texts: list[bytes], first: int):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in sorted({len(t) for t in texts}):
            own = [(int.from_bytes(t, "little"), first + i) for i, t in enumerate(texts) if len(t) == n]
            value, item = zip(*sorted(own))
            self.by_length[n] = np.array(value, _U64), np.array(item)

    def places(self, text: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) in a normalised text whose rows end in zero."""
        edge = (text == 0x20) | (text == 0)
        begin = np.append(True, edge[:-1]) & ~edge
        for n, (values, items) in self.by_length.items():
            at = np.flatnonzero(begin)
            at = at[at + n < len(text)]
            at = at[edge[at + n]]
            found = np.zeros(len(at), _U64)
            for i in range(n):
                found |= text[at + i].astype(_U64) << _U64(8 * i)
            low, high = np.searchsorted(values, found, "left"), np.searchsorted(values, found, "right")
            for k in np.flatnonzero(high > low).tolist():
                for j in range(low[k], high[k]):
                    yield int(items[j]), int(at[k]), int(at[k]) + n


def _portions(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield a, b
        a = b


def align(item: bytes, region: bytes, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of the whole item in the region, along diagonals low to high
    (counted in the region); None above the budget. Of equal places the first end counts, and of its
    starts the last."""
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    a, b = np.frombuffer(item, np.uint8), np.frombuffer(region, np.uint8)
    width = high - low + 1
    steps = np.arange(width)
    far = len(a) + len(b) + 1
    # cost[x]: edits of the item's first i bytes ending at region position i + low + x; begin: where that place starts
    end = low + steps
    cost = np.where((end >= 0) & (end <= len(b)), 0, far)
    begin = end.copy()
    for i in range(1, len(a) + 1):
        end = i + low + steps
        inside = (end >= 1) & (end <= len(b))
        miss = np.ones(width, np.int64)
        miss[inside] = b[end[inside] - 1] != a[i - 1]
        new, start = np.where(inside, cost + miss, far), begin.copy()  # substitution or match
        skip = np.append(cost[1:] + 1, far)  # a byte of the item without partner
        better = (skip < new) & (end >= 0) & (end <= len(b))
        new[better], start[better] = skip[better], np.append(begin[1:], 0)[better]
        slide = np.minimum.accumulate(new - steps) + steps  # bytes of the region without partner
        source = np.maximum.accumulate(np.where(new - steps == slide - steps, steps, 0))
        better = slide < new
        start[better] = start[source[better]]
        cost, begin = np.where((end >= 0) & (end <= len(b)), np.minimum(new, slide), far), start
        if cost.min() > budget:
            return None
    best = int(np.argmin(cost))
    return int(cost[best]), int(begin[best]), int(len(a) + low + best)


def find_items(
    docs: DataFrame, benchmark: DataFrame, settings: MatchSettings = MatchSettings(),
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per place where a text holds an item within the edit budget: id, item_id, start and length (code
    points of the lower-cased text), edits.

    The budget is error * m edits for an item of m normalised bytes, at most m // 8 - 1, so that the bound is never
    empty. Shorter items than eight bytes must occur exactly and as whole words; items without letters and digits match
    nothing, as do null and empty texts and items. Repeated rows and repeated items each give their own rows; ids may be
    null. All places count; of overlapping places of one item those with fewer edits stay, then the earlier ones. Empty
    tables give no rows; other columns are ignored.
    """
    source = docs.select(F.col(id_column).alias("id"), F.lower(text_column).alias("text"))
    id_type, item_type = source.schema["id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    paths = pack_items(benchmark, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Files(paths, settings)
        for batch in batches:
            for index, ids in held:
                for first, data, offsets in text_slices(batch, "text"):
                    rows = list(_matches(index, data, offsets, settings))
                    if rows:
                        row, item, start, length, edits = zip(*rows)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).slice(first).take(pa.array(row)), ids.take(pa.array(item)),
                             *(pa.array(x, pa.int64()) for x in (start, length, edits))],
                            names=["id", "item_id", "start", "length", "edits"],
                        )

    schema = f"id {id_type}, item_id {item_type}, start long, length long, edits long"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, settings: MatchSettings = MatchSettings(), text_column: str = "text"
) -> DataFrame:
    """``docs`` without the rows whose text holds an item. Every row is judged by its own text, whatever its id."""
    paths = pack_items(benchmark, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Files(paths, settings)
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for index, _ in held:
                for first, data, offsets in text_slices(batch, "__low"):
                    for row, *_ in _matches(index, data, offsets, settings):
                        clean[first + row] = False
            yield batch.select(batch.schema.names[:-1]).filter(pa.array(clean))

    return docs.withColumn("__low", F.lower(text_column)).mapInArrow(run, docs.schema)


def pack_items(benchmark: DataFrame, settings: MatchSettings) -> list[str]:
    """Files of about ``block_bytes`` normalised bytes of items each; only their names come to the driver."""
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", F.lower("text").alias("text")).filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files, folder = int(size // settings.block_bytes) + 1, fresh_folder(spark, "items")

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for _, data, offsets in text_slices(batch, "text"):
                texts += [t.strip(b" ") for t in normalise(data, offsets)[0].tobytes().split(b"\0")[:-1]]
            use = pa.array([i for i, t in enumerate(texts) if t], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary())], names=["item_id", "body"]
            ).take(use)

    def packed(table: pa.Table) -> pa.Table:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_file(sink, table.select(["item_id", "body"]).schema) as out:
            out.write_table(table.select(["item_id", "body"]))
        path = put_bytes(f"{folder}/{table.column('file')[0].as_py()}", [sink.getvalue().to_pybytes()])
        return pa.table({"path": [path]})

    make_folder(folder)
    rows = items.mapInArrow(normal, f"item_id {items.schema['item_id'].dataType.simpleString()}, body binary").withColumn(
        "file", F.pmod(F.xxhash64("body", "item_id"), F.lit(files)).cast("int")
    )
    return sorted(r.path for r in rows.groupBy("file").applyInArrow(packed, "path string").collect())


class _Files:
    """The index of each file in turn; a single one is kept."""

    def __init__(self, paths: list[str], settings: MatchSettings):
        self.paths, self.settings, self.only = paths, settings, None

    def __iter__(self) -> Iterator[tuple[ItemIndex, pa.Array]]:
        for path in self.paths:
            held = self.only or self._read(path)
            if len(self.paths) == 1:
                self.only = held
            yield held

    def _read(self, path: str) -> tuple[ItemIndex, pa.Array]:
        table = pa.ipc.open_file(pa.BufferReader(read_bytes(path))).read_all().combine_chunks()
        texts = table.column("body").to_pylist()
        index = ItemIndex(list(enumerate(texts)), self.settings)
        order = pa.array([i for i, _ in index.items], pa.int64())
        return index, table.column("item_id").combine_chunks().take(order)


def _matches(index: ItemIndex, data: np.ndarray, offsets: np.ndarray, settings: MatchSettings) -> Iterator[tuple]:
    """(row, item, start, length, edits) of all places."""
    text, source = normalise(data, offsets)
    heads = np.flatnonzero(text == 0)
    whole = text.tobytes()
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for item, a, b in index.short.places(text):
        found.setdefault((int(np.searchsorted(heads, a)), item), []).append((0, a, b))
    for item, low, high in index.bands(text, settings.at_once):
        m, k = int(index.length[item]), int(index.budget[item])
        # A region may touch two rows: the item is looked for in each of them.
        a, b = max(0, low - k), min(len(text), high + m + k)
        for row in range(np.searchsorted(heads, a), min(len(heads), np.searchsorted(heads, b) + 1)):
            begin = max(a, heads[row - 1] + 1 if row else 0)
            end = min(b, heads[row])
            parts = [(begin, end)]
            while parts:  # the best place, and what lies on both sides of it
                begin, end = parts.pop()
                if end - begin < max(m - k, 1):
                    continue
                best = align(index.items[item][1], whole[begin:end], low - k - begin, high + k - begin, k)
                if best is not None and best[0] <= k and best[2] > best[1]:
                    place = (best[0], int(begin + best[1]), int(begin + best[2]))
                    found.setdefault((int(row), item), []).append(place)
                    parts += [(begin, place[1]), (place[2], end)]
    if not found:
        return
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    for (row, item), places in sorted(found.items()):
        taken: list[tuple[int, int]] = []  # starts and ends, in order
        for cost, a, b in sorted(set(places)):
            at = bisect.bisect(taken, (a, b))
            if at and taken[at - 1][1] > a or at < len(taken) and taken[at][0] < b:
                continue
            taken.insert(at, (a, b))
            s, e = source[a], source[b - 1] + 1
            e = e + int(np.argmax(np.append((data[e : e + 4] & 0xC0) != 0x80, True)))
            yield row, item, int(points[s] - points[offsets[row]]), int(points[e] - points[s]), cost
