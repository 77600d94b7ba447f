"""Repeated passages by column-wise construction of a collection's Burrows-Wheeler order with common prefixes.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else.

1. Every window of that length chooses an anchor: the least hash of its k-grams, the leftmost of equal ones. The choice
   depends on the window's bytes alone, so equal windows have equal anchors at the same place. Neighbouring
   windows with one anchor form a segment.
2. Anchors and segments are compared by hash, shard by shard. Equal segments that occur twice are repeated as a
   whole; a task settles its own repeats and passes each segment on once. Other segments with one anchor are compared.
3. Compared segments, aligned at their anchors, form a collection. Each round inserts one symbol of every segment, one
   column further left: a stable sort by that symbol turns the order of the suffixes of the last column into the
   order of the new one, and the common prefixes of neighbours follow from range minima. A window is repeated if a
   neighbour's common prefix reaches its length. The symbols lie in a sequential temporary file, column by column, so a
   task holds two columns of state.
4. Repeated windows go back to their documents, whose bytes are cut there.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.arrays import SpanHasher, mix, ranges, runs, text_slices
from terrafold.llm.store import written

_U64 = np.uint64
_PLACE = _U64((1 << 24) - 1)
_CHUNK = 4 << 20  # windows of a long text that are looked at together


@dataclass(frozen=True)
class RepeatSettings:
    length: int = 200  # bytes of a repeated string
    gram: int = 32  # bytes of an anchor; length - gram must lie between 127 and 254
    shard: int = 400_000  # expected segments per shard
    collection: int = 20_000  # expected segments that are ordered together
    largest: int = 200_000  # segments of one anchor beyond which its windows are compared one by one
    flush: int = 400_000  # segments that a task gathers before it passes them on


def segments_of(data: np.ndarray, offsets: np.ndarray, settings: RepeatSettings, hasher: SpanHasher) -> tuple:
    """Anchor hash, segment hash, row, first and last window start in the row, anchor's distance behind the
    first start."""
    parts = []
    for base, chunk, bounds, first in _chunks(data, offsets, settings.length):
        part = _segments(chunk, bounds, settings, hasher)
        part[2] += first
        part[3] += base
        part[4] += base
        parts.append(part)
    return tuple(np.concatenate(c) for c in zip(*parts))


def _chunks(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple]:
    """(start within the row, bytes, offsets, first row): rows as they are, a very long one in overlapping parts."""
    if len(offsets) != 2 or len(data) <= _CHUNK + length:
        yield 0, data, offsets, 0
        return
    for a in range(0, len(data) - length + 1, _CHUNK):
        part = data[a : a + _CHUNK + length - 1]
        yield a, part, np.array([0, len(part)]), 0


def _segments(data: np.ndarray, offsets: np.ndarray, settings: RepeatSettings, hasher: SpanHasher) -> list[np.ndarray]:
    span, k = settings.length, settings.gram
    w = span - k + 1
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), np.maximum(sizes - span + 1, 0))
    p = ranges(offsets[:-1], np.maximum(sizes - span + 1, 0))  # all window starts
    if not len(p):
        none = np.zeros(0, np.int64)
        return [np.zeros(0, _U64), np.zeros(0, _U64), none, none, none, none]
    at = np.arange(len(data) - k + 1)
    grams = hasher(data, at, at + k)
    low = (grams & ~_PLACE) | at.astype(_U64)
    step = 1
    while 2 * step <= w:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    anchor = (np.minimum(low[p], low[p + w - step]) & _PLACE).astype(np.int64)
    starts, lengths = runs(anchor)
    first, last, q = p[starts], p[starts + lengths - 1], anchor[starts]
    own = row[starts]
    # Minima are small numbers: mixed again, so that they spread over shards.
    return [mix(grams[q]), hasher(data, first, last + span), own, first - offsets[own], last - offsets[own], q - first]


_MATCHED = "kind int, anchor long, rid long, lo long, hi long, ahead int, single boolean, many long"


def repeated_windows(docs: DataFrame, settings: RepeatSettings = RepeatSettings()) -> DataFrame:
    """rid, lo, hi: ranges of window starts whose string also starts elsewhere. ``docs`` has rid and text;
    rows with one rid must have one text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(size // 80 // settings.shard) + 4
    matched = written(
        docs.mapInArrow(_gather(settings, shards), "shard int, body binary").repartition(shards, "shard")
        .groupBy("shard").applyInArrow(_match(settings), _MATCHED), "segments"
    )
    settled = matched.filter("kind = 1").select("rid", "lo", "hi")
    compared = matched.filter("kind = 2")
    cut = compared.groupBy("rid").agg(F.collect_list(F.struct("anchor", "lo", "hi", "ahead", "single", "many")).alias("segments"))
    joined = docs.join(cut.hint("merge"), "rid").dropDuplicates(["rid"])
    pieces = joined.mapInArrow(
        _cut(settings), "anchor long, rid long, lo long, hi long, ahead int, single boolean, many long, bytes binary"
    )
    pieces = written(pieces, "compared")
    normal = pieces.filter(F.col("many") <= settings.largest)
    collections = int(compared.count() // settings.collection) + 1
    found = (
        normal.withColumn("part", F.pmod("anchor", F.lit(collections)).cast("int"))
        .groupBy("part").applyInArrow(_order(settings), "rid long, lo long, hi long")
    )
    windows = pieces.filter(F.col("many") > settings.largest).mapInArrow(
        _windows(settings), "one long, two long, rid long, lo long, single boolean"
    )
    twice = windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = found.unionByName(
        windows.filter("single").join(twice, ["one", "two"]).select("rid", "lo", F.col("lo").alias("hi"))
    )
    return settled.unionByName(found)


def remove_repeats(
    docs: DataFrame, settings: RepeatSettings = RepeatSettings(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row: id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes).

    Texts are UTF-8 bytes; null is empty. Matches never cross rows, overlap with themselves counts, and
    strings are judged on the input. A text under the length keeps everything. Repeated rows repeat each other;
    null ids stay null. Other columns are ignored; an empty table gives no rows.
    """
    source = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    source = source.withColumn("rid", F.xxhash64("id", "text"))
    found = repeated_windows(source.select("rid", "text"), settings)
    spans = found.groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    kind = source.schema["id"].dataType.simpleString()
    return source.join(spans.hint("merge"), "rid", "left").mapInArrow(
        _remove(settings.length), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    ).withColumnRenamed("id", id_column)


def _gather(settings: RepeatSettings, shards: int):
    """Segments of a task by shard. What a task holds twice is settled there; one entry goes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = SpanHasher(), [], 0

        def out():
            anchor, segment, rid, lo, hi, ahead = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort([lo, rid, segment, anchor])
            anchor, segment, rid, lo, hi, ahead = (c[order] for c in (anchor, segment, rid, lo, hi, ahead))
            new = np.append(True, (anchor[1:] != anchor[:-1]) | (segment[1:] != segment[:-1]))
            starts = np.flatnonzero(new)
            n = np.diff(np.append(starts, len(new)))
            twice = np.repeat(n > 1, n)
            rows = [(0, _body([c[twice] for c in (rid, lo, hi)]), 1)] if twice.any() else []
            one = [c[starts] for c in (anchor, segment, rid, lo, hi, ahead)] + [np.minimum(n, 2)]
            shard = ((one[0] >> _U64(32)) * _U64(shards) >> _U64(32)).astype(np.int64)
            begins, lengths = runs(shard)
            rows += [(int(shard[b]), _body([c[b : b + m] for c in one]), 0) for b, m in zip(begins, lengths)]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] if not r[2] else i % shards for i, r in enumerate(rows)], pa.int32()),
                 pa.array([bytes([r[2]]) + r[1] for r in rows], pa.binary())], names=["shard", "body"],
            )

        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("rid")).to_numpy()
            for first, data, offsets in text_slices(batch, "text"):
                anchor, segment, row, lo, hi, ahead = segments_of(data, offsets, settings, hasher)
                held.append((anchor, segment, ids[first + row], lo, hi, ahead))
                size += len(anchor)
                if size > settings.flush:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    return run


def _body(columns: list[np.ndarray]) -> bytes:
    """Columns of 64-bit numbers, one after the other."""
    return np.int64(len(columns[0])).tobytes() + b"".join(c.astype(c.dtype if c.dtype == _U64 else np.int64).tobytes() for c in columns)


def _columns(body: memoryview, kinds: list) -> list[np.ndarray]:
    n = int(np.frombuffer(body[1:9], np.int64)[0])
    return [np.frombuffer(body[9 + 8 * n * i : 9 + 8 * n * (i + 1)], kind) for i, kind in enumerate(kinds)]


def _match(settings: RepeatSettings):
    """Rows of kind 1: settled windows; kind 2: a segment to compare with others of its anchor."""
    kinds = [_U64, _U64, *[np.int64] * 5]

    def run(table: pa.Table) -> pa.Table:
        bodies = table.column("body").to_pylist()
        done = [_columns(b, [np.int64] * 3) for b in bodies if b[0] == 1]
        rid, lo, hi = (np.concatenate([d[i] for d in done] or [np.zeros(0, np.int64)]) for i in range(3))
        held = [_columns(b, kinds) for b in bodies if b[0] == 0]
        one = [np.concatenate([h[i] for h in held] or [np.zeros(0, k)]) for i, k in enumerate(kinds)]
        order = np.lexsort([one[3], one[2], one[1], one[0]])
        anchor, segment, doc, first, last, ahead, n = (c[order] for c in one)
        if len(anchor):
            group = np.append(True, anchor[1:] != anchor[:-1])
            new = group.copy()
            new[1:] |= segment[1:] != segment[:-1]
        else:
            group = new = np.zeros(0, bool)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(new)))
        total = np.add.reduceat(n, starts) if len(starts) else n
        settle = np.repeat(total > 1, sizes) & (n == 1)  # those seen twice in their task are settled already
        which = np.cumsum(group)[starts]
        many = np.bincount(which)[which] if len(which) else which
        pick = many > 1
        own = starts[pick]
        none = lambda m, kind: pa.nulls(m, kind)
        a, b = len(rid) + int(settle.sum()), len(own)
        return pa.table({
            "kind": pa.array(np.repeat([1, 2], [a, b]).astype(np.int32)),
            "anchor": pa.chunked_array([none(a, pa.int64()), pa.array(anchor[own].view(np.int64))]),
            "rid": np.concatenate([rid, doc[settle], doc[own]]),
            "lo": np.concatenate([lo, first[settle], first[own]]),
            "hi": np.concatenate([hi, last[settle], last[own]]),
            "ahead": pa.chunked_array([none(a, pa.int32()), pa.array(ahead[own].astype(np.int32))]),
            "single": pa.chunked_array([none(a, pa.bool_()), pa.array(total[pick] == 1)]),
            "many": pa.chunked_array([none(a, pa.int64()), pa.array(many[pick].astype(np.int64))]),
        })

    return run


def _cut(settings: RepeatSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("segments"))
            rids = batch.column(batch.schema.get_field_index("rid")).to_numpy()
            for first, data, offsets in text_slices(batch, "text"):
                part = lists.slice(first, len(offsets) - 1)
                flat = part.flatten()
                n = pc.list_value_length(part).to_numpy()
                lo, hi = flat.field("lo").to_numpy(), flat.field("hi").to_numpy()
                base = np.repeat(offsets[:-1], n)
                length = hi - lo + settings.length
                joined = data[ranges(base + lo, length)]
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
                held = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(lo), [None, pa.py_buffer(ends), pa.py_buffer(joined)]
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [flat.field("anchor"), pa.array(np.repeat(rids[first : first + len(n)], n)), flat.field("lo"), flat.field("hi"),
                     flat.field("ahead"), flat.field("single"), flat.field("many"), held],
                    names=["anchor", "rid", "lo", "hi", "ahead", "single", "many", "bytes"],
                )

    return run


def column_order(texts: list[bytes], ahead: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Insert the collection column by column, from the right, texts aligned at their anchors. Yields each column
    (relative to the anchor) with the numbers of the texts whose string of ``length`` bytes from there starts
    a second time in that column."""
    m = len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    left, right = int(ahead.max()), int((sizes - ahead).max())
    width = left + right
    if not width:
        return
    with tempfile.TemporaryFile() as file:
        for a in range(0, m, 1024):  # blocks of texts are turned into columns and written in order
            block = np.zeros((min(1024, m - a), width), np.uint16)
            for i, t in enumerate(texts[a : a + 1024]):
                at = left - int(ahead[a + i])
                block[i, at : at + len(t)] = np.frombuffer(t, np.uint8)
                block[i, at : at + len(t)] += 1
            block.T.tofile(file)
        file.flush()
        symbols = np.memmap(file, dtype=np.uint16, mode="r")
        order, common = np.arange(m), np.zeros(m + 1, np.uint16)
        for column in range(width - 1, -1, -1):
            now = np.concatenate([
                symbols[a * width + column * n : a * width + (column + 1) * n]
                for a in range(0, m, 1024) for n in (min(1024, m - a),)
            ])
            symbol = now[order]
            turn = np.argsort(symbol, kind="stable")
            lows = _range_minima(common[:m], turn)
            order, symbol = order[turn], symbol[turn]
            same = np.zeros(m, bool)
            same[1:] = (symbol[1:] == symbol[:-1]) & (symbol[1:] > 0)
            common = np.zeros(m + 1, np.uint16)
            common[:m][same] = np.minimum(lows[same] + 1, length)
            reach = common >= length
            hit = reach[:m] | reach[1:]
            if hit.any():
                yield column - left, order[hit]
        del symbols


def _range_minima(common: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """For each j: the least common prefix over the old places behind turn[j - 1] up to turn[j]; 0 where those
    do not ascend."""
    m = len(common)
    levels = [common]
    while 2 << (len(levels) - 1) <= m:
        step = 1 << (len(levels) - 1)
        last = levels[-1].copy()
        np.minimum(last[:-step], levels[-1][step:], out=last[:-step])
        levels.append(last)
    table = np.stack(levels)
    a, b = turn[:-1] + 1, turn[1:] + 1
    out = np.zeros(m, np.uint16)
    ok = b > a
    level = np.frexp((b - a)[ok].astype(np.float64))[1] - 1
    out[1:][ok] = np.minimum(table[level, a[ok]], table[level, b[ok] - (1 << level)])
    return out


def _order(settings: RepeatSettings):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("anchor").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        ahead = table.column("ahead").to_numpy().astype(np.int64)
        rid, lo, hi = (table.column(c).to_numpy() for c in ("rid", "lo", "hi"))
        single = table.column("single").to_numpy()
        text, place = [], []
        for column, hits in column_order(table.column("bytes").to_pylist(), ahead, settings.length):
            start = lo[hits] + ahead[hits] + column
            good = single[hits] & (start >= lo[hits]) & (start <= hi[hits])
            text.append(hits[good]), place.append(start[good])
        text = np.concatenate(text or [np.zeros(0, np.int64)])
        place = np.concatenate(place or [np.zeros(0, np.int64)])
        back = np.lexsort([place, text])
        text, place = text[back], place[back]
        starts, lengths = runs(text * (1 << 40) + place - np.arange(len(text)))
        return pa.table({"rid": rid[text[starts]], "lo": place[starts], "hi": place[starts] + lengths - 1})

    return run


def _windows(settings: RepeatSettings):
    """Every window of a segment with two hashes of its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            get = lambda n: batch.column(batch.schema.get_field_index(n))  # noqa: E731, B023
            for i in range(batch.num_rows):
                data = np.frombuffer(get("bytes")[i].as_py(), np.uint8)
                at = np.arange(len(data) - settings.length + 1)
                one = hasher(data, at, at + settings.length)
                two = hasher(data[::-1].copy(), at, at + settings.length)[::-1]
                yield pa.RecordBatch.from_arrays([
                    pa.array(one.view(np.int64)), pa.array(np.ascontiguousarray(two).view(np.int64)),
                    pa.array(np.full(len(at), get("rid")[i].as_py())), pa.array(at + get("lo")[i].as_py()),
                    pa.array(np.full(len(at), get("single")[i].as_py())),
                ], names=["one", "two", "rid", "lo", "single"])

    return run


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda n: batch.column(batch.schema.get_field_index(n))  # noqa: E731, B023
            ids, lists = get("id"), get("spans")
            for first, data, offsets in text_slices(batch, "text"):
                rows = len(offsets) - 1
                part = lists.slice(first, rows)
                flat = part.flatten()
                n = pc.fill_null(pc.list_value_length(part), 0).to_numpy()
                base = np.repeat(offsets[:-1], n)
                lo = base + flat.field("lo").to_numpy()
                hi = base + flat.field("hi").to_numpy() + length
                depth = np.zeros(len(data) + 1, np.int64)
                np.add.at(depth, lo, 1)
                np.add.at(depth, hi, -1)
                gone = np.cumsum(depth)[:-1] > 0
                begin = gone.copy()
                begin[1:] &= ~gone[:-1]
                heads = offsets[:-1][offsets[1:] > offsets[:-1]]
                begin[heads] = gone[heads]
                removed = np.concatenate([[0], np.cumsum(gone)])[offsets]
                spans = np.concatenate([[0], np.cumsum(begin)])[offsets]
                kept = data[~gone]
                left = offsets - removed
                held = [kept[a:b].tobytes() for a, b in zip(left[:-1], left[1:])]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, rows), pa.array(np.diff(offsets)), pa.array(np.diff(removed)), pa.array(np.diff(spans)),
                     pa.array([hashlib.sha256(k).hexdigest() for k in held]), pa.array(held, pa.binary())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
                )

    return run
