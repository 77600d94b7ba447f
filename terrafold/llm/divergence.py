"""Divergence between the sources of each language, with terms materialised late.

Counting moves term digests of a fixed width only. Each task adds up what it has read and packs, for every shard of the
digest space, digests with the number of their (language, source) group in that blob, occurrences and documents.
A shard knows all groups of its digests, so it decides which terms a language keeps and stores their counts, term by term.

Words come back in two places. Of every kept digest the least and the greatest string are found in a second
reading, where a fixed-size bit filter leaves out digests that nobody kept. If the two differ, several terms share the
digest: those terms alone are counted anew by digest and text, and take the place of the digest. Terms of the
report are joined to their text at the very end, after all others have been ranked away.

Divergence is exact integer arithmetic on scaled shares. A pair of sources needs a sum over all kept terms, most of which
neither has: a task adds the counts' values against the other side's share of an absent term per group, corrects those
terms that both have, and passes on one sum for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.arrays import LOWER, SpanHasher, ranges, runs, text_slices, word_spans
from terrafold.llm.store import written
from terrafold.session import lookup_side

_U64 = np.uint64
SCALE = 1_000_000_000
LETTER = np.zeros(256, dtype=bool)  # ASCII letters, and every byte of a longer UTF-8 sequence
for _low, _high in ((0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    LETTER[_low:_high] = True


@dataclass(frozen=True)
class DivergenceSettings:
    documents: int = 3  # of a language that must hold a term
    ranks: int = 200  # of the term report
    digest_bits: int = 64  # narrower ones collide; for tests
    shard_tokens: int = 3_000_000  # expected tokens per shard of the digest space
    flush: int = 1_000_000  # entries that a task gathers before it adds and packs them
    filter_bits: int = 25  # the bit filter of kept digests has 2 ** filter_bits bits


def divergence(docs: DataFrame, settings: DivergenceSettings = DivergenceSettings()) -> DataFrame:
    """lang, source, part, item, value, rank of the parts ``pair`` and ``term``.

    Null text, lang and source count as empty strings. Every (lang, source) that occurs is a group, also without
    terms; a language of one source has no pairs. Equal values are ranked by item in UTF-8 order. Repeated rows are
    documents of their own. Other columns, ids among them, are ignored whatever their names; an empty table
    gives no rows. A text of any length is read whole.
    """
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts, words = kept_counts(docs, settings)
    shares = written(_shares(docs, counts), "shares")
    held = counts.join(lookup_side(shares), ["lang", "source"]).withColumns({
        "p": share("n", "total", "terms"), "absent": share("0", "total", "terms"), "q": share("all_n", "all_total", "terms"),
    })
    return _pairs(held, shares).unionByName(_terms(held, words, settings))


# ---------------------------------------------------------------- counting


def kept_counts(docs: DataFrame, settings: DivergenceSettings) -> tuple[DataFrame, DataFrame]:
    """(lang, digest, part, source, n, all_n, first, text), (digest, low).

    The first frame has the occurrences of each kept term per source, and in its language; ``first`` marks one row of every term.
    ``part`` is 0 where the digest stands for one term, whose text is in the second frame. Terms of a shared digest
    have parts 1, 2, ... and their text at hand.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(size // 6 // settings.shard_tokens) + 4
    packed = docs.mapInArrow(_count(settings, shards), "shard int, body binary").repartition(shards, "shard")
    kept = written(packed.groupBy("shard").applyInArrow(_keep(settings), _KEPT), "kept-digests")
    words = written(_words(docs, settings, _bit_filter(kept.select("digest"), settings)), "kept-words")
    shared = words.filter("low < high").select("digest")
    plain = kept.select("lang", "digest", F.lit(0).alias("part"), "source", "n", "all_n", "first", F.lit(None).cast("string").alias("text"))
    if not shared.isEmpty():
        plain = plain.join(lookup_side(shared), "digest", "left_anti").unionByName(written(_split(docs, shared, settings), "split-terms"))
    return plain, words.select("digest", "low")


_KEPT = "lang string, digest long, source string, n long, all_n long, first boolean"


def _term_hashes(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher, bits: int) -> tuple:
    """Lower-cased bytes, starts, ends, digests and rows of all terms."""
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, LETTER)
    digest = hasher(low, starts, ends) >> _U64(64 - bits)
    return low, starts, ends, digest, np.repeat(np.arange(len(offsets) - 1), np.diff(first))


class _Groups:
    """Numbers for (lang, source), in order of appearance."""

    def __init__(self):
        self.number: dict[tuple[str, str], int] = {}

    def __call__(self, langs: list[str], sources: list[str]) -> np.ndarray:
        return np.array([self.number.setdefault(k, len(self.number)) for k in zip(langs, sources)], np.int64)


def _summed(digest: np.ndarray, group: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (digest, group) in order, with added values."""
    order = np.lexsort([group, digest])
    digest, group = digest[order], group[order]
    at = np.flatnonzero(np.append(True, (digest[1:] != digest[:-1]) | (group[1:] != group[:-1]))[: len(digest)])
    return digest[at], group[at], *((np.add.reduceat(v[order], at) if len(at) else v) for v in values)


def _shard_of(digest: np.ndarray, shards: int, bits: int) -> np.ndarray:
    """Equal ranges of the digest space."""
    wide = digest << _U64(64 - bits)
    return ((wide >> _U64(32)) * _U64(shards) >> _U64(32)).astype(np.int64)


def _count(settings: DivergenceSettings, shards: int):
    """Blobs of a task by shard: digests with local group numbers, occurrences and documents, and the groups' names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, groups, held, size = SpanHasher(), _Groups(), [], 0

        def out() -> pa.RecordBatch:
            digest, group, n, docs = _summed(*(np.concatenate(c) for c in zip(*held)))
            names = pa.array([f"{len(a.encode())}:{a}{b}" for a, b in groups.number])
            shard = _shard_of(digest, shards, settings.digest_bits)
            begins, sizes = runs(shard)  # digests ascend, so shards do
            bodies = []
            for b, m in zip(begins, sizes):
                used, local = np.unique(group[b : b + m], return_inverse=True)
                bodies.append(_pack(names.take(pa.array(used)).to_pylist(), digest[b : b + m], local, n[b : b + m], docs[b : b + m]))
            return pa.RecordBatch.from_arrays(
                [pa.array(shard[begins], pa.int32()), pa.array(bodies, pa.binary())], names=["shard", "body"]
            )

        for batch in batches:
            own = groups(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for first, data, offsets in text_slices(batch, "text"):
                _, _, _, digest, row = _term_hashes(data, offsets, hasher, settings.digest_bits)
                if not len(digest):
                    continue
                digest, row, n = _summed(digest, row, np.ones(len(row), np.int64))
                held.append(_summed(digest, own[first + row], n, np.ones(len(row), np.int64)))
                size += len(held[-1][0])
                if size > settings.flush:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return run


def _narrow(values: np.ndarray) -> bytes:
    """Type code, and the values in the least unsigned type that holds them."""
    kind = np.min_scalar_type(int(values.max())) if len(values) else np.dtype(np.uint8)
    return kind.char.encode() + values.astype(kind).tobytes()


def _pack(names: list[str], digest: np.ndarray, *columns: np.ndarray) -> bytes:
    head = [b"%d" % len(names)] + [x.encode() for x in names]
    parts = [*head, np.diff(digest, prepend=_U64(0)).tobytes(), *(_narrow(c) for c in columns)]
    sizes = np.array([len(digest), len(parts), *map(len, parts)], np.int64)
    return sizes.tobytes() + b"".join(parts)


def _unpack(body: bytes) -> tuple[list[tuple[str, str]], list[np.ndarray]]:
    count = int(np.frombuffer(body, np.int64, 1, 8)[0])
    sizes = np.frombuffer(body, np.int64, count, 16)
    ends = 16 + 8 * count + np.cumsum(sizes)
    parts = [body[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist())]
    names, names_end = [], 1 + int(parts[0])
    for x in parts[1:names_end]:
        length, _, rest = x.partition(b":")
        names.append((rest[: int(length)].decode(), rest[int(length) :].decode()))
    digest = np.cumsum(np.frombuffer(parts[names_end], _U64), dtype=_U64)
    return names, [digest, *(np.frombuffer(p[1:], np.dtype(p[:1].decode())).astype(np.int64) for p in parts[names_end + 1 :])]


def _keep(settings: DivergenceSettings):
    """Counts of the digests that a language keeps, by language, digest and source."""

    def run(table: pa.Table) -> pa.Table:
        groups, held = _Groups(), []
        for body in table.column("body"):
            names, (digest, local, n, docs) = _unpack(body.as_py())
            held.append((digest, groups(*zip(*names))[local], n, docs))
        digest, group, n, docs = _summed(*(np.concatenate(c) for c in zip(*held)))
        names = sorted(groups.number, key=groups.number.get)
        langs = {lang: k for k, lang in enumerate(dict.fromkeys(a for a, _ in names))}
        lang = np.array([langs[a] for a, _ in names])[group]
        order = np.lexsort([group, digest, lang])
        digest, group, n, docs, lang = (c[order] for c in (digest, group, n, docs, lang))
        at = np.flatnonzero(np.append(True, (digest[1:] != digest[:-1]) | (lang[1:] != lang[:-1])))
        sizes = np.diff(np.append(at, len(digest)))
        good = np.repeat(np.add.reduceat(docs, at) >= settings.documents, sizes)
        first = np.zeros(len(digest), bool)
        first[at] = True
        pick = lambda values, index: pa.array(values).take(pa.array(index[good]))
        return pa.table({
            "lang": pick(list(langs), lang).cast(pa.string()), "digest": pa.array(digest[good].view(np.int64)),
            "source": pick([b for _, b in names], group).cast(pa.string()), "n": pa.array(n[good]),
            "all_n": pa.array(np.repeat(np.add.reduceat(n, at), sizes)[good]), "first": pa.array(first[good]),
        })

    return run


# ---------------------------------------------------------------- shared digests


def _bit_filter(digests: DataFrame, settings: DivergenceSettings) -> bytes:
    """One bit for each value of a digest's first bits; the size does not depend on the number of digests."""
    bits = min(settings.filter_bits, settings.digest_bits)
    low, drop = min(bits, 16), _U64(settings.digest_bits - bits)
    part_type = "part int, bits binary"

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            place = np.unique(batch.column(0).to_numpy().view(_U64) >> drop)
            begins, sizes = runs(place >> _U64(low))
            for b, m in zip(begins, sizes):
                own = parts.setdefault(int(place[b] >> _U64(low)), np.zeros(1 << low, bool))
                own[(place[b : b + m] & _U64((1 << low) - 1)).astype(np.int64)] = True
        for part, own in parts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())], names=["part", "bits"]
            )

    def either(table: pa.Table) -> pa.Table:
        held = np.bitwise_or.reduce([np.frombuffer(b.as_py(), np.uint8) for b in table.column("bits")])
        return pa.table({"part": table.column("part").combine_chunks().slice(0, 1), "bits": pa.array([held.tobytes()], pa.binary())})

    chunk = (1 << low) // 8
    out = bytearray((1 << bits) // 8)
    rows = digests.mapInArrow(mark, part_type).groupBy("part").applyInArrow(either, part_type)
    for r in rows.toArrow().to_pylist():  # at most 2 ** filter_bits bits in all
        out[r["part"] * chunk : (r["part"] + 1) * chunk] = r["bits"]
    return bytes(out)


def _words(docs: DataFrame, settings: DivergenceSettings, held: bytes) -> DataFrame:
    """digest, low, high: the least and greatest term of each digest that the filter lets through.

    A task passes on a term when it first meets it; later it knows it by two 64-bit digests.
    """
    drop = _U64(settings.digest_bits - min(settings.filter_bits, settings.digest_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, mask = SpanHasher(), np.frombuffer(held, np.uint8)
        known = np.zeros((2, 0), _U64)
        for batch in batches:
            for _, data, offsets in text_slices(batch, "text"):
                low, starts, ends, digest, _ = _term_hashes(data, offsets, hasher, settings.digest_bits)
                at = _passed(digest >> drop, mask)
                at = at[np.argsort(digest[at], kind="stable")]
                pair = np.stack([digest[at], hasher(~low, starts[at], ends[at])])
                new = np.append(True, (pair[:, 1:] != pair[:, :-1]).any(axis=0))[: len(at)]
                at, pair = at[new], pair[:, new]
                if known.shape[1]:
                    place = np.minimum(np.searchsorted(known[0], pair[0]), known.shape[1] - 1)
                    fresh = (known[:, place] != pair).any(axis=0)
                    at, pair = at[fresh], pair[:, fresh]
                if not len(at):
                    continue
                known = np.concatenate([known if known.shape[1] < settings.flush else known[:, :0], pair], axis=1)
                known = known[:, np.argsort(known[0], kind="stable")]
                size = ends[at] - starts[at]
                text = pa.LargeStringArray.from_buffers(
                    len(at), pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(low[ranges(starts[at], size)])
                )
                yield pa.RecordBatch.from_arrays([pa.array(digest[at].view(np.int64)), text.cast(pa.string())], names=["digest", "term"])

    terms = docs.mapInArrow(run, "digest long, term string")
    return terms.groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high"))


def _passed(place: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Which places of the bit filter are set."""
    return np.flatnonzero((mask[(place >> _U64(3)).astype(np.int64)] >> (place & _U64(7)).astype(np.uint8)) & 1)


def _counted_by_text(docs: DataFrame, settings: DivergenceSettings, held: bytes) -> DataFrame:
    """lang, source, digest, term, n, docs of the terms that the filter lets through, per task and flush."""
    drop = _U64(settings.digest_bits - min(settings.filter_bits, settings.digest_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, mask, seen = SpanHasher(), np.frombuffer(held, np.uint8), {}

        def out() -> pa.RecordBatch:
            keys = list(seen)
            columns = [pa.array([k[i] for k in keys]) for i in range(2)]
            columns += [pa.array(np.array([k[2] for k in keys], _U64).view(np.int64)), pa.array([k[3].decode() for k in keys])]
            columns += [pa.array([seen[k][i] for k in keys], pa.int64()) for i in range(2)]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "digest", "term", "n", "docs"])

        for batch in batches:
            names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for first, data, offsets in text_slices(batch, "text"):
                low, starts, ends, digest, row = _term_hashes(data, offsets, hasher, settings.digest_bits)
                last = {}
                for i in _passed(digest >> drop, mask).tolist():
                    key = (*names[first + row[i]], int(digest[i]), low[starts[i] : ends[i]].tobytes())
                    entry = seen.setdefault(key, [0, 0])
                    entry[0] += 1
                    entry[1] += last.get(key) != row[i]
                    last[key] = row[i]
                if len(seen) > settings.flush // 8:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    return docs.mapInArrow(run, "lang string, source string, digest long, term string, n long, docs long")


def _split(docs: DataFrame, shared: DataFrame, settings: DivergenceSettings) -> DataFrame:
    """Kept terms of shared digests, counted by text."""
    terms = _counted_by_text(docs, settings, _bit_filter(shared, settings)).join(lookup_side(shared), "digest", "left_semi")
    counted = written(
        terms.groupBy("lang", "source", "digest", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "shared-terms"
    )
    good = (
        counted.groupBy("lang", "digest", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n"), F.min("source").alias("least"))
        .filter(F.col("docs") >= settings.documents).drop("docs")
    )
    parts = counted.select("digest", "term").distinct()
    numbered = parts.withColumn("part", F.dense_rank().over(Window.partitionBy("digest").orderBy("term")))
    return (
        counted.drop("docs").join(good, ["lang", "digest", "term"]).join(numbered, ["digest", "term"])
        .select("lang", "digest", "part", "source", "n", "all_n", (F.col("source") == F.col("least")).alias("first"), F.col("term").alias("text"))
    )


# ---------------------------------------------------------------- shares


def share(n: str, total: str, terms: str):
    """1 + floor(SCALE * (n + 1) / (total + terms)), as an exact column."""
    return F.expr(f"1L + ({SCALE}L * ({n} + 1)) div greatest({total} + {terms}, 1L)")


def relative(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _shares(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, source, total, all_total, terms: of every group that occurs."""
    groups = docs.select("lang", "source").distinct()
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.col("first").cast("long")).alias("terms"))
    all_ = sums.groupBy("lang").agg(F.sum("total").alias("all_total"), F.sum("terms").alias("terms"))
    return (
        groups.join(sums.drop("terms"), ["lang", "source"], "left").join(all_, "lang", "left")
        .na.fill(0, ["total", "terms", "all_total"])
    )


def _pairs(held: DataFrame, shares: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language with the sum over all kept terms.

    If all terms were absent from both sides, the sum would be ``terms`` equal values. Terms that the source has (own), that
    the other one has (theirs) and that both have are then put right.
    """
    groups = shares.withColumn("absent", share("0", "total", "terms")).select("lang", "source", "terms", "absent")
    other = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("other"))
    both = (
        held.select("lang", "digest", "part", "source", "p", "absent").repartition("lang", "digest", "part")
        .sortWithinPartitions("lang", "digest", "part").mapInArrow(_in_both, "lang string, source string, item string, value long")
    )
    # Terms with one share in a source have one value against an absent term, so they are counted first.
    levels = held.groupBy("lang", "source", "absent", "p").agg(F.count(F.lit(1)).alias("m"))
    against = levels.join(lookup_side(other), "lang").filter("source != item")
    one = against.select("lang", "source", "item", F.expr(
        f"m * ({relative('p', 'other')} - {relative('absent', 'other')})").alias("value"))
    back = against.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.expr(
        f"m * ({relative('other', 'p')} - {relative('other', 'absent')})").alias("value"))
    none = groups.join(lookup_side(other), "lang").filter("source != item").select(
        "lang", "source", "item", F.expr(f"terms * {relative('absent', 'other')}").alias("value"))
    summed = none.unionByName(one).unionByName(back).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(summed, "pair")


def _ranked(rows: DataFrame, part: str, ranks: int | None = None) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", place.alias("rank"))
    return ranked.filter(F.col("rank") <= ranks) if ranks else ranked


_CELLS = 1 << 20  # pairs of a term's sources that are looked at together


def _in_both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections for the terms that two sources both have, added up per pair of sources. Rows come term by term."""
    groups, rest, held = _Groups(), None, []

    def out() -> pa.RecordBatch:
        one, two, value = _summed(*(np.concatenate(c) for c in zip(*held)))
        held[:] = [(one, two, value)]
        names = list(groups.number)
        return pa.RecordBatch.from_arrays(
            [pa.array([names[i][0] for i in one]), pa.array([names[i][1] for i in one]), pa.array([names[i][1] for i in two]), pa.array(value)],
            names=["lang", "source", "item", "value"],
        )

    def add(group: np.ndarray, p: np.ndarray, absent: np.ndarray, sizes: np.ndarray) -> None:
        first = np.cumsum(sizes) - sizes
        partners = np.repeat(sizes, sizes)  # of each row: all rows of its term
        begin = np.repeat(first, sizes)
        done = 0
        while done < len(group):
            last = max(done + 1, int(np.searchsorted(np.cumsum(partners[done:]), _CELLS)) + done)
            i = np.repeat(np.arange(done, min(last, len(group))), partners[done:last])
            j = ranges(begin[done:last], partners[done:last])
            i, j = i[i != j], j[i != j]
            f = lambda a, b: (a - b) * (a - b) // b
            value = f(p[i], p[j]) - f(p[i], absent[j]) - f(absent[i], p[j]) + f(absent[i], absent[j])
            held.append(_summed(group[i], group[j], value))
            done = last
            if sum(len(h[0]) for h in held) > 4 * _CELLS:
                held[:] = [_summed(*(np.concatenate(c) for c in zip(*held)))]

    for batch in batches:
        table = pa.Table.from_batches([rest, batch] if rest is not None else [batch]).combine_chunks()
        if not table.num_rows:
            continue
        columns = [table.column(n) for n in ("lang", "digest", "part")]
        change = np.append(True, np.logical_or.reduce([_changes(c) for c in columns]))
        cut = int(np.flatnonzero(change)[-1])  # the last term may go on
        rest = table.slice(cut).to_batches()[0]
        if cut:
            whole = table.slice(0, cut)
            add(groups(whole.column("lang").to_pylist(), whole.column("source").to_pylist()), whole.column("p").to_numpy(),
                whole.column("absent").to_numpy(), np.diff(np.append(np.flatnonzero(change[:cut]), cut)))
        if held and len(held[0][0]) > _CELLS:
            yield out()
            held.clear()
    if rest is not None and rest.num_rows:
        add(groups(rest.column(0).to_pylist(), rest.column(3).to_pylist()), rest.column(4).to_numpy(), rest.column(5).to_numpy(),
            np.array([rest.num_rows]))
    if held:
        yield out()


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """Whether each value but the first differs from the one before."""
    values = column.combine_chunks()
    if pa.types.is_string(values.type):
        values = values.dictionary_encode().indices
    values = values.to_numpy(zero_copy_only=False)
    return values[1:] != values[:-1]


def _terms(held: DataFrame, words: DataFrame, settings: DivergenceSettings) -> DataFrame:
    """The terms of each group whose share is over the language's, by value. Ranks that a value alone decides are cut
    before any text is joined; of terms that tie with the last rank all go on."""
    over = held.filter("p > q").select("lang", "source", "digest", "text", F.expr(relative("p", "q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    bar = (
        over.select("lang", "source", "value").withColumn("place", F.row_number().over(best)).filter(F.col("place") <= settings.ranks)
        .groupBy("lang", "source").agg(F.min("value").alias("bar"))
    )
    near = over.join(lookup_side(bar), ["lang", "source"]).filter("value >= bar")
    named = near.join(words, "digest", "left").withColumn("item", F.coalesce("text", "low"))
    return _ranked(named, "term", settings.ranks)
