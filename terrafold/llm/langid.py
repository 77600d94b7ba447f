"""Language identification with bit-sliced Bloom filters over character n-grams.

Each language has a Bloom filter of the n-grams that are typical of it; the filters are stored side by side, one bit
of a 64-bit word per language, so that the words at the probed slots, anded, name all languages that contain an
n-gram. The hits of a text are counted per language, corrected for the false positives that each filter's fill
predicts, and the largest share wins.

An n-gram enters a filter if it makes up at least ``rare`` of the language's n-grams of its length, so at most
1 / rare of each length can, whatever the corpus; its frequency must also be near the highest of all languages.
Counts cover every training text and are summed in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.arrays import mix, rolling, text_slices
from terrafold.llm.store import written

_U64 = np.uint64


@dataclass(frozen=True)
class LanguageSettings:
    lengths: tuple[int, ...] = (2, 3, 4)
    rare: float = 2e-5  # least share of a language's n-grams of one length
    near: float = 0.5  # least part of the highest frequency among languages
    slot_bits: int = 20
    probes: int = 3
    flush: int = 2_000_000  # distinct n-grams that a task holds before it passes them on


@dataclass
class LanguageModel:
    """Filters of fixed size: one row of 64-bit words per slot, a word for every 64 languages."""

    languages: list[str]
    words: np.ndarray
    false_rate: np.ndarray  # per language
    settings: LanguageSettings


def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letters_of(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each row with every run of other characters as one 0, a 0 at both ends, and the rows'
    offsets."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    rows = len(offsets) - 1
    wide = np.zeros(len(points) + 2 * rows, np.uint32)
    shift = 2 * np.repeat(np.arange(rows), np.diff(heads)) + 1
    wide[np.arange(len(points)) + shift] = np.where(table[points], points, 0)
    starts = heads[:-1] + 2 * np.arange(rows)
    keep = wide != 0
    keep[1:] |= wide[:-1] != 0
    keep[starts] = True
    bounds = np.concatenate([[0], np.cumsum(keep)])[np.append(starts, len(wide))]
    return wide[keep], bounds


def gram_keys(points: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of each row and their row. A gap between words may only be at the ends."""
    if len(points) < length:
        return np.zeros(0, _U64), np.zeros(0, np.int64)
    total = len(points) - length + 1
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    keep = row[:total] == row[length - 1 :]
    for k in range(1, length - 1):
        keep &= points[k : k + total] != 0
    if length == 2:
        keep &= (points[:total] != 0) | (points[1:] != 0)
    keys = rolling(points.astype(_U64), length) + _U64(length)
    return keys[keep], row[:total][keep]


def train(texts: DataFrame, settings: LanguageSettings = LanguageSettings()) -> LanguageModel:
    """Learn from all rows of (text, lang); null text or lang teaches nothing."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held, size = letter_table(), {}, 0

        def out():
            columns = [[], [], [], []]
            for (lang, length), parts in held.items():
                keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
                for column, values in zip(columns, ([lang] * len(keys), [length] * len(keys), keys.view(np.int64), n)):
                    column.extend(values)
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[2:])],
                names=["lang", "length", "gram", "n"],
            )

        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for first, data, offsets in text_slices(batch, "text"):
                points, bounds = letters_of(data, offsets, table)
                names, code = np.unique(langs[first : first + len(offsets) - 1].astype(str), return_inverse=True)
                for length in settings.lengths:
                    keys, row = gram_keys(points, bounds, length)
                    own = code[row]
                    for k, name in enumerate(names):
                        part = np.unique(keys[own == k], return_counts=True)
                        held.setdefault((str(name), length), []).append(part)
                        size += len(part[0])
                if size > settings.flush:
                    yield out()
                    held, size = {}, 0
        if held:
            yield out()

    rows = texts.filter("text is not null and lang is not null").select(F.lower("text").alias("text"), "lang")
    counted = rows.mapInArrow(count, "lang string, length int, gram long, n long")
    grams = written(counted.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n")), "language-grams")
    totals = grams.groupBy("lang", "length").agg(F.sum("n").alias("total"))
    languages = sorted(r.lang for r in totals.select("lang").distinct().collect())  # one row per language
    planes = max(1, -(-len(languages) // 64))
    size = 1 << settings.slot_bits
    words = np.zeros((size, planes), _U64)
    if languages:
        share = grams.join(F.broadcast(totals), ["lang", "length"]).withColumn("share", F.col("n") / F.col("total"))
        share = share.filter(F.col("share") >= settings.rare)  # at most 1 / rare rows per language and length
        top = share.groupBy("gram").agg(F.max("share").alias("top"))
        kept = share.join(top, "gram").filter(F.col("share") >= settings.near * F.col("top"))
        number = F.element_at(F.create_map(*[F.lit(x) for i, l in enumerate(languages) for x in (l, i)]), F.col("lang"))
        bits = kept.select("gram", F.shiftright(number, 6).alias("plane"), F.expr("1L").alias("one"), F.pmod(number, F.lit(64)).alias("bit"))
        masks = bits.groupBy("gram", "plane").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("mask"))
        for batch in masks.toArrow().to_pandas().groupby("plane"):  # bounded as said above
            plane, held = batch
            for slots in slots_of(held["gram"].to_numpy().view(_U64), settings):
                np.bitwise_or.at(words[:, int(plane)], slots, held["mask"].to_numpy().view(_U64))
    fill = np.array([
        np.count_nonzero(words[:, i // 64] >> _U64(i % 64) & _U64(1)) / size for i in range(len(languages))
    ])
    return LanguageModel(languages, words, fill**settings.probes, settings)


def slots_of(keys: np.ndarray, settings: LanguageSettings) -> Iterator[np.ndarray]:
    """The probed slots of each key, one array per probe."""
    step = mix(keys ^ _U64(0x2545F4914F6CDD1D)) | _U64(1)
    place = keys
    for _ in range(settings.probes):
        yield (place >> _U64(64 - settings.slot_bits)).astype(np.int64)
        place = place + step


def shares(points: np.ndarray, bounds: np.ndarray, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Corrected share of each row's n-grams that each language contains, and the number of n-grams."""
    rows = len(bounds) - 1
    hits, total = np.zeros((rows, len(model.languages))), np.zeros(rows)
    for length in model.settings.lengths:
        keys, row = gram_keys(points, bounds, length)
        total += np.bincount(row, minlength=rows)
        found = None
        for slots in slots_of(keys, model.settings):
            held = model.words[slots]
            found = held if found is None else found & held
        if found is None or not len(keys):
            continue
        for i in range(len(model.languages)):
            hit = (found[:, i // 64] >> _U64(i % 64)) & _U64(1)
            hits[:, i] += np.bincount(row, weights=hit.astype(np.float64), minlength=rows)
    raw = hits / np.maximum(total, 1)[:, None]
    return np.clip((raw - model.false_rate) / np.maximum(1 - model.false_rate, 1e-9), 0, 1), total


def predict(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: id, lang_pred, score.

    The score is the winner's part of the two largest corrected shares. Null, empty and letterless texts are
    ``und`` with score 0, and so is every text if no language was learned. Ties, also of texts without any known
    n-gram, go to the first language in alphabetical order. Repeated and null ids are answered row by row; other columns
    are ignored; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: 8 MB for up to 64 languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = sent.value, letter_table()
        for batch in batches:
            for first, data, offsets in text_slices(batch, "text"):
                points, bounds = letters_of(data, offsets, table)
                rows = len(offsets) - 1
                lettered = np.add.reduceat(points != 0, bounds[:-1]) > 0
                names, score = np.full(rows, "und", dtype=object), np.zeros(rows)
                if model.languages:
                    part, _ = shares(points, bounds, model)
                    best = part.argmax(axis=1)
                    two = np.sort(part, axis=1)[:, -2:].sum(axis=1)
                    names[lettered] = np.array(model.languages, dtype=object)[best[lettered]]
                    score[lettered] = (part.max(axis=1) / np.where(two > 0, two, 1))[lettered]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(names, pa.string()), pa.array(score)],
                    names=["id", "lang_pred", "score"],
                )

    source = docs.select(F.col(id_column).alias("id"), F.lower(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_column)
