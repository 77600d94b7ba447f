"""URL filter by rules and by the likelihood ratio of two character models.

Two variable-order Markov models, one of accepted and one of rejected URLs, give each character a probability
that backs off from the longest context to shorter ones: P_k = (n(context, c) + a P_{k-1}) / (n(context) + a).
Counts are held in hashed tables of fixed size, so the model that is sent to the executors does not grow with
the corpus; all labelled URLs are counted, in Spark. A URL is blocked when its mean log-likelihood difference
per character passes a threshold that was calibrated on labelled URLs kept out of the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.arrays import mix, text_slices
from terrafold.llm.store import written

#: (verdict, host, path)
Rule = tuple[str, str, str]
_UPPER, _LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlModelSettings:
    orders: int = 5  # longest context, in characters
    table_bits: int = 18  # cells of each hashed count table
    weight: float = 4.0  # pseudo-count of the shorter context
    held_out: int = 5  # every fifth labelled URL calibrates the threshold
    bins: int = 4001  # resolution of the calibration histogram
    reach: float = 10.0  # largest difference per character told apart, in nats


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), _UPPER, _LOWERED)


def path_of(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct of rule and verdict of the longest rule that fits; null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's path. Of rules of one length the
    first in alphabetical order wins, and of equal rules block.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0] != "block"))
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    if not ordered:
        return none
    return F.coalesce(*[
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in ordered
    ], none)


def filter_urls(pages: DataFrame, rules: list[Rule], settings: UrlModelSettings = UrlModelSettings()) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, llr (mean difference per character; above the
    calibrated threshold means rejected), threshold.

    URLs that a rule decides are the labelled ones. With labels of one kind only, or none, there is nothing to
    compare and every other URL is allowed. A null or empty URL has no characters: llr 0, allowed unless a
    rule fits. Repeated pages are judged row by row; other columns are ignored; an empty table gives no rows.
    """
    ruled = pages.select("page_id", F.col("url").alias("url")).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}
    ).withColumn("match", matching_rule(F.col("host"), F.col("path"), rules))
    flat = ruled.select("page_id", "url", "host", "path", F.col("match.rule").alias("rule"),
                        F.col("match.verdict").alias("by_rule"))
    model = fit(flat.filter("by_rule is not null").select("url", (F.col("by_rule") == "block").alias("bad")), settings)
    scored = scored_urls(flat, model, settings)
    limit = F.lit(model["threshold"])
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("llr") > limit, "block").otherwise("allow")).alias("verdict"),
        "llr", limit.alias("threshold"),
    )


def fit(labelled: DataFrame, settings: UrlModelSettings = UrlModelSettings()) -> dict:
    """Count both models over all labelled URLs (url, bad) but the held-out ones, then place the threshold."""
    size = 1 << settings.table_bits
    rows = labelled.select("url", "bad", F.pmod(F.crc32(F.coalesce("url", F.lit(""))), F.lit(settings.held_out))
                           .alias("fold"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((2, 2, size), dtype=np.int64)
        for batch in batches:
            bad = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for first, data, offsets in text_slices(batch, "url"):
                kind = np.repeat(bad[first : first + len(offsets) - 1], np.diff(offsets)).astype(np.int64)
                for context, whole in cells(data, offsets, settings):
                    for part, cell in enumerate((context, whole)):
                        tables[:, part] += np.bincount(kind * size + cell, minlength=2 * size).reshape(2, size)
        kind, part, cell = np.nonzero(tables)
        if len(cell):
            yield pa.RecordBatch.from_arrays(
                [pa.array(((kind * 2 + part) * size + cell).astype(np.int64)), pa.array(tables[kind, part, cell])],
                names=["cell", "n"],
            )

    counts = rows.filter("fold != 0").select("url", "bad").mapInArrow(count, "cell long, n long")
    filled = counts.groupBy("cell").agg(F.sum("n").alias("n")).toArrow().to_pandas()  # at most 4 * 2**table_bits rows
    tables = np.zeros(4 * size, dtype=np.float32)
    tables[filled["cell"].to_numpy()] = filled["n"].to_numpy()
    model = {"tables": tables.reshape(2, 2, size), "threshold": float("inf")}
    if not (tables[: 2 * size].any() and tables[2 * size :].any()):
        return model
    model["threshold"] = _calibrated(scored_urls(rows.filter("fold = 0"), model, settings), settings)
    return model


def cells(data: np.ndarray, offsets: np.ndarray, settings: UrlModelSettings) -> Iterator[tuple]:
    """For each order from 0: table cells of the context and of context plus character, per character."""
    mask = np.uint64((1 << settings.table_bits) - 1)
    chars = data.astype(np.uint64) + np.uint64(1)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    context = np.zeros(len(data), dtype=np.uint64)
    for order in range(settings.orders + 1):
        if order:
            before = np.zeros(len(data), dtype=np.uint64)
            before[order:] = chars[:-order] if order < len(data) else 0
            before[place < order] = 0  # characters before the start of a URL count as zero
            context = context * np.uint64(0x100000001B3) + before
        keyed = mix(context + np.uint64((order + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        yield (keyed & mask).astype(np.int64), (mix(keyed + chars) & mask).astype(np.int64)


def differences(data: np.ndarray, offsets: np.ndarray, tables: np.ndarray, settings: UrlModelSettings) -> np.ndarray:
    """Mean over the characters of each URL of log P_rejected - log P_accepted; 0 for empty URLs."""
    chance = np.full((2, len(data)), 1 / 256)
    for context, whole in cells(data, offsets, settings):
        for kind in (0, 1):
            seen, hits = tables[kind, 0][context], tables[kind, 1][whole]
            chance[kind] = (np.minimum(hits, seen) + settings.weight * chance[kind]) / (seen + settings.weight)
    gain = np.concatenate([[0.0], np.cumsum(np.log(chance[1]) - np.log(chance[0]))])
    return (gain[offsets[1:]] - gain[offsets[:-1]]) / np.maximum(1, np.diff(offsets))


def scored_urls(rows: DataFrame, model: dict, settings: UrlModelSettings = UrlModelSettings()) -> DataFrame:
    """``rows`` (with a column url) with llr added."""
    sent = rows.sparkSession.sparkContext.broadcast(model["tables"])  # fixed size: 16 bytes * 2**table_bits

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [differences(d, o, sent.value, settings) for _, d, o in text_slices(batch, "url")]
            llr = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(llr)], names=[*batch.schema.names, "llr"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(score, schema + ", llr double")


def _calibrated(held_out: DataFrame, settings: UrlModelSettings) -> float:
    """The difference that separates held-out rejected from accepted URLs with the best balanced accuracy."""
    step = 2 * settings.reach / (settings.bins - 1)
    bucket = F.round((F.greatest(F.lit(-settings.reach), F.least(F.lit(settings.reach), F.col("llr")))
                      + settings.reach) / step).cast("int")
    table = held_out.groupBy(bucket.alias("bucket"), "bad").count().toArrow().to_pandas()  # at most 2 * bins rows
    both = np.zeros((2, settings.bins))
    both[table["bad"].astype(int), table["bucket"]] = table["count"]
    if not both.sum(axis=1).all():
        return 0.0
    accepted = np.cumsum(both[0]) / both[0].sum()  # share of accepted URLs at or below each bin
    rejected = 1 - np.cumsum(both[1]) / both[1].sum()  # share of rejected URLs above it
    quality = accepted + rejected
    best = np.flatnonzero(quality >= quality.max() - 1e-12)
    return float(best.mean() * step - settings.reach)
