"""Toxicity scores by a convolutional text classifier, written and trained in numpy.

A word is the concatenation of hashed embeddings, one of the word itself and one of each of a few prefixes, so
inflected and compounded forms share parts, and two words only look alike where all their hashes meet. Filters of several widths slide over the words, each filter keeps its largest value over the whole text, and a logistic
layer weighs them. Only the places of the maxima carry a gradient. The network alone is fitted on a bounded sample of
labelled rows. Every other labelled row is scored and counted by language, score bin and label; the logistic curve of the
scores and the thresholds per language come from those counts. Language is used for thresholds alone, never for a score.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.arrays import WORD_BYTE, SpanHasher, mix, text_slices, word_spans
from terrafold.llm.store import fresh_folder, make_folder, put_bytes, read_bytes, written

_U64 = np.uint64


@dataclass(frozen=True)
class ToxicitySettings:
    sample: int = 1500  # labelled rows of each kind that the network is fitted on, at most; and
    sample_words: int = 2_500_000  # words of them; the longest give a window each, so that all rows fit
    bins: int = 256  # of a unit of the network's output, in which labelled rows are counted
    prior: float = 20.0  # toxic rows that all languages together count as in the threshold of each
    near: int = 2_000_000  # labels that are broadcast to the texts, at most
    hash_bits: int = 18
    prefixes: tuple[int, ...] = (4, 5, 6)  # bytes; each has an embedding beside that of the word
    part: int = 4  # dimensions of each embedding
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8  # per width
    rounds: int = 6
    batch: int = 32
    rate: float = 0.02
    threshold: float = 0.3  # where no language has one of its own
    seed: int = 7


@dataclass
class ToxicityModel:
    """Weights of fixed size (a table of 2**hash_bits rows per embedding), calibration and thresholds.

    A trained model holds the file of its tables instead of the tables, so they never come to the driver.
    """

    settings: ToxicitySettings
    tables: list[np.ndarray] = field(default_factory=list)
    kernels: list[np.ndarray] = field(default_factory=list)  # per width: (width * dimensions, filters)
    bias: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None
    offset: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)
    path: str = ""  # of the tables, if they lie in the shared folder

    def loaded(self) -> ToxicityModel:
        """The model with its tables, for the task that scores."""
        if not self.path:
            return self
        held, tables = np.load(io.BytesIO(read_bytes(self.path))), []
        for k in range(1 + len(self.settings.prefixes)):
            tables.append(np.zeros((1 << self.settings.hash_bits, self.settings.part), np.float32))
            tables[k][held[f"rows{k}"]] = held[f"values{k}"]
        return replace(self, tables=tables, path="")


def word_ids(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher, settings: ToxicitySettings) -> tuple:
    """Bucket numbers of shape (embeddings, words) of the lower-cased rows, and the rows' offsets."""
    starts, ends, first = word_spans(data, offsets, WORD_BYTE)
    shift = _U64(64 - settings.hash_bits)
    parts = [hasher(data, starts, ends), *(hasher(data, starts, np.minimum(ends, starts + k)) for k in settings.prefixes)]
    return np.stack([h >> shift for h in parts]).astype(np.int32), first


def _embedded(model: ToxicityModel, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word vectors with zero vectors behind each row, so that no filter sees two rows, and the new offsets."""
    pad = max(model.settings.widths)
    rows = len(bounds) - 1
    wide = bounds + pad * np.arange(rows + 1)
    x = np.zeros((int(wide[-1]), len(model.tables) * model.settings.part), np.float32)
    place = np.arange(ids.shape[1]) + pad * np.repeat(np.arange(rows), np.diff(bounds))
    for k, table in enumerate(model.tables):
        x[place, k * model.settings.part : (k + 1) * model.settings.part] = table[ids[k]]
    return x, wide


def _pooled(model: ToxicityModel, x: np.ndarray, wide: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per width: filter values at every place, and their largest per row."""
    for width, kernel, bias in zip(model.settings.widths, model.kernels, model.bias):
        size = x.shape[1]
        out = np.zeros((len(x), kernel.shape[1]), np.float32)
        for k in range(width):
            out[: len(x) - k] += x[k:] @ kernel[k * size : (k + 1) * size]
        for k in range(1, width):
            out[wide[1:] - k] = 0  # these places reach the next row
        yield out, np.maximum(np.maximum.reduceat(out, wide[:-1], axis=0) + bias, 0)


def logits(model: ToxicityModel, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    if model.weights is None:
        return np.zeros(len(bounds) - 1)
    x, wide = _embedded(model, ids, bounds)
    features = np.concatenate([m for _, m in _pooled(model, x, wide)], axis=1)
    return features @ model.weights + model.offset


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class _Adam:
    def __init__(self, values: np.ndarray, rate: float):
        self.values, self.rate = values, rate
        self.mean, self.square, self.steps = np.zeros_like(values), np.zeros_like(values), 0

    def step(self, gradient: np.ndarray, rows=slice(None)) -> None:
        self.steps += 1
        self.mean[rows] = 0.9 * self.mean[rows] + 0.1 * gradient
        self.square[rows] = 0.99 * self.square[rows] + 0.01 * gradient**2
        fix = (1 - 0.99 ** self.steps) ** 0.5 / (1 - 0.9 ** self.steps)
        self.values[rows] -= self.rate * fix * self.mean[rows] / (np.sqrt(self.square[rows]) + 1e-6)


def fit_network(texts: list[np.ndarray], labels: np.ndarray, settings: ToxicitySettings) -> ToxicityModel:
    """Train on bucket numbers of shape (embeddings, words) per text. Word vectors that no text taught stay zero."""
    rng = np.random.default_rng(settings.seed)
    dims = settings.part * (1 + len(settings.prefixes))
    model = ToxicityModel(settings)
    for k in range(1 + len(settings.prefixes)):
        model.tables.append(np.zeros((1 << settings.hash_bits, settings.part), np.float32))
        seen = np.unique(np.concatenate([t[k] for t in texts]))
        model.tables[-1][seen] = rng.normal(0, 0.05, (len(seen), settings.part))
    for width in settings.widths:
        model.kernels.append(rng.normal(0, (1 / (width * dims)) ** 0.5, (width * dims, settings.filters)).astype(np.float32))
        model.bias.append(np.full(settings.filters, 0.01, np.float32))
    model.weights = rng.normal(0, 0.3, settings.filters * len(settings.widths)).astype(np.float32)
    offset = np.array([np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))], np.float32)
    tables = [_Adam(t, settings.rate) for t in model.tables]
    kernels, biases = ([_Adam(k, settings.rate) for k in held] for held in (model.kernels, model.bias))
    weights, last = _Adam(model.weights, settings.rate), _Adam(offset, settings.rate)
    for _ in range(settings.rounds):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), settings.batch):
            own = order[a : a + settings.batch]
            ids = np.concatenate([texts[i] for i in own], axis=1)
            bounds = np.cumsum([0, *(texts[i].shape[1] for i in own)])
            x, wide = _embedded(model, ids, bounds)
            levels = list(_pooled(model, x, wide))
            features = np.concatenate([m for _, m in levels], axis=1)
            error = (_sigmoid(features @ model.weights + offset[0]) - labels[own]).astype(np.float32) / len(own)
            back = error[:, None] * model.weights * (features > 0)
            dx_place, dx_value = [], []
            for w, (width, (out, _)) in enumerate(zip(settings.widths, levels)):
                part = back[:, w * settings.filters : (w + 1) * settings.filters]
                peak = _argmax(out, wide)
                slope = np.zeros_like(model.kernels[w])
                for k in range(width):
                    near = np.minimum(peak + k, len(x) - 1)
                    slope[k * dims : (k + 1) * dims] = np.einsum("rf,rfd->df", part, x[near])
                    dx_place.append(near.ravel())
                    dx_value.append((part[:, :, None] * model.kernels[w][k * dims : (k + 1) * dims].T).reshape(-1, dims))
                kernels[w].step(slope + 1e-5 * model.kernels[w]), biases[w].step(part.sum(axis=0))
            weights.step(features.T @ error + 1e-4 * model.weights), last.step(error.sum(keepdims=True))
            place, value = np.concatenate(dx_place), np.concatenate(dx_value)
            source = np.full(len(x), -1)
            pad = max(settings.widths)
            source[np.arange(ids.shape[1]) + pad * np.repeat(np.arange(len(own)), np.diff(bounds))] = np.arange(ids.shape[1])
            real = source[place] >= 0
            place, value = source[place[real]], value[real]
            for k, table in enumerate(tables):
                rows, to = np.unique(ids[k][place], return_inverse=True)
                slope = np.zeros((len(rows), settings.part), np.float32)
                np.add.at(slope, to, value[:, k * settings.part : (k + 1) * settings.part])
                table.step(slope, rows)
    model.offset = float(offset[0])
    return model


def _argmax(out: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Place of the first largest value of each row and filter."""
    return np.stack([out[a:b].argmax(axis=0) + a for a, b in zip(wide[:-1], wide[1:])])


def _platt(z: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through (z, y), each counted n times, by damped Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * z + b)
        g = np.array([(n * (p - y) * z).sum() + 1e-3 * (a - 1), (n * (p - y)).sum() + 1e-3 * b])
        w = n * (p * (1 - p) + 1e-9)
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        step *= min(1, 2 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
    return float(max(a, 1e-3)), float(b)


def _best_threshold(score: np.ndarray, y: np.ndarray, n: np.ndarray, usual: float) -> float:
    """The threshold with the best F1 over rows counted n times; the usual one where it is as good."""
    def f1(t):
        hit = score >= t
        return 2 * (n * hit * y).sum() / max(1e-9, (n * hit).sum() + (n * y).sum())
    grid = np.round(np.arange(0.1, 0.91, 0.05), 2)
    best = grid[int(np.argmax([f1(t) for t in grid]))]
    return float(best) if f1(best) > f1(usual) else usual


def train(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings()) -> ToxicityModel:
    """Fit on rows of ``docs`` (doc_id, text, lang) that ``labels`` (doc_id, toxic) covers.

    The network sees the rows with the smallest digests of their id, so they do not depend on partitions; a third of
    the ids, by another digest, is kept from it at any size. Rows with a null label are no labels; an id that is
    labelled twice counts as toxic if either says so. With labels of one kind only the score is the share of toxic ones.
    """
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    order = F.xxhash64("doc_id", F.lit(settings.seed))
    kept = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed + 1)), F.lit(3)) == 0
    parts = [known.filter(~kept & (F.col("toxic") == kind)).orderBy(order, "doc_id").limit(n)
             for kind, n in ((1, settings.sample), (0, 2 * settings.sample))]
    chosen = parts[0].unionByName(parts[1])  # at most 3 * sample rows
    texts = docs.filter("doc_id is not null").select("doc_id", F.lower("text").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = _fit(texts, chosen, settings)
    marked = known.join(F.broadcast(chosen.select("doc_id", F.lit(1).alias("fitted"))), "doc_id", "left").fillna(0, ["fitted"])
    return calibrated(model, _counted(texts, written(marked, "labels"), model))


def _fit(texts: DataFrame, chosen: DataFrame, settings: ToxicitySettings) -> ToxicityModel:
    """The network of the chosen rows, without a curve and thresholds."""
    found = written(texts.join(F.broadcast(chosen), "doc_id").drop("lang").mapInArrow(
        _measured, "doc_id long, text string, toxic int, words int"), "sample")
    sizes = found.select("words").toArrow().column("words").to_numpy()  # one number per row of the sample
    rows = found.mapInArrow(_numbered(settings, window_words(sizes, settings.sample_words)), "doc_id long, toxic int, ids binary")

    folder = make_folder(fresh_folder(texts.sparkSession, "network"))

    def fit(table: pa.Table) -> pa.Table:
        return pa.table({"body": pa.array([_packed(_stored(_fit_rows(table, settings), folder))], pa.binary())})

    # The sample is bounded, so one task fits on it, and the driver gets the few weights outside the tables alone.
    done = rows.groupBy(F.lit(0).alias("all")).applyInArrow(fit, "body binary").collect()
    return _unpacked(done[0].body, settings) if done else ToxicityModel(settings)


def window_words(sizes: np.ndarray, budget: int) -> int:
    """The largest w for which rows of these many words, cut to w each, hold ``budget`` words together; at least 1."""
    sizes = np.sort(np.asarray(sizes, np.int64))
    left = budget - np.concatenate([[0], np.cumsum(sizes)])  # when the smallest are taken whole
    for taken, size in enumerate(sizes):
        if left[taken] < size * (len(sizes) - taken):
            return int(max(1, left[taken] // (len(sizes) - taken)))
    return int(max(1, sizes.max(initial=1)))


def _fit_rows(table: pa.Table, settings: ToxicitySettings) -> ToxicityModel:
    """The network of the sampled rows (doc_id, toxic, ids)."""
    rows = table.to_pandas().sort_values(["doc_id", "ids"], kind="stable")
    rows["ids"] = [np.frombuffer(b, np.int32).reshape(1 + len(settings.prefixes), -1) for b in rows["ids"]]
    rows = rows.iloc[np.random.default_rng(settings.seed).permutation(len(rows))]
    fitted = rows[rows["ids"].map(lambda t: t.shape[1]) > 0]
    y = fitted["toxic"].to_numpy()
    return fit_network(list(fitted["ids"]), y, settings) if 0 < y.sum() < len(y) else ToxicityModel(settings)


def _counted(texts: DataFrame, marked: DataFrame, model: ToxicityModel) -> pa.Table:
    """All labelled rows as counts by lang, bin, toxic and fitted. Texts stay where they are; where the labels are too many
    to broadcast, all texts are scored and only their ids and bins meet the labels."""
    sent, names = texts.sparkSession.sparkContext.broadcast(model), ["doc_id", "lang", "bin"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, model = SpanHasher(), sent.value.loaded()
        for batch in batches:
            for first, data, offsets in text_slices(batch, "text", 1 << 20):
                z = logits(model, *word_ids(data, offsets, hasher, model.settings))
                bins = np.floor(np.clip(z, -40, 40) * model.settings.bins).astype(np.int32)
                own = batch.slice(first, len(z))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(bins)], names=names)

    few = marked.count() <= model.settings.near
    if few:
        texts = texts.join(F.broadcast(marked.select("doc_id")), "doc_id", "left_semi")
    kind = texts.schema["doc_id"].dataType.simpleString()
    binned = texts.select("doc_id", "lang", "text").mapInArrow(run, f"doc_id {kind}, lang string, bin int")
    binned = binned.join(F.broadcast(marked) if few else marked, "doc_id")
    return binned.groupBy("lang", "bin", "toxic", "fitted").count().toArrow()


def calibrated(model: ToxicityModel, counts: pa.Table) -> ToxicityModel:
    """The model with its curve and a threshold for each language, from the counts (lang, bin, toxic, fitted, count).

    Rows that the network was fitted on are represented by the others of their label, which are weighted so that labels keep their
    natural share; a label without others is represented by the fitted rows. Each language's rows are joined by those of
    all languages, at the weight of a fixed number of toxic rows, so a rare language nears the common threshold
    without a step, and a frequent one has its own.
    """
    rows = counts.to_pandas().sort_values(["lang", "bin", "toxic", "fitted"], kind="stable")
    weight = rows["count"].to_numpy(dtype=float)
    y, fitted, all_rows = rows["toxic"].to_numpy(dtype=float), rows["fitted"].to_numpy() > 0, weight.copy()
    for label in (0, 1):
        own = y == label
        if weight[own & ~fitted].sum() > 0:
            weight[own & fitted] = 0
            weight[own] *= all_rows[own].sum() / weight[own].sum()
    z = (rows["bin"].to_numpy(dtype=float) + 0.5) / model.settings.bins if model.weights is not None else np.zeros(len(rows))
    toxic, total = (weight * y).sum(), weight.sum()
    one_kind = not 0 < toxic < total
    model.scale = (1.0, float(np.log((toxic + 1) / (total - toxic + 1)))) if one_kind else _platt(z, y, weight)
    score = _sigmoid(model.scale[0] * z + model.scale[1])
    prior = weight * (model.settings.prior / toxic) if toxic else np.zeros(len(rows))
    for lang in sorted(set(rows["lang"].dropna())):
        own = weight * (rows["lang"] == lang).to_numpy()
        model.thresholds[lang] = _best_threshold(score, y, own + prior, model.settings.threshold)
    return model


def _stored(model: ToxicityModel, folder: str) -> ToxicityModel:
    """The model with its tables in a file of the shared folder; of each only the rows that a text taught."""
    if not model.tables:
        return model
    held, parts = io.BytesIO(), {}
    for k, table in enumerate(model.tables):
        parts[f"rows{k}"] = np.flatnonzero(table.any(axis=1)).astype(np.int32)
        parts[f"values{k}"] = table[parts[f"rows{k}"]]
    np.savez(held, **parts)
    return replace(model, tables=[], path=put_bytes(f"{folder}/tables", [held.getvalue()]))


def _packed(model: ToxicityModel) -> bytes:
    held = io.BytesIO()
    plain = {"offset": model.offset, "scale": model.scale, "thresholds": model.thresholds, "path": model.path}
    arrays = {f"{k}{i}": a for k in ("tables", "kernels", "bias") for i, a in enumerate(getattr(model, k))}
    if model.weights is not None:
        arrays["weights"] = model.weights
    np.savez(held, plain=np.frombuffer(json.dumps(plain).encode(), np.uint8), **arrays)
    return held.getvalue()


def _unpacked(body: bytes, settings: ToxicitySettings) -> ToxicityModel:
    held = np.load(io.BytesIO(body))
    plain = json.loads(held["plain"].tobytes())
    parts = [[held[f"{k}{i}"] for i in range(sum(n.startswith(k) for n in held))] for k in ("tables", "kernels", "bias")]
    return ToxicityModel(
        settings, *parts, held["weights"] if "weights" in held else None, plain["offset"], tuple(plain["scale"]),
        plain["thresholds"], plain["path"],
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, toxic) with their number of words."""
    for batch in batches:
        words = [np.diff(word_spans(data, offsets, WORD_BYTE)[2]) for _, data, offsets in text_slices(batch, "text")]
        if words:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            yield pa.RecordBatch.from_arrays(
                [columns["doc_id"].cast(pa.int64()), columns["text"], columns["toxic"].cast(pa.int32()),
                 pa.array(np.concatenate(words), pa.int32())], names=["doc_id", "text", "toxic", "words"],
            )


def _numbered(settings: ToxicitySettings, window: int):
    """Rows (doc_id, text, toxic, words) as bucket numbers: of a window of words, at a place drawn by the id, where there are more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            held, keys = [], batch.column(0).to_numpy().astype(_U64)
            for first, data, offsets in text_slices(batch, "text"):
                ids, bounds = word_ids(data, offsets, hasher, settings)
                spare = np.maximum(np.diff(bounds) - window, 0)
                starts = bounds[:-1] + (mix(keys[first : first + len(spare)] + _U64(settings.seed)) % (spare + 1).astype(_U64)).astype(np.int64)
                held += [np.ascontiguousarray(ids[:, a:b]).tobytes() for a, b in zip(starts, np.minimum(starts + window, bounds[1:]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(held, pa.binary())], names=["doc_id", "toxic", "ids"]
            )

    return run


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` (with doc_id, text, lang) as doc_id, score, flagged, one row per row, over whole texts.

    ``flagged`` compares the score with the threshold of the row's language. Null, empty and wordless texts get
    the score of a text without any feature. Repeated and null ids are answered row by row; a null or unknown language has the
    usual threshold; other columns are ignored; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # tasks read the tables themselves

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, model = SpanHasher(), sent.value.loaded()
        for batch in batches:
            langs = batch.column(2).to_pylist()
            for first, data, offsets in text_slices(batch, "text", 1 << 20):
                ids, bounds = word_ids(data, offsets, hasher, model.settings)
                p = _sigmoid(model.scale[0] * logits(model, ids, bounds) + model.scale[1])
                limit = np.array([model.thresholds.get(l, model.settings.threshold) for l in langs[first : first + len(p)]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(p)), pa.array(p.astype(float)), pa.array(p >= limit)],
                    names=["doc_id", "score", "flagged"],
                )

    source = docs.select("doc_id", F.lower("text").alias("text"), F.col("lang").cast("string").alias("lang"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double, flagged boolean")


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` without the rows that are flagged; rows are judged where they are, nothing is shuffled, and only text and
    language travel to Python."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def fine(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hasher, model = SpanHasher(), sent.value.loaded()
        for low, lang in columns:
            langs, keep = lang.to_pylist(), [np.zeros(0, bool)]
            for first, data, offsets in text_slices(pa.RecordBatch.from_arrays([low], names=["low"]), "low", 1 << 20):
                ids, bounds = word_ids(data, offsets, hasher, model.settings)
                p = _sigmoid(model.scale[0] * logits(model, ids, bounds) + model.scale[1])
                keep.append(p < [model.thresholds.get(l, model.settings.threshold) for l in langs[first : first + len(p)]])
            yield pa.array(np.concatenate(keep))

    return docs.where(fine(F.lower("text"), F.col("lang").cast("string")))
