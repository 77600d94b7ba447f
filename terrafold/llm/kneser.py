"""Interpolated modified Kneser-Ney language model, counted in Spark and stored as sorted hash arrays.

Tokens are hashed to 64 bits and numbered by their place in the sorted vocabulary. Only n-grams of the highest order are
counted in the texts. Tasks sum what they have read before anything is shuffled, as packed arrays, one row per task and
shard. An n-gram goes to the shard of the last word of its context, so a shard has all suffixes of its n-grams whole: it
knows each n-gram's count, each context's total and how many of its continuations were seen once, twice or more,
and counts the distinct left extensions of each suffix for the next lower order by itself. Contexts that end in a common
word (one that makes up an eighth of a shard) are spread by all their words instead; only their suffixes are shuffled
once more. A context that a third of all tokens share costs each task at most one entry per following word.

Each file of a shard and order holds sorted context hashes with totals, and for each context its following words in order with
counts, in as few bytes as they need. Workers map the files into memory and look up whole batches by binary search; nothing of the model passes through the driver but
file names, sums and the counts of counts, which have a fixed size per shard.
"""

from __future__ import annotations

import json
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.arrays import LOWER, SPACE, SpanHasher, mix, ranges, runs, text_slices, word_spans
from terrafold.llm.store import fresh_folder, local_name, make_folder, put_bytes, read_bytes, remove_folder

_U64 = np.uint64
END_HASH = _U64(0)  # the end token; hashes of words are never 0


@dataclass(frozen=True)
class ModelSettings:
    order: int = 3
    shard_tokens: int = 4_000_000  # expected tokens per shard
    flush: int = 3_000_000  # n-grams that a task gathers before it sums and packs them


@dataclass
class Model:
    """Places and sums of a stored model; small at any size of the corpus."""

    order: int
    shards: int
    tokens: int  # all training tokens, with ends
    words: int  # distinct training tokens
    base: list[int]  # first word number of each vocabulary shard
    vocabulary: list[str]  # one file per shard
    grams: list[list[str]]  # by order - 1, a file per shard, then one per shard for contexts that end in a common word
    discounts: list[list[float]]  # by order - 1: of counts 1, 2 and more
    unigram: dict = field(default_factory=dict)  # total of the lowest order and its kinds of counts
    common: list[int] = field(default_factory=list)  # numbers of words whose n-grams are spread over shards


class Mapped:
    """Arrays of one file, mapped into memory; where the shared folder is not mounted, a local copy that
    vanishes with the process."""

    def __init__(self, path: str):
        name = local_name(path)
        if name is None:
            copy = tempfile.TemporaryFile()
            copy.write(read_bytes(path))
            copy.flush()
            held = np.memmap(copy, dtype=np.uint8, mode="r")
        else:
            held = np.memmap(name, dtype=np.uint8, mode="r")
        head = json.loads(bytes(held[8 : 8 + int(held[:8].view(np.int64)[0])]))
        held = np.asarray(held)  # slices of a memmap are slow to make
        self.arrays = {
            k: held[at : at + n * np.dtype(kind).itemsize].view(kind) for k, kind, at, n in head
        }

    def __getitem__(self, name: str) -> np.ndarray:
        return self.arrays[name]


def save(path: str, arrays: dict[str, np.ndarray]) -> str:
    head, at = [], 8192
    for name, a in arrays.items():
        head.append((name, a.dtype.str, at, len(a)))
        at += (a.nbytes + 7) // 8 * 8
    text = json.dumps(head).encode()
    parts = [np.int64(len(text)).tobytes() + text.ljust(8184)]
    for a in arrays.values():
        parts.append(a.tobytes() + bytes(-a.nbytes % 8))
    return put_bytes(path, parts)


def token_hashes(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the rows, each row closed by an end token, and the rows' offsets in them."""
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, ~SPACE)
    words = np.maximum(hasher(low, starts, ends), _U64(1))
    rows = len(offsets) - 1
    bounds = first + np.arange(rows + 1)
    out = np.empty(len(words) + rows, dtype=_U64)
    out[bounds[1:] - 1] = END_HASH
    held = np.ones(len(out), bool)
    held[bounds[1:] - 1] = False
    out[held] = words
    return out, bounds


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of the hash space, so shards are in hash order."""
    return ((hashes >> _U64(32)) * _U64(shards) >> _U64(32)).astype(np.int64)


def summed(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the key columns in order, with summed counts."""
    order = np.lexsort(keys[::-1])
    keys, counts = [k[order] for k in keys], counts[order]
    if not len(counts):
        return keys, counts
    new = np.zeros(len(counts), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(new)
    return [k[at] for k in keys], np.add.reduceat(counts, at)


class Vocabulary:
    """Numbers of token hashes; unknown ones get the number ``words``."""

    def __init__(self, model: Model):
        self.model = model
        self.files = [Mapped(p) if p else None for p in model.vocabulary]

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and training count of each hash."""
        distinct, back = np.unique(hashes, return_inverse=True)
        number = np.full(len(distinct), self.model.words, np.int64)
        count = np.zeros(len(distinct), np.int64)
        edges = np.searchsorted(shard_of(distinct, self.model.shards), np.arange(self.model.shards + 1))
        for s, held in enumerate(self.files):
            a, b = edges[s], edges[s + 1]
            if held is None or a == b:
                continue
            at = np.minimum(np.searchsorted(held["hash"], distinct[a:b]), len(held["hash"]) - 1)
            hit = held["hash"][at] == distinct[a:b]
            number[a:b][hit] = self.model.base[s] + at[hit]
            count[a:b][hit] = held["count"][at[hit]]
        return number[back], count[back]


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    out = np.full(len(columns[0]), len(columns), dtype=_U64)
    for c in columns:
        out = mix(out * _U64(0x100000001B3) + c.astype(_U64))
    return out


def windows(numbers: np.ndarray, bounds: np.ndarray, order: int, begin: int) -> list[np.ndarray]:
    """The ``order`` columns of each token's n-gram; what lies before a row is the begin number."""
    place = np.arange(len(numbers)) - np.repeat(bounds[:-1], np.diff(bounds))
    columns = [numbers]
    for back in range(1, order):
        shifted = np.full(len(numbers), begin, numbers.dtype)
        shifted[back:] = numbers[:-back] if back < len(numbers) else begin
        shifted[place < back] = begin
        columns.insert(0, shifted)
    return columns


def train(texts: DataFrame, settings: ModelSettings = ModelSettings()) -> Model:
    """Count and store a model of the column ``text``. Null counts as empty; an empty table gives a model without
    tokens, which scores every text at chance."""
    spark = texts.sparkSession
    folder = make_folder(fresh_folder(spark, "ngrams"))
    texts = texts.select("text")
    shards = _shards(texts, settings)
    vocabulary = _shuffled(texts.mapInArrow(_count_words(shards, settings.flush), "shard int, body binary"), shards)
    rows = _by_shard(vocabulary, _store_words(folder), _WORDS)
    found = {r.shard: r for r in rows}
    words = [found[s].words if s in found else 0 for s in range(shards)]
    model = Model(
        settings.order, shards, sum(r.tokens for r in rows), sum(words), np.cumsum([0, *words])[:-1].tolist(),
        [found[s].path if s in found else "" for s in range(shards)],
        [[] for _ in range(settings.order)], [[0.0] * 3 for _ in range(settings.order)],
    )
    model.common = _common_words(model, rows, settings)
    body = texts.mapInArrow(_count_grams(model, settings), "shard int, body binary")
    kinds = [[0] * 4 for _ in range(settings.order)]
    small, spent = None, []
    for order in range(settings.order, 0, -1):
        place = fresh_folder(spark, f"order-{order}")
        _shuffled(body, shards).groupBy("shard").applyInArrow(_store_grams(folder, model, order), _STORED).write.parquet(place)
        spent.append(place)
        stored = spark.read.schema(_STORED).parquet(place)
        for r in stored.filter("path is not null").drop("body").collect():  # one row per shard and order
            files = model.grams[r.ngram - 1]
            files += [""] * (2 * shards - len(files))
            files[r.shard] = r.path
            kinds[r.ngram - 1] = [n + r[f"n{i}"] for i, n in enumerate(kinds[r.ngram - 1], 1)]
            if r.ngram == 1:
                model.unigram = {k: model.unigram.get(k, 0) + r[k] for k in ("total", "k1", "k2", "k3")}
        tails = stored.filter("body is not null").select("ngram", F.col("to_shard").alias("shard"), "body")
        ones = tails.filter("ngram = 1").drop("ngram")
        small = ones if small is None else small.unionByName(ones)
        body = small if order == 2 else tails.filter(F.col("ngram") == order - 1).drop("ngram")
    model.discounts = [_discounts(n) for n in kinds]
    for place in spent:
        remove_folder(place)
    return model


def _common_words(model: Model, rows: list, settings: ModelSettings) -> list[int]:
    """Numbers of the words that make up a good part of a shard: at most ``COMMON`` for each shard of the vocabulary."""
    if settings.order < 3:
        return []
    bar = max(model.tokens // model.shards // COMMON, 1)
    found = []
    for r in rows:
        found += [model.base[r.shard] + at for at, n in zip(r.top_at, r.top_count) if n > bar]
    return sorted(found) + [model.words + 1]  # the beginning of a text, too


_WORDS = "shard int, path string, tokens long, words long, top_at array<int>, top_count array<long>"
COMMON = 8  # a word is common when it makes up this part of a shard's tokens

_STORED = (
    "shard int, ngram int, path string, n1 long, n2 long, n3 long, n4 long, total long, k1 long, k2 long, k3 long, "
    "to_shard int, body binary"
)


def _shards(texts: DataFrame, settings: ModelSettings) -> int:
    """From the bytes of all texts: about six to a token."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(size // 6 // settings.shard_tokens) + 4


def _shuffled(body: DataFrame, shards: int) -> DataFrame:
    return body.repartition(shards, "shard")


def _by_shard(body: DataFrame, f, schema: str) -> list:
    return body.groupBy("shard").applyInArrow(f, schema).collect()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["shard", "body"]
    )


def _count_words(shards: int, flush: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = SpanHasher(), [], 0

        def out():
            (keys,), counts = summed([np.concatenate([h for h, _ in held])], np.concatenate([c for _, c in held]))
            return _batch(list(packed_grams(shard_of(keys, shards), [keys], counts, np.dtype(np.uint64))))

        for batch in batches:
            for _, data, offsets in text_slices(batch, "text"):
                hashes, _ = token_hashes(data, offsets, hasher)
                held.append(np.unique(hashes, return_counts=True))
                size += len(held[-1][0])
                if size > flush:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return count


def _store_words(folder: str):
    def store(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        (keys,), counts = summed(*unpacked_grams(table.column("body").to_pylist(), 1, np.dtype(np.uint64)))
        path = save(f"{folder}/words-{shard}", {"hash": keys, "count": counts})
        top = np.argsort(-counts, kind="stable")[:_TOP]
        return pa.table({
            "shard": pa.array([shard], pa.int32()), "path": [path], "tokens": [int(counts.sum())], "words": [len(keys)],
            "top_at": pa.array([top], pa.list_(pa.int32())), "top_count": pa.array([counts[top]], pa.list_(pa.int64())),
        })

    return store


_TOP = 256  # words of a shard that may be common: fewer than COMMON * shards are, over all shards


def _width(model: Model) -> np.dtype:
    return np.dtype(np.uint32 if model.words + 2 < 1 << 32 else np.uint64)


def turned(keys: list[np.ndarray], back: bool = False) -> list[np.ndarray]:
    """Columns with the last word of the context first: sorted so, a shard's first column hardly changes."""
    if len(keys) < 3:
        return keys
    return [*keys[1:-1], keys[0], keys[-1]] if back else [keys[-2], *keys[:-2], keys[-1]]


def _route(keys: list[np.ndarray], model: Model) -> np.ndarray:
    """Shard of an n-gram: by the last word of its context, so that all orders of it meet. Contexts that end in a common
    word are spread by all their words and numbered behind the other shards. The lowest order goes by the word itself."""
    if len(keys) < 2:
        return shard_of(gram_hash(keys), model.shards)
    out = shard_of(gram_hash(keys[-2:-1]), model.shards)
    often = _is_common(keys[-2], model)
    if often.any():
        out[often] = model.shards + shard_of(gram_hash([k[often] for k in keys[:-1]]), model.shards)
    return out


def _is_common(words: np.ndarray, model: Model) -> np.ndarray:
    if not model.common:
        return np.zeros(len(words), bool)
    common = np.array(model.common, np.int64)
    at = np.minimum(np.searchsorted(common, words), len(common) - 1)
    return common[at] == words


def _count_grams(model: Model, settings: ModelSettings):
    width, order, shards = _width(model), model.order, model.shards

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, vocabulary, held, size = SpanHasher(), Vocabulary(model), [], 0

        def out():
            columns = [np.concatenate([h[c] for h in held]) for c in range(order)]
            keys, counts = summed(turned(columns), np.ones(len(columns[0]), np.int64))
            return _batch(list(packed_grams(_route(turned(keys, back=True), model) % shards, keys, counts, width)))

        for batch in batches:
            for _, data, offsets in text_slices(batch, "text"):
                hashes, bounds = token_hashes(data, offsets, hasher)
                numbers = vocabulary(hashes)[0].astype(width)
                held.append(windows(numbers, bounds, order, model.words + 1))
                size += len(numbers)
                if size > settings.flush:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return count


def packed_grams(shard: np.ndarray, keys: list[np.ndarray], counts: np.ndarray, width: np.dtype) -> Iterator[tuple]:
    """Like ``packed``, for sorted keys: counts as bytes where they fit, the first column as steps, and each column's
    bytes by significance, so that the high ones compress to nothing."""
    order = np.argsort(shard, kind="stable")
    starts, lengths = runs(shard[order])
    for s, n in zip(starts, lengths):
        own = order[s : s + n]
        small = np.minimum(counts[own], 255).astype(np.uint8)
        large = counts[own][small == 255].astype(np.int64)
        steps = np.diff(keys[0][own], prepend=keys[0].dtype.type(0))
        columns = [steps, *(k[own] for k in keys[1:])]
        yield int(shard[own[0]]), b"".join(
            [np.int64(n).tobytes(), *(_planes(k.astype(width)) for k in columns), small.tobytes(), large.tobytes()]
        )


def _planes(column: np.ndarray) -> bytes:
    return np.ascontiguousarray(column.view(np.uint8).reshape(-1, column.itemsize).T).tobytes()


def unpacked_grams(blobs: list[bytes], columns: int, width: np.dtype) -> tuple[list[np.ndarray], np.ndarray]:
    keys, counts = [[] for _ in range(columns)], []
    for blob in blobs:
        n, at = int(np.frombuffer(blob, np.int64, 1)[0]), 8
        for c in range(columns):
            planes = np.frombuffer(blob, np.uint8, n * width.itemsize, at).reshape(width.itemsize, n)
            column = np.ascontiguousarray(planes.T).reshape(-1).view(width)
            keys[c].append(column if c else np.cumsum(column, dtype=width))
            at += n * width.itemsize
        count = np.frombuffer(blob, np.uint8, n, at).astype(np.int64)
        count[count == 255] = np.frombuffer(blob[at + n :], np.int64)
        counts.append(count)
    return [np.concatenate(k) for k in keys], np.concatenate(counts)


def _store_grams(folder: str, model: Model, order: int):
    """Store the n-grams of a shard. Those behind common words hand their suffixes on to the next order's job; all other
    suffixes are whole here already, down to the second order, so they are stored at once."""
    width, shards = _width(model), model.shards
    kinds_of = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 8, pa.int32(), pa.binary()]
    names = [x.split()[0] for x in _STORED.split(", ")]

    def store(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, counts = summed(*unpacked_grams(table.column("body").to_pylist(), order, width))
        keys = turned(keys, back=True)  # rows stay in the other order, in which contexts are whole, too
        rows: list[tuple] = []

        def keep(keys: list[np.ndarray], counts: np.ndarray, often: bool) -> None:
            n = len(keys)
            arrays, sums = _gram_arrays(keys, counts)
            path = save(f"{folder}/order{n}-{shard}-{int(often)}", arrays)
            rows.append((shard + often * shards, n, path, *sums, None, None))
            if n == 1:
                return
            # Every distinct n-gram is one left extension of its suffix.
            tails, ones = summed(turned(keys[1:]), np.ones(len(counts), np.int64))
            if n > 2 and not often:
                keep(turned(tails, back=True), ones, False)
            else:
                sent = packed_grams(_route(turned(tails, back=True), model) % shards, tails, ones, width)
                rows.extend((shard, n - 1, None, *[None] * 8, s, b) for s, b in sent)

        often = _is_common(keys[-2], model) if order > 1 else np.zeros(len(counts), bool)
        for flag in (False, True):
            own = often if flag else ~often
            if own.any():
                keep([k[own] for k in keys], counts[own], flag)
        return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, kinds_of))})

    return store


def _gram_arrays(keys: list[np.ndarray], counts: np.ndarray) -> tuple[dict[str, np.ndarray], list[int]]:
    """The arrays of a file, and sums: kinds of counts 1 to 4, the total, and counts of 1, 2 and more."""
    arrays, low = {}, np.minimum(counts, 3)
    kinds = np.bincount(low, minlength=4)
    if len(keys) > 1:  # contexts are whole in a shard, as neighbours
        change = np.zeros(len(counts), bool)
        change[0] = True
        for k in keys[:-1]:
            change[1:] |= k[1:] != k[:-1]
        at = np.flatnonzero(change)
        context = gram_hash([k[at] for k in keys[:-1]])
        into = np.argsort(context)
        sizes = np.diff(np.append(at, len(counts)))[into]
        arrays["context"] = context[into]
        first = np.cumsum(sizes) - sizes
        arrays["base"] = first[::_BLOCK].copy()
        arrays |= _bytes("first", first - np.repeat(arrays["base"], _BLOCK)[: len(first)], np.uint16)
        arrays |= _bytes("size", sizes) | _bytes("total", np.add.reduceat(counts, at)[into])
        for i in (2, 3):  # the others were seen once
            arrays |= _bytes(f"k{i}", np.add.reduceat((low == i).astype(np.int64), at)[into])
        own = ranges(at[into], sizes)
    else:
        own = np.arange(len(counts))
    word = keys[-1][own]
    if len(keys) > 1 and (not len(word) or int(word.max()) < 1 << 24):  # three bytes
        arrays |= {"word": (word & 0xFFFF).astype(np.uint16), "word_top": (word >> 16).astype(np.uint8)}
    else:
        arrays["word"] = word
    arrays |= _bytes("count", counts[own])
    exact = np.bincount(np.minimum(counts, 5), minlength=6)
    return arrays, [*(int(exact[i]) for i in range(1, 5)), int(counts.sum()), *(int(kinds[i]) for i in (1, 2, 3))]


_BLOCK = 64  # contexts that share a base of their first places


def _bytes(name: str, values: np.ndarray, kind=np.uint8) -> dict[str, np.ndarray]:
    """Values in a narrow type, and those that do not fit by place."""
    top = np.iinfo(kind).max
    large = np.flatnonzero(values >= top)
    return {name: np.minimum(values, top).astype(kind), f"{name}_at": large, f"{name}_large": values[large].astype(np.int64)}


def _read(held: Mapped, name: str, place: np.ndarray) -> np.ndarray:
    """Values of ``_bytes`` at these places."""
    small = held[name][place]
    out = small.astype(np.int64)
    big = np.flatnonzero(small == np.iinfo(small.dtype).max)
    if len(big):
        out[big] = held[f"{name}_large"][np.searchsorted(held[f"{name}_at"], place[big])]
    return out


def _discounts(n: list[int]) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more from the counts of counts; plain halves where those are too few."""
    n1, n2, n3, n4 = n
    if not (n1 and n2 and n3 and n4):
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.0), i + 1 - 1e-9) for i, d in enumerate(raw)]


class Scorer:
    """Probabilities of tokens under a stored model, for whole batches."""

    def __init__(self, model: Model):
        self.model, self.vocabulary = model, Vocabulary(model)
        self.files = [[Mapped(p) if p else None for p in paths] for paths in model.grams]

    def chances(self, numbers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        model = self.model
        chance = np.full(len(numbers), 1.0 / (model.words + 1))
        if not model.tokens:
            return chance
        columns = windows(numbers, bounds, model.order, model.words + 1)
        distinct, back = np.unique(numbers, return_inverse=True)
        chance = self._level(1, [distinct], chance[: len(distinct)])[back]
        for order in range(2, model.order + 1):
            chance = self._level(order, columns[model.order - order :], chance)
        return chance

    def _level(self, order: int, keys: list[np.ndarray], lower: np.ndarray) -> np.ndarray:
        """P = (count - discount) / total + (left-over mass) * lower, per n-gram; shard by shard, contexts in order, so that
        neighbouring probes touch neighbouring pages."""
        steps = np.array([0.0, *self.model.discounts[order - 1]])
        out = lower.copy()
        route = _route(keys, self.model)
        context = gram_hash(keys[:-1]) if order > 1 else None
        turn = np.argsort(context) if order > 1 else np.arange(len(route))
        narrow = np.uint16 if 2 * self.model.shards < 1 << 16 else np.int64
        by_shard = turn[np.argsort(route[turn].astype(narrow), kind="stable")]
        starts, lengths = runs(route[by_shard])
        for s, n in zip(starts, lengths):
            own = by_shard[s : s + n]
            files = self.files[order - 1]
            held, words = files[route[own[0]]] if files else None, keys[-1][own]
            if order == 1:
                u = self.model.unigram
                total = np.full(n, float(u["total"]))
                free = steps[1] * u["k1"] + steps[2] * u["k2"] + steps[3] * u["k3"]
                spare = np.full(n, free / u["total"])
            elif held is None:
                continue
            else:
                place, hit = _find(held["context"], context[own])
                total = np.where(hit, _read(held, "total", place), 0).astype(float)
                size, k2, k3 = (_read(held, k, place) for k in ("size", "k2", "k3"))
                free = steps[1] * (size - k2 - k3) + steps[2] * k2 + steps[3] * k3
                spare = np.where(hit, free / np.maximum(total, 1), 1.0)
            count = np.zeros(n)
            if held is not None:
                if order == 1:
                    place, hit = _find(held["word"], words.astype(held["word"].dtype))
                else:
                    first = held["base"][place // _BLOCK] + _read(held, "first", place)
                    place, hit = _within(_words_of(held), first, np.where(hit, first + size, first), words)
                count[hit] = _read(held, "count", place[hit])
            gain = np.maximum(count - steps[np.minimum(count, 3).astype(int)], 0)
            out[own] = np.where(total > 0, gain / np.maximum(total, 1), 0) + spare * lower[own]
        return out


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return place, table[place] == keys


def _words_of(held: Mapped):
    """Word numbers by place."""
    word = held["word"]
    if "word_top" not in held.arrays:
        return lambda at: word[at]
    top = held["word_top"]
    return lambda at: word[at] | (top[at].astype(np.uint32) << np.uint32(16))


def _within(table, low: np.ndarray, high: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys in the sorted ranges [low, high) of the table, and whether they are there."""
    place, end = low.copy(), high.copy()
    left = np.flatnonzero(place < end)
    while len(left):
        middle = (place[left] + end[left]) >> 1
        less = table(middle) < keys[left]
        place[left[less]] = middle[less] + 1
        end[left[~less]] = middle[~less]
        left = left[place[left] < end[left]]
    hit = place < high
    hit[hit] = table(place[hit]) == keys[hit]
    return place, hit


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: id, n_tokens, n_known, base_score, score (log10 probabilities), perplexity.

    Null and empty texts are the end token alone. Tokens that were not trained on share the chance that the lowest
    order leaves for one unknown word. Ids may repeat or be null; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, scorer = SpanHasher(), Scorer(model)
        floor = model.tokens + model.words + 1
        for batch in batches:
            parts = []
            for _, data, offsets in text_slices(batch, "text"):
                hashes, bounds = token_hashes(data, offsets, hasher)
                numbers, counts = scorer.vocabulary(hashes)
                logs = np.log10(scorer.chances(numbers, bounds))
                base = np.log10((counts + 1) / floor)
                parts.append([np.diff(bounds), *(np.add.reduceat(x, bounds[:-1]) for x in (
                    (counts > 0).astype(np.int64), base, logs))])
            if parts:
                n, known, base, logs = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *map(pa.array, (n, known, base, logs))],
                    names=["id", "n_tokens", "n_known", "base_score", "score"],
                )

    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    scored = source.mapInArrow(run, f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        F.col("id").alias(id_column), "n_tokens", "n_known", "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
