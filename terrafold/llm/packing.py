"""Sequence packing by Karmarkar-Karp multiway differencing.

Texts become token ids, are cut into pieces, and the pieces of a batch are dealt to windows of one
capacity. Differencing keeps partial partitions of the pieces into k windows, always merges the two with the largest
spread and lays the heavy windows of one onto the light windows of the other, so that imbalances cancel. The sums
end nearly equal; k starts at the least number of windows that could hold the tokens and rises whenever one exceeds
the capacity. Batches are hash groups of bounded expected size, so the work splits over tasks at any scale, and only
ids and lengths are shuffled, never texts.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.arrays import SPACE, WORD_BYTE, ranges, text_slices
from terrafold.llm.store import written


@dataclass(frozen=True)
class PackSettings:
    capacity: int = 4096
    piece: int = 512  # longest piece of what is left behind the full windows of a document
    batch: int = 2048  # expected pieces that are packed together
    end_id: int = 2
    cache: int = 1_500_000  # distinct pieces of text whose ids a task remembers


class PieceTokenizer:
    """Token ids of many texts, with every distinct run of letters or signs encoded once.

    The tokenizer splits texts at white space and between letters and signs before it merges anything, so
    encoding the runs one by one gives the ids of the whole text. A run starts after white space, where an ASCII sign
    follows an ASCII letter or digit, and where one of those follows signs that do not end in an apostrophe
    (contractions). Other characters may combine with their neighbours, so no run starts beside them. Texts of added
    tokens such as an end mark are the ids of these tokens, as the tokenizer has it; no run starts inside one.
    """

    def __init__(self, path: str, cache: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        #: Texts and ids of added tokens: texts are cut at them before anything else, so no other run holds one.
        self.added = [(t.content.encode(), i) for i, t in self.tokenizer.get_added_tokens_decoder().items()]
        self.tokenizer.encode_special_tokens = True
        suffix = "</w>"
        self.word_end = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.word_end[i] = token.endswith(suffix)
        self.limit = cache
        self._reset()

    def _reset(self):
        self.known: dict[bytes, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.lengths = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        for token, i in self.added:
            self.ids[self.used], self.starts[self.used], self.lengths[self.used] = i, self.used, 1
            self.known[token] = self.used
            self.used += 1

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and the offsets of the rows in them."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        space, word = SPACE[data], WORD_BYTE[data]
        sign = ~space & ~word
        begin = ~space
        plain = word & (data < 0x80)
        begin[1:] &= space[:-1] | (sign[1:] & plain[:-1]) | (plain[1:] & sign[:-1] & (data[:-1] != 0x27))
        heads = offsets[:-1][offsets[1:] > offsets[:-1]]
        begin[heads] = ~space[heads]
        for a, b, end in self._added_spans(data, offsets):
            begin[a], begin[a + 1 : b] = True, False
            if b < end:
                begin[b] = ~space[b]
        starts = np.flatnonzero(begin)
        row_first = np.searchsorted(starts, offsets)
        kept = np.zeros(len(data) + 1, np.int64)
        np.cumsum(~space, out=kept[1:])
        bounds = np.append(kept[starts], kept[-1]).astype(np.int64)
        runs = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[~space])]
        ).dictionary_encode()
        entry = self._entries(runs.dictionary.to_pylist())[runs.indices.to_numpy()]
        length = self.lengths[entry]
        row_ends = np.concatenate([[0], np.cumsum(length)])
        return self.ids[ranges(self.starts[entry], length)], row_ends[row_first]

    def _added_spans(self, data: np.ndarray, offsets: np.ndarray):
        """Starts and ends of added tokens inside rows, and the row's end."""
        whole = data.tobytes()
        for token, _ in self.added:
            at = whole.find(token)
            while at >= 0:
                end = int(offsets[np.searchsorted(offsets, at, side="right")])
                if at + len(token) <= end:
                    yield at, at + len(token), end
                at = whole.find(token, at + 1)

    def _entries(self, texts: list[bytes]) -> np.ndarray:
        if len(self.known) + len(texts) > self.limit:
            self._reset()
        known = self.known
        fresh = [t for t in texts if t not in known]
        if fresh:
            self._learn(fresh)
        return np.fromiter(map(known.__getitem__, texts), np.int64, len(texts))

    def _learn(self, fresh: list[bytes]) -> None:
        letters, others = [], []
        for text in fresh:
            word = text.decode()
            (letters if word.isalpha() else others).append(word)
        ids, lengths = [], []
        for a in range(0, len(letters), 5000):  # words of letters share a call; each ends in a word-final token
            block = letters[a : a + 5000]
            found = self._encode([" ".join(block)])[0]
            ends = np.flatnonzero(self.word_end[found]) + 1
            if len(ends) == len(block) and ends[-1] == len(found):
                ids.append(found), lengths.append(np.diff(ends, prepend=0))
            else:
                apart = self._encode(block)
                ids.extend(apart), lengths.append(np.array([len(x) for x in apart]))
        apart = self._encode(others)
        ids.extend(apart), lengths.append(np.array([len(x) for x in apart], dtype=np.int64))
        ids, lengths = np.concatenate(ids), np.concatenate(lengths).astype(np.int64)
        n, at = len(self.known), self.used
        while at + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(lengths) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.ids[at : at + len(ids)] = ids
        self.starts[n : n + len(lengths)] = at + np.cumsum(lengths) - lengths
        self.lengths[n : n + len(lengths)] = lengths
        self.used += len(ids)
        self.known.update(zip((w.encode() for w in letters + others), range(n, n + len(lengths))))

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        encode = self.tokenizer.encode_batch_fast
        return [np.array(e.ids, dtype=np.uint32) for e in encode(texts, add_special_tokens=False)]


def differencing(lengths: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Deal items to k windows: window of each item, and the sums. Largest spreads are merged first."""
    parent = np.arange(len(lengths))
    heap = [(-int(v), i, np.array([v], np.int64), np.array([i])) for i, v in enumerate(lengths)]
    if k == 1:
        return np.zeros(len(lengths), np.int64), np.array([lengths.sum()])
    heapq.heapify(heap)
    while len(heap) > 1:
        _, tie, a, roots_a = heapq.heappop(heap)
        _, _, b, roots_b = heapq.heappop(heap)
        both = max(0, len(a) + len(b) - k)  # windows that hold items of both: light ones of a, heavy-first of b
        parent[roots_b[:both][::-1]] = roots_a[:both]
        sums = np.concatenate([a[:both] + b[:both][::-1], a[both:], b[both:]])
        roots = np.concatenate([roots_a, roots_b[both:]])
        order = np.argsort(sums, kind="stable")
        sums, roots = sums[order], roots[order]
        spread = int(sums[-1] - (sums[0] if len(sums) == k else 0))
        heapq.heappush(heap, (-spread, tie, sums, roots))
    while True:  # every item to the root of its window
        above = parent[parent]
        if (above == parent).all():
            break
        parent = above
    _, _, sums, roots = heap[0]
    number = np.zeros(len(lengths), np.int64)
    number[roots] = np.arange(len(roots))
    return number[parent], sums


def pack(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item, with no window above the capacity. Items must not be longer than it."""
    k = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        window, sums = differencing(lengths, k)
        if sums.max(initial=0) <= capacity:
            return window
        k += 1


def token_pieces(
    docs: DataFrame, tokenizer_path: str, settings: PackSettings = PackSettings(),
    id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Pieces of every row: row, doc_id, start, length, ids_crc32, doc_tokens, and the ids as little-endian
    32-bit numbers if wanted. ``row`` numbers the rows of a task and is no key."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = PieceTokenizer(tokenizer_path, settings.cache)
        for batch in batches:
            keys = batch.column(0)
            for first, data, offsets in text_slices(batch, "text"):
                ids, bounds = encode(data, offsets)
                row, start, length, crc, total, held = [], [], [], [], [], []
                for i in range(len(offsets) - 1):
                    own = np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(settings.end_id)).astype("<u4").tobytes()
                    n = len(own) // 4
                    at = 0
                    while at < n:
                        size = settings.capacity if n - at >= settings.capacity else min(settings.piece, n - at)
                        part = own[4 * at : 4 * (at + size)]
                        row.append(first + i), start.append(at), length.append(size)
                        crc.append(zlib.crc32(part)), total.append(n)
                        if with_ids:
                            held.append(part)
                        at += size
                columns = [keys.take(pa.array(row, pa.int64())), *(pa.array(c, pa.int64()) for c in (start, length, crc, total))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns, names = [*columns, pa.array(held, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return source.mapInArrow(cut, schema + (", ids binary" if with_ids else ""))


def pack_documents(
    docs: DataFrame, tokenizer_path: str, settings: PackSettings = PackSettings(),
    id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Null and empty texts are the end id alone. Rows that repeat a doc_id are documents of their own; a null doc_id
    stays null. Documents of at least one capacity give full windows first, which need no packing. An empty table gives no
    rows. Other columns are ignored. Within a window pieces lie in order of doc_id and start.
    """
    pieces = token_pieces(docs, tokenizer_path, settings, id_column, text_column, with_ids)
    numbered = written(pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    full = F.col("length") == settings.capacity
    whole = numbered.filter(full).select(
        *pieces.columns, (-1 - F.col("piece")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = numbered.filter(~full)
    batches = -(-rest.count() // settings.batch) or 1
    batch = F.pmod(F.xxhash64("piece"), F.lit(batches)).cast("long")
    slim = rest.select("piece", "doc_id", "start", "length", batch.alias("batch"))
    capacity = settings.capacity

    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "piece"])
        lengths = rows["length"].to_numpy()
        window = pack(lengths, capacity)
        before = pd.Series(lengths).groupby(window).cumsum().to_numpy() - lengths
        return pd.DataFrame({
            "piece": rows["piece"].to_numpy(), "sequence_id": rows["batch"].to_numpy() * (1 << 32) + window, "offset": before,
        })

    dealt = slim.repartition(min(batches, 100_000), "batch").groupBy("batch").applyInPandas(
        deal, "piece long, sequence_id long, offset long"
    )
    return rest.join(dealt, "piece").select(*pieces.columns, "sequence_id", "offset").unionByName(whole)
