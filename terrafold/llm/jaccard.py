"""Self-join of texts by the Jaccard similarity of their word shingles, with a MinHash LSH forest.

1. Texts with one set of shingles form a class; its smallest id represents it, and only representatives go on.
2. A signature of minima is cut into trees. A tree sorts its labels, sequences of minima, as a prefix trie; two
   texts that share a prefix are candidates. Prefixes start at full depth and are shortened until the chance that a
   pair at the threshold shares one in some tree reaches the target recall; deeper prefixes are contained in shorter
   ones, so the groups at that depth hold every candidate of the descent.
3. Candidates are verified exactly on their shingles, group by group. Groups with the same members in several trees
   are verified once, a large group is dealt in blocks to many tasks, and a pair counts in the first tree that holds it,
   so pairs are never listed. A task returns sums of links per text and a spanning forest of the links it found.
4. Classes are the connected components of those forests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.arrays import WORD_BYTE, SpanHasher, mix, ranges, rolling, runs, text_slices, word_spans
from terrafold.llm.store import written

_U64 = np.uint64
#: Bytes whose words are hashed together, and shared shingles that are counted together.
HASHED_BYTES, COUNTED = 1 << 17, 1024


@dataclass(frozen=True)
class JoinSettings:
    words: int = 5
    threshold: float = 0.8
    trees: int = 10
    depth: int = 8  # minima in the full label of a tree
    recall: float = 0.999  # chance that a pair at the threshold shares a prefix in some tree
    block: int = 512  # members of a group that one block holds, and
    block_shingles: int = 1_500_000  # shingles; two blocks meet in a task

    def prefix(self) -> int:
        """Depth of the descent: the longest prefix that reaches the target recall."""
        for depth in range(self.depth, 1, -1):
            if 1 - (1 - self.threshold**depth) ** self.trees >= self.recall:
                return depth
        return 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hasher: SpanHasher) -> np.ndarray:
    """Hashes of the words, in pieces of bounded size; only a longer word is a larger piece. A hash does not depend on
    where its word stands."""
    out = np.empty(len(starts), _U64)
    a = 0
    while a < len(starts):
        low = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, low + HASHED_BYTES, side="right")))
        out[a:b] = hasher(data[low : ends[b - 1]], starts[a:b] - low, ends[a:b] - low)
        a = b
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int, hasher: SpanHasher) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row of lower-cased text. A text with fewer words is one shingle."""
    starts, ends, first = word_spans(data, offsets, WORD_BYTE)
    hashes = word_hashes(data, starts, ends, hasher)
    joined = rolling(hashes, words)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= words:
            out.append(np.unique(joined[a : b - words + 1]))
        else:
            out.append(rolling(hashes[a:b], b - a) if b > a else np.zeros(0, _U64))
    return out


def signature(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Minimum of each seeded permutation of the shingles, in pieces of bounded size."""
    low = np.full(len(seeds), np.iinfo(np.uint64).max, _U64)
    for a in range(0, len(shingles), 4096):
        part = shingles[a : a + 4096]
        mixed = (part[None, :] ^ seeds[:, None]) * _U64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> _U64(29)
        mixed *= _U64(0xBF58476D1CE4E5B9)
        np.minimum(low, mixed.min(axis=1), out=low)
    return mix(low)


def sketched(docs: DataFrame, settings: JoinSettings, id_column: str, text_column: str, full: bool) -> DataFrame:
    """doc, node (64-bit digest of the shingle set; null without words), n (shingles), and either the labels of the
    trees or, if ``full``, the shingles themselves."""
    depth = settings.prefix()
    seeds = mix(np.arange(1, settings.trees * depth + 1, dtype=_U64))

    def labels_of(s: np.ndarray) -> list[int] | None:
        if not len(s):
            return None
        folded = np.zeros(settings.trees, _U64)
        for level in signature(s, seeds).reshape(settings.trees, depth).T:
            folded = mix(folded * _U64(0x100000001B3) + level)
        return folded.view(np.int64).tolist()

    def node_of(s: np.ndarray) -> int | None:
        if not len(s):
            return None
        digest = np.array([np.bitwise_xor.reduce(mix(s)), np.add.reduce(mix(s ^ _U64(0x5851F42D4C957F2D))), len(s)], _U64)
        return int(rolling(digest, 3).view(np.int64)[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            for first, data, offsets in text_slices(batch, "text"):
                sets = shingle_sets(data, offsets, settings.words, hasher)
                if full:
                    last = pa.array([s.tobytes() for s in sets], pa.binary())
                else:
                    last = pa.array([labels_of(s) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(sets)), batch.column(1).slice(first, len(sets)), pa.array([node_of(s) for s in sets], pa.int64()),
                     pa.array([len(s) for s in sets], pa.int64()), last],
                    names=["doc", "digest", "node", "n", "shingles" if full else "labels"],
                )

    low = docs.select(F.col(id_column).cast("long").alias("doc"), F.xxhash64(text_column).alias("digest"), F.lower(text_column).alias("text"))
    return low.mapInArrow(run, "doc long, digest long, node long, n long, " + ("shingles binary" if full else "labels array<long>"))


def similar_texts(
    docs: DataFrame, settings: JoinSettings = JoinSettings(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row: id, representative (smallest id with the same shingles), class_id (smallest id of all that
    are linked, directly or through others), n_links (other rows with at least the threshold), copies.

    Words are runs of letters, digits and non-ASCII characters of the lower-cased text; a text with fewer words than a
    shingle is one shingle. Null, empty and wordless texts have no shingles: each is a class of its own without
    links. Ids become long integers. Rows that repeat an id are rows of their own; null ids stay null and never name a class that has
    another id. An empty table gives no rows; other columns are ignored.
    """
    sketches, wordy, classes = _classes(docs, settings, id_column, text_column)
    members = wordy.select("doc", "node").join(classes, "node").select(
        F.col("doc").alias(id_column), F.col("rep").alias("representative"), "class_id", "n_links", "copies"
    )
    bare = sketches.filter("node is null").select(
        F.col("doc").alias(id_column), F.col("doc").alias("representative"), F.col("doc").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("copies"),
    )
    return members.unionByName(bare)


def _classes(docs: DataFrame, settings: JoinSettings, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of all rows, those with words, and (node, root, rep, class_id, copies, n_links)."""
    sketches = written(sketched(docs, settings, id_column, text_column, False), "sketches")
    wordy = sketches.filter("node is not null")
    heads = written(wordy.groupBy("node").agg(
        F.min("doc").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
        F.first("labels").alias("labels"),
    ), "classes")
    found = written(_verified(docs, heads, settings, id_column, text_column), "links")
    linked = found.filter("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    named = components(found.filter("kind = 1").select("a", F.col("n").alias("b")))
    joined = heads.select("node", "rep", "copies").join(named, "node", "left").join(linked, "node", "left")
    joined = joined.withColumn("root", F.coalesce("root", "node"))
    smallest = joined.groupBy("root").agg(F.min("rep").alias("class_id"))
    classes = written(joined.join(smallest, "root").select(
        "node", "root", "rep", "class_id", "copies", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    ), "named")
    return sketches, wordy, classes


def drop_similar(
    docs: DataFrame, settings: JoinSettings = JoinSettings(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest id, null ids last, and of one id the least text digest.

    Rows are told apart by id and text, so a row never goes for a namesake. Of rows that repeat both one stays.
    Texts without words are classes of their own.
    """
    sketches, _, classes = _classes(docs, settings, id_column, text_column)
    row = F.struct(F.isnull("doc").alias("none"), "doc", "digest")
    members = written(sketches.join(classes.select("node", "root"), "node").select("root", "doc", "digest", row.alias("row")), "members")
    keepers = members.groupBy("root").agg(F.min("row").alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    going = members.join(keepers, "root").filter(~F.col("row").eqNullSafe(F.col("keeper"))).select("doc", "digest").distinct()
    marked = docs.withColumns({"__id": F.col(id_column).cast("long"), "__digest": F.xxhash64(text_column)})
    kept = marked.join(going, marked["__id"].eqNullSafe(going["doc"]) & (marked["__digest"] == going["digest"]), "left_anti")
    repeated = members.groupBy("doc", "digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not repeated.isEmpty():
        wordless = sketches.filter("node is null").select("doc", "digest").distinct()
        place = F.row_number().over(Window.partitionBy("__id", "__digest").orderBy(F.lit(0)))
        is_bare = kept["__id"].eqNullSafe(wordless["doc"]) & (kept["__digest"] == wordless["digest"])
        bare, rest = (kept.join(wordless, is_bare, how) for how in ("left_semi", "left_anti"))
        kept = rest.withColumn("__place", place).filter("__place = 1").drop("__place").unionByName(bare)
    return kept.select(*docs.columns)


def _verified(docs: DataFrame, heads: DataFrame, settings: JoinSettings, id_column: str, text_column: str) -> DataFrame:
    """Rows of kind 0 (a: node, n: linked rows found in one task) and kind 1 (a, n: an edge)."""
    leaf = heads.select("node", "n", F.posexplode("labels").alias("tree", "label"))
    shared = leaf.groupBy("tree", "label").agg(
        F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members"),
        F.sum("n").alias("shingles"),
    ).filter("size > 1")
    once = shared.groupBy("size", "members", "shingles").agg(F.min(F.struct("tree", "label")).alias("of"))
    blocks = F.greatest(F.ceil(F.col("size") / settings.block), F.ceil(F.col("shingles") / settings.block_shingles))
    once = once.select("of.*", F.least(blocks, "size").cast("int").alias("blocks"))
    placed = written(leaf.join(once.hint("merge"), ["tree", "label"]).select(
        "node", "tree", "label", "blocks", F.pmod(F.xxhash64("node", F.lit(7)), "blocks").cast("int").alias("own")
    ), "groups")
    need = placed.select("node").distinct().join(heads.select("node", "rep", "copies", "labels"), "node")
    reps = need.select("rep").distinct().hint("merge")
    texts = docs.join(reps, docs[id_column].cast("long").eqNullSafe(reps["rep"]), "left_semi")
    sets = sketched(texts, settings, id_column, text_column, True).groupBy("node").agg(F.first("shingles").alias("shingles"))
    carried = need.drop("rep").join(sets.hint("merge"), "node")
    # Block pairs (i, j) with i <= j: a member goes to every pair that holds its block.
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "tree", "label", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    threshold = settings.threshold

    def verify(table: pa.Table) -> pa.Table:
        return verify_group(table, threshold)

    rows = dealt.join(carried, "node")
    return rows.groupBy("tree", "label", "i", "j").applyInArrow(verify, "kind int, a long, n long")


def verify_group(table: pa.Table, threshold: float) -> pa.Table:
    """Links of one block pair: sums per text, and a spanning forest. Only pairs of a row of block i and one of block j
    are compared, which within one block are all pairs."""
    tree, i, j = (table.column(c)[0].as_py() for c in ("tree", "i", "j"))
    docs, copies, own = (table.column(c).to_numpy() for c in ("node", "copies", "own"))
    labels = table.column("labels").combine_chunks().flatten().to_numpy().reshape(len(docs), -1)
    order = np.lexsort([docs, own])  # rows of block i first
    docs, copies, labels = docs[order], copies[order].astype(np.int64), labels[order]
    sets = _views(table.column("shingles"), order)
    sizes = np.array([len(s) for s in sets])
    split = int((own == i).sum())
    left, right = slice(0, split), slice(split if i != j else 0, len(sets))
    common = overlaps(sets, left, right)
    linked = common >= threshold * (sizes[left, None] + sizes[None, right] - common) - 1e-9
    for earlier in range(tree):  # counted in the first tree that holds both
        linked &= labels[left, earlier][:, None] != labels[right, earlier][None, :]
    if i != j:
        n = np.concatenate([linked @ copies[right], linked.T @ copies[left]])
        both = np.zeros((len(sets), len(sets)), bool)
        both[left, right], both[right, left] = linked, linked.T
    else:
        np.fill_diagonal(linked, False)
        n, both = linked @ copies, linked
    some = np.flatnonzero(n)
    a, b = forest(both)
    kind = np.concatenate([np.zeros(len(some), np.int32), np.ones(len(a), np.int32)])
    return pa.table({"kind": kind, "a": np.concatenate([docs[some], docs[a]]), "n": np.concatenate([n[some], docs[b]])})


def _views(column: pa.ChunkedArray, order: np.ndarray) -> list[np.ndarray]:
    """The shingles of the rows in this order, not copied."""
    held = column.cast(pa.large_binary()).combine_chunks()
    _, where, data = held.buffers()
    offsets = np.frombuffer(where, np.int64)[held.offset : held.offset + len(held) + 1]
    return [np.frombuffer(data, _U64, (offsets[k + 1] - offsets[k]) // 8, offsets[k]) for k in order]


def overlaps(sets: list[np.ndarray], left: slice, right: slice) -> np.ndarray:
    """Numbers of common elements of each set on the left with each on the right, by products of incidence matrices in
    column blocks."""
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    starts, lengths = runs(values[order])
    shared = lengths > 1
    starts, lengths = starts[shared], lengths[shared]
    out = np.zeros((len(sets[left]), len(sets[right])), np.float32)
    for c in range(0, len(starts), COUNTED):
        s, n = starts[c : c + COUNTED], lengths[c : c + COUNTED]
        held = np.zeros((len(sets), len(s)), np.float32)
        held[owner[order[ranges(s, n)]], np.repeat(np.arange(len(s)), n)] = 1
        out += held[left] @ held[right].T
    return out


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    left = np.ones(len(linked), bool)
    a, b = [], []
    for root in range(len(linked)):
        if not left[root]:
            continue
        left[root] = False
        edge = [root]
        while edge:
            k = edge.pop()
            fresh = np.flatnonzero(linked[k] & left)
            left[fresh] = False
            a.extend([k] * len(fresh)), b.extend(fresh.tolist()), edge.extend(fresh.tolist())
    return np.array(a, np.int64), np.array(b, np.int64)


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) for the nodes of undirected edges (a, b).

    Alternates large-star and small-star steps: neighbours are hung on the smallest node known, until nothing
    changes. The number of rounds grows with the logarithm of the longest chain, and edges never grow in number. A
    step only needs the smallest neighbour of each node, so hubs are summed before they are shuffled.
    """
    edges = written(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "lowest")
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.filter("a != b").distinct(), "large-star")
        low = written(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = written(small.filter("a != b").distinct(), "small-star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return leaves.unionByName(roots)
