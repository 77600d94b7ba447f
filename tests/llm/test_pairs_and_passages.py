"""Brute-force checks of the Jaccard join, repeated passages and benchmark matches."""

import collections
import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrafold.llm import decontaminate, jaccard, suffixes
from terrafold.llm.arrays import SpanHasher

from .support import awkward_rows, collected, frame, prose, words_of


def shingles(text):
    w = words_of(text)
    return frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else None


def brute_classes(rows, threshold=0.8):
    """(id, text) rows to (representative, class, links) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                links[a], links[b] = links[a] + 1, links[b] + 1
                root[find(a)] = find(b)
    out = []
    low = lambda ids: min((i for i in ids if i is not None), default=None)
    for a, (i, _) in enumerate(rows):
        rep = low(j for (j, _), s in zip(rows, sets) if s == sets[a]) if sets[a] else i
        cls = low(rows[b][0] for b in range(len(rows)) if find(b) == find(a)) if sets[a] else i
        out.append((i, rep, cls, links[a]))
    return sorted(out, key=repr)


def found_classes(df, **options):
    got = jaccard.similar_texts(df, jaccard.JoinSettings(**options)).collect()
    return sorted(((r.doc_id, r.representative, r.class_id, r.n_links) for r in got), key=repr)


def near_rows(n=60):
    """Families of near copies around the threshold, with chains and exact copies."""
    rng, rows = np.random.default_rng(5), []
    for family in range(6):
        words = prose(family, 90 + 30 * family).split()
        for _ in range(n // 6):
            own = list(words)
            for spot in rng.integers(0, len(own), rng.integers(0, 4)):
                own[spot] = f"new{rng.integers(0, 5)}"
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("block", [512, 4])
def test_similar_texts_equal_all_pairs(spark, block):
    rows = near_rows()
    df = frame(spark, rows, "doc_id long, text string")
    assert found_classes(df, block=block, trees=24) == brute_classes(rows)


def test_similar_texts_of_awkward_rows(spark):
    rows = [(i, t) for i, t, _ in awkward_rows() if len(t or "") < 100_000]
    assert found_classes(frame(spark, rows, "doc_id long, text string")) == brute_classes(rows)


def test_similar_texts_of_an_empty_table(spark):
    assert jaccard.similar_texts(frame(spark, [])).count() == 0


def test_dropping_similar_texts(spark):
    rows = near_rows()
    df = frame(spark, rows, "doc_id long, text string")
    left = jaccard.drop_similar(df, jaccard.JoinSettings(trees=24))
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, _, c, _ in brute_classes(rows)})


def test_similar_rows_go_one_by_one(spark):
    """Rows that repeat an id are judged by their texts; rows that repeat id and text leave one."""
    one, two = prose(80, 60), prose(81, 60)
    rows = [(1, one), (2, one + " tail"), (2, "other words stay here"), (3, two), (3, two + " tail"), (None, two + " end"),
            (4, "x y z"), (4, "x y z"), (5, None), (5, None), (None, "")]
    left = jaccard.drop_similar(frame(spark, rows, "doc_id long, text string")).collect()
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in left)
    assert [t[1] for t in texts if t[2].startswith(two)] == [3]
    assert [t for t in texts if not t[2].startswith(two)] == [
        (False, 1, one), (False, 2, "other words stay here"), (False, 4, "x y z"), (False, 5, ""), (False, 5, ""), (True, 0, "")]


def peak_mb(f):
    """Result, and the most that numpy held meanwhile."""
    tracemalloc.start()
    try:
        return f(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_shingles_of_a_long_text_are_made_in_bounded_memory():
    """Words of every length, one of them longer than a piece; the same shingles as hashed at once."""
    rng = np.random.default_rng(7)
    text = " ".join(f"w{x}" for x in rng.integers(0, 10**6, 250_000)) + " " + "x" * 200_000 + " end"
    data = np.frombuffer(text.encode(), np.uint8)
    (one,), mb = peak_mb(lambda: jaccard.shingle_sets(data, np.array([0, len(data)]), 5, SpanHasher()))
    assert mb < 12 * len(data) / 1e6  # 50 bytes for each byte of text before
    starts, ends, _ = jaccard.word_spans(data, np.array([0, len(data)]), jaccard.WORD_BYTE)
    assert (one == np.unique(jaccard.rolling(SpanHasher()(data, starts, ends), 5))).all()


def block_pair(sizes, tree, same):
    """Members of two blocks, or of one, with families of similar sets; the rows in any order."""
    rng = np.random.default_rng(8)
    base = [rng.choice(1 << 62, 300, replace=False).astype(np.uint64) for _ in range(9)]
    sets = []
    for _ in range(sum(sizes)):
        own = base[rng.integers(0, 9)].copy()
        own[: rng.integers(0, 60)] += np.uint64(rng.integers(0, 3))
        sets.append(np.unique(own))
    n, mixed = len(sets), rng.permutation(len(sets))
    return pa.table({
        "node": pa.array(rng.permutation(10 * n)[:n]), "tree": pa.array([tree] * n, pa.int32()), "i": pa.array([0] * n, pa.int32()),
        "j": pa.array([0 if same else 1] * n, pa.int32()), "own": pa.array((np.repeat([0, 0 if same else 1], sizes))[mixed].astype(np.int32)),
        "copies": pa.array(rng.integers(1, 4, n)), "labels": pa.array(rng.integers(0, 4, (n, 10)).tolist(), pa.list_(pa.int64())),
        "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
    })


@pytest.mark.parametrize(("sizes", "tree", "same"), [((60, 50), 3, False), ((60, 50), 0, True), ((4, 0), 0, False), ((0, 4), 2, False)])
def test_a_block_pair_links_what_all_pairs_say(sizes, tree, same):
    table = block_pair(sizes, tree, same)
    rows, sums, root = table.to_pylist(), collections.Counter(), {}
    root = {r["node"]: r["node"] for r in rows}
    sets = {r["node"]: set(np.frombuffer(r["shingles"], np.uint64).tolist()) for r in rows}
    for a in rows:
        for b in rows:
            met = a["node"] != b["node"] and (same or a["own"] != b["own"]) and all(x != y for x, y in zip(a["labels"][:tree], b["labels"][:tree]))
            x, y = sets[a["node"]], sets[b["node"]]
            if met and len(x & y) >= 0.8 * len(x | y) - 1e-9:
                sums[a["node"]] += b["copies"]
                old, new = root[a["node"]], root[b["node"]]
                root = {k: new if v == old else v for k, v in root.items()}
    got = jaccard.verify_group(table, 0.8).to_pylist()
    assert {r["a"]: r["n"] for r in got if r["kind"] == 0} == sums
    found = {r["node"]: r["node"] for r in rows}
    for r in got:
        if r["kind"] == 1:
            assert found[r["a"]] != found[r["n"]]  # a forest
            found = {k: found[r["n"]] if v == found[r["a"]] else v for k, v in found.items()}
    parts = lambda of: sorted(sorted(k for k in of if of[k] == v) for v in set(of.values()))
    assert parts(found) == parts(root)


def test_two_full_blocks_are_verified_in_bounded_memory():
    table = block_pair((512, 512), 0, False)
    _, mb = peak_mb(lambda: jaccard.verify_group(table, 0.8))
    assert mb < 20  # 35 MB before


def test_depth_is_the_longest_that_reaches_the_recall():
    s = jaccard.JoinSettings()
    reach = lambda d: 1 - (1 - s.threshold**d) ** s.trees
    assert reach(s.prefix()) >= s.recall > reach(s.prefix() + 1)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    got = {r.node: r.root for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260)]}


def brute_passages(texts, length):
    count = collections.Counter(b[p : p + length] for b in texts for p in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((gone & ~np.append(False, gone[:-1])).sum())
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passage_rows():
    passage, line = prose(50, 80), prose(51, 20)
    rows = [(i, t) for i, t, _ in awkward_rows() if len(t or "") < 100_000]
    rows += [(100 + i, f"{prose(60 + i, 30)} {passage} {prose(80 + i, 30)}") for i in range(8)]
    rows += [(200, "é" * 300), (201, "xyz" * 200), (202, "xyz" * 67 + "q"), (203, f"{line}\n" * 6), (204, "ab" * 99 + "c"),
             (205, passage[:199]), (206, passage[5:205]), (207, "a" * 200), (208, passage + passage)]
    return rows


@pytest.mark.parametrize("largest", [200_000, 2])
def test_passages_equal_all_windows(spark, largest):
    rows = passage_rows()
    df = frame(spark, rows, "doc_id long, text string")
    got = suffixes.remove_repeats(df, suffixes.RepeatSettings(largest=largest, flush=50))
    have = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()), key=repr)
    want = brute_passages([(t or "").encode() for _, t in rows], 200)
    assert have == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=repr)


def test_passages_of_an_empty_table(spark):
    assert suffixes.remove_repeats(frame(spark, [])).count() == 0


@given(st.lists(st.text("ab", max_size=40), min_size=1, max_size=12), st.integers(2, 6))
@settings(max_examples=60, deadline=None)
def test_column_order_finds_equal_strings_of_a_column(texts, length):
    texts = [t.encode() for t in texts]
    ahead = np.array([len(t) // 2 for t in texts])
    want, seen = set(), collections.defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            seen[p - ahead[i], t[p : p + length]].append(i)
    for (column, _), own in seen.items():
        if len(own) > 1:
            want |= {(column, i) for i in own}
    got = {(c, i) for c, hits in suffixes.column_order(texts, ahead, length) for i in hits}
    assert got == want


def test_long_texts_are_cut_into_chunks(monkeypatch):
    monkeypatch.setattr(suffixes, "_CHUNK", 500)
    data = np.frombuffer((prose(9, 400) * 2).encode(), np.uint8)
    _, _, row, lo, hi, _ = suffixes.segments_of(
        data, np.array([0, len(data)]), suffixes.RepeatSettings(), suffixes.SpanHasher()
    )
    assert (np.sort(np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, hi)])) == np.arange(len(data) - 199)).all()
    assert (row == 0).all()


def edits(a, b):
    """Fewest edits of a against any part of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


ITEMS = [(1, prose(70, 14)), (2, prose(71, 30)), (3, None), (4, ""), (5, "ab"), (6, prose(72, 20)), (6, prose(73, 20))]


def damaged(text, n, seed):
    rng, out = np.random.default_rng(seed), list(text)
    for _ in range(n):
        at, kind = int(rng.integers(1, len(out) - 1)), int(rng.integers(0, 3))
        if kind == 0:
            out[at] = "z"
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, "q")
    return "".join(out)


def leak_rows():
    rows = [(i, t) for i, t, _ in awkward_rows()]
    for k, (_, item) in enumerate(i for i in ITEMS if len(i[1] or "") > 10):
        rows.append((300 + k, f"{prose(90 + k, 40)} {item.upper().replace(' ', ',  ')}. {prose(95 + k, 10)}"))
        rows.append((310 + k, item))
        for n in (2, 5, 30, 60):
            rows.append((400 + 10 * n + k, f"{prose(100 + k, 30)} {damaged(item, n, k)} {prose(110 + k, 30)}"))
        rows.append((320 + k, item[: len(item) // 2]))
    return rows


def test_matches_equal_full_alignment(spark):
    rows = leak_rows()
    got = decontaminate.find_items(
        frame(spark, rows, "doc_id long, text string"), frame(spark, ITEMS, "item_id long, text string", clash=False)
    ).collect()
    have = collections.defaultdict(list)
    for r in got:
        have[r.doc_id, r.item_id].append(r)
    want = {}
    for i, text in rows:
        if len(text or "") > 20_000:
            continue
        body = " ".join(words_of(text))
        for j, item in ITEMS:
            m = " ".join(words_of(item))
            if 0 < len(m.encode()) < 8 and f" {m} " in f" {body} ":
                want[i, j] = 0
            if len(m) >= 8 and len(body) >= len(m) * 0.8:
                k = min(len(m.encode()) // 10, len(m.encode()) // 8 - 1)
                n = edits(m.encode(), body.encode())
                if n <= k:
                    want[i, j] = min(n, want.get((i, j), n))
    assert {k: min(r.edits for r in v) for k, v in have.items()} == want
    for (i, _), own in have.items():
        text = next(t for d, t in rows if d == i).lower()
        for r in own:
            assert r.edits or " ".join(words_of(text[r.start : r.start + r.length])) in {" ".join(words_of(t)) for _, t in ITEMS}


def test_small_blocks_give_the_same_matches(spark):
    docs = frame(spark, leak_rows(), "doc_id long, text string")
    items = frame(spark, ITEMS, "item_id long, text string", clash=False)
    one = sorted(map(tuple, decontaminate.find_items(docs, items).collect()), key=repr)
    small = decontaminate.MatchSettings(block_bytes=50, at_once=10)
    assert sorted(map(tuple, decontaminate.find_items(docs, items, small).collect()), key=repr) == one


def test_matches_of_empty_tables(spark):
    docs, items = frame(spark, []), frame(spark, [], "item_id long, text string")
    assert decontaminate.find_items(docs, frame(spark, ITEMS, "item_id long, text string")).count() == 0
    assert decontaminate.find_items(frame(spark), items).columns == ["doc_id", "item_id", "start", "length", "edits"]
    left = decontaminate.drop_contaminated(frame(spark), items)
    assert decontaminate.drop_contaminated(docs, frame(spark, ITEMS, "item_id long, text string")).count() == 0
    assert left.count() == len(awkward_rows()) and left.columns == frame(spark).columns


def places_of(spark, text, items, **options):
    rows = decontaminate.find_items(
        frame(spark, [(1, text)], "doc_id long, text string"),
        frame(spark, list(enumerate(items)), "item_id long, text string", clash=False), decontaminate.MatchSettings(**options),
    ).collect()
    return sorted((r.item_id, r.start, r.length, r.edits) for r in rows)


@pytest.mark.parametrize("item, gap", [
    ("good morning", " x "), ("the cat sat on mat", " "), ("cat dog", " "), ("ab", " b "), ("abcdefgh", " "), (prose(7, 25), " and "), ("a" * 40, " "),
])
def test_every_place_counts(spark, item, gap):
    text = "x y " + gap.join([item] * 12) + " z"
    want = [(0, k, len(item), 0) for k in range(len(text)) if text.startswith(item, k) and text[k - 1 : k] + text[k + len(item) :][:1] == "  "]
    assert len(want) == 12 and places_of(spark, text, [item]) == want
    assert places_of(spark, text, [item, "absent item here"], block_bytes=4, at_once=3) == want


def test_exact_and_damaged_places_of_one_item(spark):
    item = prose(31, 20)
    bad = damaged(item, 4, 1)
    text = f"{item} one {bad} two {item}{item[-1]} {bad}"
    got = places_of(spark, text, [item])
    assert [g[3] > 0 for g in got] == [False, True, False, True]
    assert all(a[1] + a[2] <= b[1] for a, b in zip(got, got[1:]))
    assert [text[g[1] : g[1] + g[2]] for g in got if not g[3]] == [item, item]


def test_short_items_are_whole_words(spark):
    got = places_of(spark, "Concatenate the CAT, cat-dog; catdog dog", ["cat", "cat dog", "dog", "!?", "the cat"])
    assert got == [(0, 16, 3, 0), (0, 21, 3, 0), (1, 21, 7, 0), (2, 25, 3, 0), (2, 37, 3, 0), (4, 12, 7, 0)]


def test_rows_are_judged_by_their_own_text(spark):
    """Namesakes of contaminated rows stay, contaminated rows without an id go."""
    item = prose(72, 20)
    rows = [(1, f"see {item} here"), (1, "clean namesake"), (None, item), (None, "clean"), (None, None), (2, "ab"), (2, "abc")]
    items = frame(spark, [(None, item), (4, "ab")], "item_id long, text string", clash=False)
    for options in ({}, {"block_bytes": 10}):
        left = decontaminate.drop_contaminated(
            frame(spark, rows, "doc_id long, text string"), items, decontaminate.MatchSettings(**options))
        assert sorted((r.text or "") for r in left.collect()) == ["", "abc", "clean", "clean namesake"]


@given(st.text("abc", min_size=8, max_size=24), st.text("abc", max_size=60))
@settings(max_examples=80, deadline=None)
def test_banded_alignment_equals_the_full_table(item, region):
    best = decontaminate.align(item.encode(), region.encode(), -len(item), len(region), len(item))
    assert best[0] == edits(item, region)
    assert edits(item, region[best[1] : best[2]]) == best[0]


def test_collected_helper(spark):
    assert len(collected(frame(spark))) == len(awkward_rows())
