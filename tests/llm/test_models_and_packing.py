"""Packing against the tokenizer itself; models against plain versions and held-out rows."""

import collections
import math
import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrafold.llm import kneser, langid, packing, toxicity
from terrafold.llm.arrays import text_slices
from terrafold.llm.catalog import QUERIES, tokenizer_path

from .support import awkward_rows, collected, frame, prose

VOCABULARY = tokenizer_path("word_bpe_49k.json")
ODD = [
    "it's 'til rock'n'roll ''s don't.\"s 'LL", "a1b2 x_y __z 3rd", "é̃ ẗ T̈ ≠ ≮a", "x y z", "İstanbul ΑΣ ς",
    "<|endoftext|> hi<|startoftext|>", "a <|endoftext|> b", "--<|endoftext|><|endoftext|>'s é<|startoftext|>é", "<|ENDOFTEXT|><|endof text|>",
    "<|endoftext", "|>", "", " \n\t ", "日本語。漢字", "🙂🙂 ok🙂", "\x00a\x01 \x1cb", "'", " '", "A.́b", "x" * 3000,
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def ids_of(encode, texts):
    batch, out = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"]), []
    for _, data, offsets in text_slices(batch, "text"):
        ids, bounds = encode(data, offsets)
        out += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    return out


def test_ids_equal_those_of_whole_texts(tokenizer):
    texts = ODD + [t or "" for _, t, _ in awkward_rows()]
    small = packing.PieceTokenizer(VOCABULARY, 5)  # forgets all the time
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids_of(packing.PieceTokenizer(VOCABULARY, 10**6), texts) == want
    assert [ids_of(small, [t])[0] for t in texts] == want


@given(st.lists(st.text("aZé'’.,-_ \n1²́ ßΣ<|>s", max_size=30), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_ids_of_any_text(tokenizer, texts):
    encode = packing.PieceTokenizer(VOCABULARY, 10**6)
    assert ids_of(encode, texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@given(st.lists(st.integers(1, 100), min_size=1, max_size=60))
@settings(max_examples=150, deadline=None)
def test_no_window_exceeds_the_capacity(lengths):
    lengths = np.array(lengths)
    window = packing.pack(lengths, 100)
    sums = np.bincount(window, weights=lengths)
    assert sums.max() <= 100 and window.min() >= 0


def test_differencing_keeps_sums_near_each_other():
    lengths = np.random.default_rng(1).integers(1, 513, 2000)
    window, sums = packing.differencing(lengths, 150)
    assert sums.max() - sums.min() <= 0.005 * sums.mean()
    assert (np.sort(np.bincount(window, weights=lengths)) == np.sort(sums)).all()


def test_packed_pieces(spark, tokenizer):
    rows = awkward_rows()
    config = packing.PackSettings(batch=40)
    got = collected(packing.pack_documents(frame(spark), VOCABULARY, config, with_ids=True))
    assert got.groupby("sequence_id").length.sum().max() <= 4096
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert list(own.offset) == list(own.length.cumsum() - own.length)
    want = collections.Counter()
    for i, text, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want[(-1 if i is None else i, len(ids))] += 1
    have = collections.Counter()
    for r in got.itertuples():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        if r.start == 0:
            have[(-1 if r.doc_id != r.doc_id else int(r.doc_id), r.doc_tokens)] += 1
    assert have == want
    single = got[got.doc_id == 11].sort_values("start")
    assert b"".join(single.ids) == np.array([*tokenizer.encode(rows[12][1]).ids, 2], "<u4").tobytes()


def test_packing_wastes_little(spark, folder):
    got = collected(QUERIES["op5_packing"](spark, folder))
    assert got.length.sum() / (got.sequence_id.nunique() * 4096) > 0.985


def test_packing_an_empty_table(spark):
    assert packing.pack_documents(frame(spark, []), VOCABULARY).count() == 0


def tokens_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["\0end"]


class PlainModel:
    """Interpolated modified Kneser-Ney by dictionaries."""

    def __init__(self, texts, order):
        self.order, self.count = order, [collections.Counter() for _ in range(order + 1)]
        for t in texts:
            w = ["^"] * (order - 1) + tokens_of(t)
            self.count[order].update(tuple(w[i - order + 1 : i + 1]) for i in range(order - 1, len(w)))
        for n in range(order - 1, 0, -1):
            self.count[n].update(g[1:] for g in self.count[n + 1])
        self.words = len({g[-1] for g in self.count[order]})
        self.discounts = [None] + [
            kneser._discounts([sum(c == k for c in self.count[n].values()) for k in range(1, 5)]) for n in range(1, order + 1)
        ]
        self.follow = [collections.defaultdict(list) for _ in range(order + 1)]
        for n in range(1, order + 1):
            for g, c in self.count[n].items():
                self.follow[n][g[:-1]].append(c)

    def chance(self, gram):
        n = len(gram)
        if not n:
            return 1 / (self.words + 1)
        lower, counts = self.chance(gram[1:]), self.follow[n].get(gram[:-1])
        if not counts:
            return lower
        d = self.discounts[n]
        spare = sum(d[min(c, 3) - 1] for c in counts)
        c = self.count[n].get(gram, 0)
        return (max(c - d[min(c, 3) - 1], 0) if c else 0) / sum(counts) + spare / sum(counts) * lower

    def score(self, text):
        w = ["^"] * (self.order - 1) + tokens_of(text)
        return sum(math.log10(self.chance(tuple(w[i - self.order + 1 : i + 1]))) for i in range(self.order - 1, len(w)))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_language_model_equals_dictionaries(spark, order):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["The", "cat", "dog", "sat", "on", "a", "mat", "é"], rng.integers(0, 12))) for _ in range(80)]
    texts += [None, "", "dog dog dog dog"]
    df = frame(spark, [(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    model = kneser.train(df, kneser.ModelSettings(order=order, flush=30))
    plain = PlainModel(texts, order)
    asked = [(0, "the cat sat"), (1, "a zebra"), (2, None), (3, "DOG\tmat\n\nÉ"), (None, "cat " * 5000), (3, "on")]
    got = kneser.score(frame(spark, asked, "doc_id long, text string"), model).collect()
    assert sorted(r.score for r in got) == pytest.approx(sorted(plain.score(t) for _, t in asked), rel=1e-9)
    assert model.tokens == sum(len(tokens_of(t)) for t in texts)
    assert sum(plain.chance(("the", w)[2 - min(order, 2):]) for w in {g[-1] for g in plain.count[1]}) < 1


def test_registered_model_sees_two_words_back(spark):
    """After "a b" always x, after "c b" always y: only a model of three words can tell."""
    texts = frame(spark, [(i, ("a b x ", "c b y ")[i % 2] * 300) for i in range(20)], "doc_id long, text string")
    model = kneser.train(texts)
    got = kneser.score(frame(spark, [(0, "a b x"), (1, "a b y")], "doc_id long, text string"), model).collect()
    right, wrong = (r.score for r in sorted(got, key=lambda r: r.doc_id))
    assert model.order >= 3 and right > wrong + 1
    plain = PlainModel([r.text for r in texts.collect()], 3)  # counts beyond a byte
    assert [right, wrong] == pytest.approx([plain.score("a b x"), plain.score("a b y")], rel=1e-9)


def test_counts_beyond_a_byte_survive_packing():
    keys, counts = [np.arange(5, dtype=np.uint32), np.arange(5, dtype=np.uint32)[::-1].copy()], np.array([1, 254, 255, 256, 10**9])
    (_, body), = kneser.packed_grams(np.zeros(5, np.int64), keys, counts, np.dtype(np.uint32))
    back, n = kneser.unpacked_grams([body], 2, np.dtype(np.uint32))
    assert (n == counts).all() and all((a == b).all() for a, b in zip(back, keys))


def test_language_model_without_texts(spark):
    model = kneser.train(frame(spark, []))
    got = collected(kneser.score(frame(spark), model))
    assert len(got) == len(awkward_rows()) and np.isfinite(got.score).all() and (got.n_known == 0).all()


def test_scores_beat_single_counts_on_held_out_texts(spark, folder):
    got = collected(QUERIES["op9_lm_scoring"](spark, folder))
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


LANGUAGES = {
    "en": "the and that with this from they have would there their what about which when make like time just know",
    "de": "der die und nicht mit auf eine auch sich dem werden aus haben einer über würde kein durch wieder schon",
    "fr": "les des une est dans qui pour pas sur plus par avec tout faire être même aussi très où déjà",
}


def language_rows(seed, n=40):
    rng = np.random.default_rng(seed)
    return [(i, " ".join(rng.choice(LANGUAGES[l].split(), 1 + int(rng.integers(2, 30)))), l)
            for i, l in enumerate(rng.choice(sorted(LANGUAGES), n))]


def test_languages_of_new_texts(spark):
    model = langid.train(frame(spark, language_rows(1, 150)), langid.LanguageSettings(flush=500))
    assert model.languages == sorted(LANGUAGES)
    asked = language_rows(2)
    got = collected(langid.predict(frame(spark, asked), model)).set_index("doc_id")
    assert sum(got.lang_pred[i] == l for i, _, l in asked) >= 0.95 * len(asked)
    assert got.score.between(0, 1).all()


def test_languages_of_awkward_rows(spark):
    rows = awkward_rows()
    model = langid.train(frame(spark, rows + language_rows(3)))
    got = langid.predict(frame(spark), model).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (5, 6, 7))
    assert all(r.lang_pred in {*model.languages, "und"} for r in got)
    nothing = langid.train(frame(spark, []))
    assert {r.lang_pred for r in langid.predict(frame(spark), nothing).collect()} == {"und"}
    assert langid.predict(frame(spark, []), model).count() == 0


def test_filters_hold_every_typical_gram_and_match_plain_counts(spark):
    rows = language_rows(5, 60)
    config = langid.LanguageSettings(lengths=(3,))
    model = langid.train(frame(spark, rows), config)
    count = collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        padded = " " + " ".join(text.split()) + " "
        count[lang].update(g for g in (padded[i : i + 3] for i in range(len(padded) - 2)) if g[1] != " ")
    share = {l: {g: n / sum(c.values()) for g, n in c.items()} for l, c in count.items()}
    grams = sorted({g for c in share.values() for g in c})
    points = np.array([[0 if x == " " else ord(x) for x in g] for g in grams], np.uint32)
    keys = langid.rolling(points.ravel().astype(np.uint64), 3)[::3] + np.uint64(3)
    words = np.bitwise_and.reduce([model.words[s, 0] for s in langid.slots_of(keys, config)])
    for k, lang in enumerate(model.languages):
        want = np.array([share[lang].get(g, 0) > 0 and share[lang][g] >= 0.5 * max(s.get(g, 0) for s in share.values()) for g in grams])
        have = (words >> np.uint64(k) & np.uint64(1)).astype(bool)
        assert have[want].all() and (have != want).mean() < 0.02


def test_more_languages_than_bits(spark):
    rows = [(i, chr(0x4E00 + i) * 6, f"l{i:03}") for i in range(70)]
    model = langid.train(frame(spark, rows))
    assert model.words.shape[1] == 2
    got = {r.doc_id: r.lang_pred for r in langid.predict(frame(spark, rows), model).collect()}
    assert sum(got[i] == l for i, _, l in rows) >= 69


def toxic_rows(seed, n):
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        words = prose(seed * 1000 + i, int(rng.integers(5, 60))).split()
        bad = bool(rng.random() < 0.3)
        if bad:
            for at in rng.integers(0, len(words), 3):
                words[at] = ("grobian" if i % 2 else "vilain") + rng.choice(list("abcdefgh"))
        rows.append((i, " ".join(words), "de" if i % 2 else "fr", int(bad)))
    return rows


SMALL = toxicity.ToxicitySettings(hash_bits=14, rounds=6, sample=200)


@pytest.fixture(scope="module")
def toxic_model(spark):
    rows = toxic_rows(1, 600)
    labels = frame(spark, [(i, t) for i, _, _, t in rows] + [(None, 1), (10**6, 1), (3, None)], "doc_id long, toxic int")
    docs = frame(spark, [r[:3] for r in rows] + [r for r in awkward_rows() if r[0] is None])
    return toxicity.train(docs, labels, SMALL)


def test_toxic_texts_are_told_apart(spark, toxic_model):
    rows = toxic_rows(2, 300)
    got = collected(toxicity.score(frame(spark, [r[:3] for r in rows]), toxic_model)).set_index("doc_id")
    assert sum((got.score[i] >= 0.3) == t for i, _, _, t in rows) >= 0.95 * len(rows)
    assert sum(got.flagged[i] == t for i, _, _, t in rows) >= 0.95 * len(rows)
    assert set(toxic_model.thresholds) == {"de", "fr"}


def test_driver_holds_no_tables_of_the_network(toxic_model):
    loaded = toxic_model.loaded()
    assert len(pickle.dumps(toxic_model)) < 50_000 < sum(t.nbytes for t in loaded.tables)
    assert not toxic_model.tables and len(loaded.tables) == 1 + len(SMALL.prefixes)
    assert all(t.shape == (1 << SMALL.hash_bits, SMALL.part) and t.any() for t in loaded.tables)


def test_toxicity_of_awkward_rows(spark, toxic_model):
    df = frame(spark).drop("toxic").drop("score")
    got = collected(toxicity.score(df, toxic_model))
    assert len(got) == len(awkward_rows()) and got.score.between(0, 1).all()
    left = toxicity.drop_toxic(df, toxic_model)
    assert left.columns == df.columns
    assert sorted(left.toArrow().column("text").to_pylist(), key=str) == sorted(
        (t for (_, t, _), f in zip(awkward_rows(), got.flagged) if not f), key=str)
    assert toxicity.score(frame(spark, []), toxic_model).count() == 0


def test_scores_do_not_depend_on_language_or_neighbours(spark, toxic_model):
    rows = toxic_rows(3, 40)
    one = collected(toxicity.score(frame(spark, [r[:3] for r in rows]), toxic_model)).set_index("doc_id").score
    two = collected(toxicity.score(frame(spark, [(i, t, None) for i, t, *_ in rows[::-1]]).repartition(7), toxic_model)).set_index("doc_id").score
    assert np.allclose(one.sort_index(), two.sort_index(), atol=1e-6)


def test_thresholds_cover_every_labelled_row(spark):
    rows = [(i, t, "es" if i % 40 == 0 else l, y) for i, t, l, y in toxic_rows(4, 900)]
    docs, labels = frame(spark, [r[:3] for r in rows]), frame(spark, [(i, y) for i, _, _, y in rows], "doc_id long, toxic int")
    seen, real = [], toxicity.calibrated
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(toxicity, "calibrated", lambda model, counts: seen.append(counts.to_pandas()) or real(model, counts))
        models = [toxicity.train(docs, labels, toxicity.ToxicitySettings(hash_bits=12, rounds=2, sample=30, near=n)) for n in (10**6, 0)]
    for counts in seen:
        assert counts["count"].sum() == 900 and counts[counts.fitted == 1]["count"].sum() == 90
    assert models[0].thresholds == models[1].thresholds and models[0].scale == models[1].scale
    assert set(models[0].thresholds) == {"de", "fr", "es"}


def counts_of(cells):
    return pa.table(dict(zip(("lang", "bin", "toxic", "fitted", "count"), map(list, zip(*cells)))))


def test_thresholds_of_rare_languages_near_the_common_one():
    def model_of(*cells):
        model = toxicity.ToxicityModel(toxicity.ToxicitySettings(), weights=np.ones(1, np.float32))
        return toxicity.calibrated(model, counts_of(cells))

    common = [("en", 600, 1, 0, 500), ("en", 0, 0, 0, 450), ("en", 0, 1, 0, 250), ("en", -900, 0, 0, 5000)]
    rare = model_of(*common, ("es", 600, 1, 0, 1), ("es", 0, 0, 0, 8))
    assert rare.thresholds["es"] == rare.thresholds["en"] != 0.3
    many = model_of(*common, ("es", 0, 1, 0, 900), ("es", -900, 0, 0, 3000))
    assert many.thresholds["es"] < many.thresholds["en"]


def test_labels_keep_their_share_when_most_toxic_rows_are_fitted_on():
    def scale(*cells):
        model = toxicity.ToxicityModel(toxicity.ToxicitySettings(), weights=np.ones(1, np.float32))
        return toxicity.calibrated(model, counts_of(cells)).scale

    whole = scale(("en", 300, 1, 0, 90), ("en", -300, 1, 0, 10), ("en", 300, 0, 0, 50), ("en", -300, 0, 0, 950))
    part = scale(("en", 300, 1, 0, 9), ("en", -300, 1, 0, 1), ("en", 5000, 1, 1, 90), ("en", 300, 0, 0, 50), ("en", -300, 0, 0, 950))
    assert part == pytest.approx(whole, rel=1e-6)


def test_a_long_text_takes_no_row_out_of_the_sample(spark):
    assert toxicity.window_words(np.array([3, 10**7, 5, 4]), 20) == 8
    assert toxicity.window_words(np.array([3, 5]), 20) == 5 and toxicity.window_words(np.array([], int), 20) == 1
    rows = toxic_rows(6, 200)
    rows += [(10**4 + i, "lorem ipsum " * 4000, "de", 0) for i in range(20)]
    labels = frame(spark, [(i, y) for i, _, _, y in rows], "doc_id long, toxic int")
    config = toxicity.ToxicitySettings(hash_bits=12, rounds=6, sample=200, sample_words=6000)
    model = toxicity.train(frame(spark, [r[:3] for r in rows]), labels, config)
    asked = toxic_rows(7, 100)
    got = collected(toxicity.score(frame(spark, [r[:3] for r in asked]), model)).set_index("doc_id")
    assert model.weights is not None and got.score.nunique() > 1
    assert sum((got.score[i] >= 0.3) == t for i, _, _, t in asked) >= 85


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1)]])
def test_labels_of_one_kind(spark, labels):
    model = toxicity.train(frame(spark), frame(spark, labels, "doc_id long, toxic int"), SMALL)
    got = collected(toxicity.score(frame(spark), model))
    assert got.score.nunique() == 1 and got.score.between(0, 1).all()


def test_held_out_quality_of_registered_models(spark):
    folder = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    got = collected(QUERIES["op6_language_id"](spark, folder))
    held = got[got.held_out]
    assert (held.lang_pred == held.doc_id.map(langs)).mean() > 0.97
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
