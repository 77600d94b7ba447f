"""The pipeline's stages, each against what its operator says about the same rows."""

import corpus_pipeline
from terrafold.llm import decontaminate, exact, jaccard, toxicity
from terrafold.llm.catalog import table, toxicity_model
from terrafold.llm.store import written

from .support import awkward_rows, frame, prose, words_of
from .test_exact_chat_urls import normal
from .test_pairs_and_passages import shingles


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_columns_and_carry_out_decisions(spark, folder):
    docs = table(spark, folder, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "decontaminate", "packing"]
    model = toxicity_model(spark, folder)
    one = written(stages["toxicity"](spark, docs, folder), "t")
    assert ids(one) == ids(toxicity.score(docs, model).filter("not flagged"))
    two = written(stages["exact_dedup"](spark, one, folder), "t")
    assert ids(two) == ids(exact.exact_groups(one).filter("kept"))
    three = written(stages["near_dedup"](spark, two, folder), "t")
    assert ids(three) == ids(jaccard.similar_texts(two).filter("doc_id = class_id"))
    four = written(stages["decontaminate"](spark, three, folder), "t")
    bad = {r.doc_id for r in decontaminate.find_items(three, table(spark, folder, "benchmark")).collect()}
    assert ids(four) == sorted(set(ids(three)) - bad) and bad
    for step in (one, two, three, four):
        assert step.schema.names == docs.schema.names
    packed = stages["packing"](spark, four, folder)
    assert sorted({r.doc_id for r in packed.select("doc_id").collect()}) == ids(four)


def kept_by_brute_force(rows, toxic, items):
    """Texts that the filters leave: no toxic row, one of equal texts, one of each class of similar ones, no benchmark item."""
    rows = [r for r in rows if r not in toxic]
    by_text = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        by_text.setdefault(normal(t), (i, t))
    rows = list(by_text.values())
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    rows = [min((rows[k] for k in range(len(rows)) if root[k] == r), key=lambda x: (x[0] is None, x[0] or 0)) for r in set(root)]
    words = [" ".join(words_of(t)) for t in items]
    return sorted(t or "" for _, t in rows if not any(f" {w} " in f" {' '.join(words_of(t))} " for w in words))


def test_filters_equal_brute_force_whatever_the_ids(spark, folder):
    """Exact benchmark copies only, so that brute force needs no edit distance; toxic rows by the operator's own flag."""
    items = [r.text for r in table(spark, folder, "benchmark").collect()]
    near = prose(40, 90)
    rows = [(1, near), (2, near + " more"), (2, "a namesake that is clean"), (3, f"start {items[0]} end"), (3, prose(41, 30)), (None, items[1]),
            (None, near + " again"), (None, prose(42, 25)), (4, "same  text\nhere"), (5, "same text here"), (6, None), (7, ""), (8, "word")]
    docs = frame(spark, [(*r, "en") for r in rows]).withColumnsRenamed({"toxic": "toxic_", "score": "score_"})
    flagged = toxicity.score(docs, toxicity_model(spark, folder)).filter("flagged").count()
    assert flagged == 0  # nothing to take out beforehand
    after = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, after, folder), name)
    assert sorted(r.text or "" for r in after.collect()) == kept_by_brute_force(rows, [], items)


def test_awkward_rows_pass_every_stage(spark, folder):
    docs = frame(spark).withColumnsRenamed({"toxic": "toxic_", "score": "score_"})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, folder), name)
        assert after.columns == docs.columns and after.count() <= docs.count()
        docs = after
    texts = {normal(r.text) for r in docs.collect()}
    assert {"", " ", "word"} <= texts and len(texts) == docs.count() <= len(awkward_rows())


def test_empty_table_passes_every_stage(spark, folder):
    docs = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), name)
    assert docs.count() == 0
