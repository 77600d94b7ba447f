"""One registered query per operator, each over its whole table, and its DuckDB SQL where there is one."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.llm import (
    chat, decontaminate, divergence, exact, jaccard, kneser, langid, packing, pages, runs, suffixes, toxicity, urls,
)

QUERIES = {}
ORACLES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; every executor has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_decontaminate(spark, folder):
    """Every place where a document holds a benchmark item within the edit budget."""
    return decontaminate.find_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query
def op2_chat_format(spark, folder):
    """All conversations and one that is full of control strings, formatted and read back."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    formatted = chat.format_conversations(rows.unionByName(extra))
    back = chat.read_back(formatted)
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", lines), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _escaped_sql(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for control in chat.ChatTemplate().controls():
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


_MARKERS = chat.ChatTemplate()
ORACLES["op2_chat_format"] = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{CONTROL_TEXT}' union all select -1, 1, 'assistant', '{CONTROL_TEXT}'
), folded as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as lines,
    coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '') as loss,
    sum(length({_escaped_sql('role')}) + length({_escaped_sql('text')})
        + {len(_MARKERS.turn_open + _MARKERS.role_close + _MARKERS.turn_close)}) as formatted_chars
  from turns group by conv_id)
select conv_id, n_turns, sha256(lines) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
  cast(formatted_chars as bigint) as formatted_chars
from folded
"""

URL_RULES = [
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
]


@query
def op3_url_filter(spark, folder):
    """Every page URL judged by rule or by the two character models."""
    return urls.filter_urls(table(spark, folder, "pages"), URL_RULES)


@query
def op7_suffix_dedup(spark, folder):
    """Every document without the bytes of repeated passages of 200 bytes and more."""
    return suffixes.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query
def op10_exact_dedup(spark, folder):
    """Groups of equal whole texts by radix partitioning."""
    return exact.exact_groups(table(spark, folder, "documents"))


ORACLES["op10_exact_dedup"] = r"""
with texts as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = min(doc_id) over same as kept, sha256(t) as text_sha256
from texts window same as (partition by t)
"""


@query
def op4_ngram_join(spark, folder):
    """Every document with its near-duplicate class and number of links."""
    return jaccard.similar_texts(table(spark, folder, "documents"))


@query
def op5_packing(spark, folder):
    """All documents as token pieces dealt to windows of 4096."""
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


def fold(docs: DataFrame, modulus: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus))


@query
def op9_lm_scoring(spark, folder):
    """Every text under a Kneser-Ney model of six sevenths of the documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = kneser.train(docs.filter(F.coalesce(fold(docs, 7) != 2, F.lit(True))))
    return kneser.score(docs, model).select(
        "doc_id", F.coalesce(fold(docs, 7) == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity",
    )


@query
def op6_language_id(spark, folder):
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, folder, "documents")
    model = langid.train(docs.filter(F.coalesce(fold(docs, 3) != 1, F.lit(True))).select("text", "lang"))
    predicted = langid.predict(docs, model)
    return predicted.withColumn("held_out", F.coalesce(fold(predicted, 3) == 1, F.lit(False)))


def toxicity_model(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    learned = F.coalesce(fold(labels, 4) != 2, F.lit(True))
    return toxicity.train(docs, labels.filter(learned))


@query
def op8_toxicity(spark, folder):
    """The toxicity score of every document."""
    scored = toxicity.score(table(spark, folder, "documents"), toxicity_model(spark, folder))
    return scored.select(
        "doc_id", F.coalesce(fold(scored, 4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "flagged",
    )


@query
def op11_source_divergence(spark, folder):
    """The divergence between the sources of every language, and the terms that set each source apart."""
    return divergence.divergence(table(spark, folder, "documents"))


_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
ORACLES["op11_source_divergence"] = f"""
with texts as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents
), grps as (select distinct lang, source from texts
), words as (
  select id, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) as term from texts
), kept as (select lang, term, count(*) as n from words group by lang, term having count(distinct id) >= {divergence.DivergenceSettings().documents}
), size as (select lang, count(*) as v, sum(n) as total from kept group by lang
), counted as (select lang, source, term, count(*) as n from words semi join kept using (lang, term) group by all
), total as (select lang, source, sum(n) as total from counted group by all
), cells as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + cast({divergence.SCALE} as hugeint) * (coalesce(c.n, 0) + 1) // (coalesce(t.total, 0) + s.v) as p,
    1 + cast({divergence.SCALE} as hugeint) * (k.n + 1) // (s.total + s.v) as q
  from grps g join kept k using (lang) join size s using (lang)
  left join total t using (lang, source) left join counted c using (lang, source, term)
), pairs as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from cells a join cells b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), every as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(p.value, 0) as bigint) as value
  from grps a join grps b on a.lang = b.lang and a.source <> b.source
  left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all
  select lang, source, 'term', term, cast((p - q) * (p - q) // q as bigint) from cells where n > 0 and p > q
), ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from every)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= {divergence.DivergenceSettings().ranks}
"""


@query
def op12_html_extraction(spark, folder):
    """The main text of every page."""
    return pages.extract_pages(table(spark, folder, "pages"))


def planted_tails(ids: list, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and period of the tail that a document with a checksum divisible by ten repeats; no id, no tail."""
    checksum = np.array([0xFFFFFFFF if i is None else zlib.crc32(str(i).encode()) for i in ids], np.int64)
    chosen = (checksum % 10 == 0) & (n > 0) & np.array([i is not None for i in ids], bool)
    g = checksum // 10
    first = np.where(chosen, g % np.maximum(n, 1), 0)
    return first, np.where(chosen, 1 + (n - first) // (3 + g % 8), 0)


@query
def op13_periodic_runs(spark, folder):
    """The periodic runs of every document, some of which get a periodic tail first."""
    found = runs.find_runs(table(spark, folder, "documents"), rewrite=planted_tails)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, F.concat(r.period.cast("string"), F.lit("\n"))))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"), F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
