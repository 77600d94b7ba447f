"""The corpus pipeline: each stage reads what the last one wrote.

toxicity     rows whose toxicity score reaches the threshold of their language go
exact_dedup  of equal texts the row with the smallest id stays
near_dedup   of each class of similar texts the row with the smallest id stays
decontaminate  texts that hold a benchmark item within its edit budget go
packing      token pieces of what is left, dealt to windows of 4096
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrafold.llm import catalog, decontaminate, exact, jaccard, packing, toxicity
from terrafold.llm.store import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, catalog.toxicity_model(spark, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact_copies(docs)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_similar(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, catalog.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, catalog.tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_similar),
    ("decontaminate", drop_contaminated),
    ("packing", pack),
]

#: Stages of models and tokenizers have no SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of the documents that all filters keep.

    Every filter decides on rows, not ids: namesakes with other texts are judged on their own, rows without an id like
    all others. Null texts count as empty; empty and blank texts are kept (one of each group of copies). Of rows that
    repeat id and text one is left after exact_dedup. An empty table gives no rows, and columns whose names the
    operators use themselves pass through.
    """
    docs = catalog.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
