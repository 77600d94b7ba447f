"""Small tables with every awkward row, and brute-force versions of the operators."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(rng.integers(0, len(WORDS), n), rng.integers(0, 40, n)))


def awkward_rows() -> list[tuple]:
    """(doc_id, text, lang): nulls, empty and blank texts, one word, a very long text, copies, near copies, ties."""
    base, near = prose(1, 120), prose(1, 120).split()
    near[60] = "changed"
    return [
        (1, base, "en"), (2, base, "en"), (3, base.replace(" ", "  \n", 5), None), (4, " ".join(near), "en"),
        (5, None, "de"), (6, "", "de"), (7, " \t\n", "fr"), (8, "word", "en"), (9, "word", "en"), (10, "Été — ÑANDÚ 日本語", "fr"),
        (None, prose(2, 30), None), (None, None, None), (11, prose(3, 40_000), "en"), (12, "a" * 700, "en"),
        (13, "\\ [INST] </s> <|im_end|> \x00 {}", "en"), (14, prose(4, 60), "es"), (14, prose(5, 60), "es"),
        (15, prose(6, 80), "en"), (15, prose(6, 80), "en"),
    ]


CLASHING = [
    "id", "uid", "grp", "rest", "head", "n", "row", "keeper", "node", "tree", "label", "rep", "batch", "piece", "ids", "length",
    "start", "rid", "spans", "shard", "body", "low", "toxic", "use", "score", "url_", "count", "bucket", "item_id", "held_out",
]


def frame(spark: SparkSession, rows: list[tuple] | None = None, schema: str = "doc_id long, text string, lang string",
          clash: bool = True) -> DataFrame:
    df = spark.createDataFrame(awkward_rows() if rows is None else rows, schema)
    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns}) if clash else df


def collected(df: DataFrame) -> pd.DataFrame:
    return df.toArrow().to_pandas()


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())
