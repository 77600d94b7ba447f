"""Exact duplicates by distributed most-significant-digit radix partitioning.

Texts are split into ever smaller groups by their successive bytes. A digit is a run of bytes, and each round's
digits are longer than the last one's, so the number of rounds grows with the logarithm of the longest copy.
A group leaves as soon as it has one member or its texts have ended; only members of open groups carry the
rest of their text into the next round. Equality is decided by the bytes themselves.

A round has two steps. The digits are counted per group with map-side sums, so a digit that a third of all
rows share costs each task one row; only digits that occur twice go on. The members then look their
digit up by a left merge join of two written tables, whose large partitions adaptive execution splits on
the members' side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.store import written

SPACES = "[\\x20\\x09-\\x0D]+"


def normalised(text):
    """Runs of white space become one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    first_digit: int = 64, growth: int = 16, longest_digit: int = 1 << 20,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Rows are equal when their texts are identical after ``normalised``; null counts as empty, so null, empty
    and missing texts are one group. Of equal rows the one with the smallest id stays; null ids come last.
    Rows that repeat an id are separate members of their group, and exactly one row of a group is kept. An empty
    table gives an empty result. Other columns are ignored whatever their names.
    """
    return _groups(_numbered(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))),
                   first_digit, growth, longest_digit).select(
        F.col("id").alias(id_column), F.col("keeper.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("keeper.uid") == F.col("uid")).alias("kept"), "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without later copies, all columns kept."""
    rows = written(docs.select(F.monotonically_increasing_id().alias("__uid"), F.struct(*docs.columns).alias("row")),
                   "exact-input")
    keyed = rows.select(
        F.col("__uid").alias("uid"), F.col(f"row.{id_column}").alias("id"),
        normalised(F.col(f"row.{text_column}")).alias("text"),
    )
    keyed = keyed.select("uid", "id", F.lit("").alias("text_sha256"), F.encode("text", "UTF-8").alias("rest"))
    groups = _groups(keyed, 64, 16, 1 << 20)
    later = groups.filter(F.col("keeper.uid") != F.col("uid")).select(F.col("uid").alias("__uid"))
    return rows.join(later, "__uid", "left_anti").select("row.*")


def _numbered(docs: DataFrame) -> DataFrame:
    """Normalised rows with a number of their own, written once so that the numbers stay."""
    text = docs.select("id", normalised(F.col("text")).alias("text"))
    return written(text.select(
        F.monotonically_increasing_id().alias("uid"), "id", F.sha2("text", 256).alias("text_sha256"),
        F.encode("text", "UTF-8").alias("rest"),
    ), "exact-rows")


def _groups(state: DataFrame, digit: int, growth: int, longest: int) -> DataFrame:
    """uid, id, text_sha256, n, keeper (struct of id and uid) for every row."""
    state = state.select("uid", "id", "text_sha256", F.lit(0).cast("long").alias("grp"), "rest")
    done = []
    while True:
        head = F.substring("rest", 1, digit)
        counted = (
            state.groupBy("grp", head.alias("head"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.isnull("id").alias("none"), "id", "uid")).alias("keeper"))
            .filter("n > 1")
        )
        repeated = written(counted, "exact-digits")
        open_ = F.col("n").isNotNull() & (F.octet_length("head") == digit)
        own = F.struct(F.isnull("id").alias("none"), F.col("id").alias("id"), F.col("uid").alias("uid"))
        joined = state.withColumn("head", head).join(repeated.hint("merge"), ["grp", "head"], "left").select(
            "uid", "id", "text_sha256",
            F.coalesce("n", F.lit(1)).alias("n"), F.coalesce("keeper", own).alias("keeper"),
            F.when(open_, F.expr(f"substring(rest, {digit + 1})")).alias("rest"),
        )
        split = written(joined, "exact-split")
        done.append(split.filter(F.isnull("rest")).drop("rest"))
        state = split.filter(F.isnotnull("rest")).select(
            "uid", "id", "text_sha256", F.col("keeper.uid").alias("grp"), "rest"
        )
        if state.isEmpty():
            break
        digit = min(digit * growth, longest)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out
