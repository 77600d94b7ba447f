"""First rows per group under a total order, without sending a whole group to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.functions.measurement import sample_key
from terrafold.session import lookup_side

KEY = "_key"
PREFIX_DIGITS = 4  # 65,536 buckets of the digest


def first_by(df: DataFrame, group_cols: list[str], order: list, n: int, rank_col: str) -> DataFrame:
    """Rows ranked 1..n per group.

    Spark turns this filter into partial group limits, so every input partition sends at most n rows
    per group over the network, provided n does not exceed windowGroupLimitThreshold.
    """
    window = Window.partitionBy(*group_cols).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(window).cast("long"))
    return ranked.where(F.col(rank_col) <= n)


def group_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def draw_key(id_col: str, seed):
    """The seeded digest of an id; a null id is behind every digest."""
    return F.coalesce(sample_key(id_col, seed), F.lit("z"))


def random_rank(
    df: DataFrame, group_cols: list[str], n: int, seed, id_col: str = "id", rank_col: str = "_rank"
) -> DataFrame:
    """The n rows of each group that come first in the seeded digest order.

    Up to the group-limit threshold a ranked filter is enough. For larger n the rows are cut first:
    counting rows per digest prefix gives, for each group, the prefix that holds the n-th row; rows
    beyond it are dropped before anything is ranked. Both ways give the same rows. Rows without an
    id come last.
    """
    keyed = df.where(F.col(group_cols[0]).isNotNull()).withColumn(KEY, draw_key(id_col, seed))
    if n > group_limit(df):
        keyed = _cut_after_prefix(keyed, group_cols, n)
    return first_by(keyed, group_cols, [KEY, id_col], n, rank_col).drop(KEY)


def _cut_after_prefix(keyed: DataFrame, group_cols: list[str], n: int) -> DataFrame:
    prefix = F.substring(KEY, 1, PREFIX_DIGITS)
    per_prefix = keyed.groupBy(*group_cols, prefix.alias("_prefix")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    before = (
        Window.partitionBy(*group_cols).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    )
    last = (
        per_prefix.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .where(F.col("_before") < n)
        .groupBy(*group_cols)
        .agg(F.max("_prefix").alias("_last"))
    )
    return keyed.join(lookup_side(last), group_cols).where(prefix <= F.col("_last")).drop("_last")
