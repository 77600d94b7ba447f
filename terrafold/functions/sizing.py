"""Cluster-count and quota rules as column expressions over group sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrafold import defaults as D


def _int_div(a: Column, b) -> Column:
    return F.floor(a / b).cast("long")


def k_upper_bound(
    n: Column,
    max_clusters: int = D.MAX_CLUSTERS,
    min_rows_per_cluster: int = D.MIN_SAMPLES_PER_CLUSTER,
) -> Column:
    """Largest cluster count to try for a group of n rows."""
    room = _int_div(n, F.lit(min_rows_per_cluster))
    wished = F.when(
        n > D.LARGE_GROUP,
        F.greatest(F.lit(max_clusters).cast("long"), _int_div(n, F.lit(D.TARGET_CLUSTER_ROWS))),
    ).otherwise(F.lit(max_clusters).cast("long"))
    return F.least(wished, room)


def k_large_adjust(n: Column, k: Column, upper: Column) -> Column:
    """Raise the count for large groups whose clusters would be oversized."""
    mean_rows = n / k
    raised = F.least(k + _int_div(mean_rows, F.lit(D.SPLIT_CLUSTER_ROWS)), upper)
    return F.when(
        (n > D.LARGE_GROUP) & (mean_rows > D.OVERSIZED_CLUSTER_ROWS), raised
    ).otherwise(k)


def proportional_k(n: Column, sample_size: int) -> Column:
    """Clusters used by cluster-proportional sampling; below 2 means plain random sampling."""
    large = F.greatest(
        F.lit(D.SAMPLING_MIN_CLUSTERS_LARGE).cast("long"),
        F.least(
            F.lit(sample_size // D.SAMPLE_ROWS_PER_CLUSTER).cast("long"),
            _int_div(n, F.lit(D.TARGET_CLUSTER_ROWS)),
        ),
    )
    small = F.least(F.lit(min(sample_size, D.SAMPLING_MAX_CLUSTERS)).cast("long"), n)
    return F.when(n > D.LARGE_GROUP, large).otherwise(small)


def single_cluster_k(n: Column, sample_size: int) -> Column:
    """Clusters used by single-cluster sampling; below 2 means plain random sampling."""
    return F.least(
        F.lit(D.SAMPLING_MAX_CLUSTERS).cast("long"), _int_div(n, F.lit(max(1, sample_size // 2)))
    )


def cluster_quota(cluster_rows: Column, group_rows: Column, sample_size: int) -> Column:
    """Rows to draw from one cluster: its share of the sample, at least one, at most all."""
    share = F.floor(F.lit(sample_size) * (cluster_rows / group_rows)).cast("long")
    return F.least(F.greatest(F.lit(1).cast("long"), share), cluster_rows)
