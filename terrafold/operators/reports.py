"""Reporting queries over clusters, countries and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold import defaults as D


def _named(clusters: DataFrame, countries: DataFrame) -> DataFrame:
    names = countries.select(F.col("id").alias("country_id"), F.col("name").alias("country_name"))
    return clusters.join(names, "country_id")


def cluster_details(clusters: DataFrame, countries: DataFrame) -> DataFrame:
    return (
        _named(clusters, countries)
        .select(
            "country_name", "cluster_number", "center_latitude", "center_longitude", "sample_count"
        )
        .orderBy("country_name", "cluster_number")
    )


def cluster_soc(clusters: DataFrame, countries: DataFrame, samples: DataFrame) -> DataFrame:
    """Members and mean carbon per cluster.

    The samples are reduced to one row per (country, cluster) before they meet the two dimensions.
    """
    per_cluster = samples.where("country_id is not null and cluster_id is not null").groupBy(
        "country_id", "cluster_id"
    ).agg(F.count("id").alias("actual_samples"), F.avg("soc_percent").alias("avg_soc"))
    keys = _named(clusters, countries).withColumnRenamed("id", "cluster_id")
    return (
        keys.join(per_cluster, ["country_id", "cluster_id"])
        .select("country_name", "cluster_number", "actual_samples", "avg_soc")
        .orderBy("country_name", "cluster_number")
    )


def cluster_stats_by_country(clusters: DataFrame, countries: DataFrame) -> DataFrame:
    return (
        _named(clusters, countries)
        .groupBy("country_name")
        .agg(
            F.count(F.lit(1)).alias("cluster_count"),
            F.avg("sample_count").alias("avg_samples_per_cluster"),
            F.sum("sample_count").alias("total_samples"),
            F.min("sample_count").alias("min_cluster_size"),
            F.max("sample_count").alias("max_cluster_size"),
        )
        .orderBy(F.desc("cluster_count"), "country_name")
    )


def soc_variability(soc_by_cluster: DataFrame) -> DataFrame:
    """Mean and deviation of the cluster means per country, rounded to 3 places."""
    return soc_by_cluster.groupBy("country_name").agg(
        F.round(F.avg("avg_soc"), 3).alias("mean_soc"),
        F.round(F.stddev_samp("avg_soc"), 3).alias("std_soc"),
        F.sum("actual_samples").alias("total_samples"),
    )


def _holder(measure: str):
    """Country with the largest value; the first name on ties."""
    return F.min(
        F.struct((-F.col(measure)).alias("minus_value"), F.col("country_name"))
    )["country_name"]


def cluster_report(
    stats: DataFrame, details: DataFrame, soc_by_cluster: DataFrame
) -> DataFrame:
    """One row of headline figures over the three reporting frames."""
    mean_size = F.col("avg_samples_per_cluster")
    named = F.col("country_name")
    regions = details.agg(F.count(F.lit(1)).alias("n"))
    soc = soc_by_cluster.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.avg("avg_soc").alias("mean"),
            F.min("avg_soc").alias("low"), F.max("avg_soc").alias("high"),
        ).alias("s")
    )
    headline = stats.agg(
        F.count(F.lit(1)).alias("total_countries"),
        F.sum("cluster_count").alias("total_clusters"),
        F.sum("total_samples").alias("total_samples"),
        F.avg("cluster_count").alias("avg_clusters_per_country"),
        F.avg(mean_size).alias("avg_samples_per_cluster"),
        _holder("cluster_count").alias("most_clusters"),
        _holder("avg_samples_per_cluster").alias("largest_avg_cluster"),
        _holder("total_samples").alias("most_samples"),
        (F.stddev_samp(mean_size) / F.avg(mean_size)).alias("cluster_size_cv"),
        F.array_join(
            F.sort_array(F.collect_list(F.when(mean_size > D.LARGE_MEAN_CLUSTER, named))), ", "
        ).alias("large_cluster_countries"),
        F.array_join(
            F.sort_array(F.collect_list(F.when(mean_size < D.SMALL_MEAN_CLUSTER, named))), ", "
        ).alias("small_cluster_countries"),
    )
    return (
        headline.withColumn("distinct_regions", regions.scalar())
        .withColumn("_soc", soc.scalar())
        .withColumn("soc_measurements", F.col("_soc.n"))
        .withColumn("mean_soc", F.col("_soc.mean"))
        .withColumn("min_soc", F.col("_soc.low"))
        .withColumn("max_soc", F.col("_soc.high"))
        .drop("_soc")
    )


def map_extent(clusters: DataFrame) -> DataFrame:
    """One row: bounds of the cluster centres with a margin."""
    m = D.MAP_MARGIN_DEGREES
    return clusters.agg(
        (F.min("center_longitude") - m).alias("lon_min"),
        (F.max("center_longitude") + m).alias("lon_max"),
        (F.min("center_latitude") - m).alias("lat_min"),
        (F.max("center_latitude") + m).alias("lat_max"),
    )


def label_positions(clusters: DataFrame, countries: DataFrame) -> DataFrame:
    """Mean centre of each country's clusters."""
    return _named(clusters, countries).groupBy("country_name").agg(
        F.avg("center_longitude").alias("label_longitude"),
        F.avg("center_latitude").alias("label_latitude"),
    )
