"""Sampling per country: uniform, proportional to clusters, from one cluster.

Draws follow the seeded digest order of the sample ids, so they do not depend on partitioning.
"""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold import defaults as D
from terrafold.functions.measurement import once
from terrafold.functions.sizing import cluster_quota, proportional_k, single_cluster_k
from terrafold.operators.kmeans import (
    KeyedKMeans, KMeansSettings, Model, clusters_frame, model_labels,
)
from terrafold.operators.ranking import KEY, draw_key, random_rank
from terrafold.session import lookup_side

METHODS = ("random", "clustering", "single_cluster")


def random_sample(
    samples: DataFrame, sample_size: int = D.SAMPLE_SIZE, seed: int = D.SEED,
    group_col: str = "country_id",
) -> DataFrame:
    """Up to ``sample_size`` rows per country, uniformly without replacement."""
    return random_rank(samples, [group_col], sample_size, seed).drop("_rank")


def _fit_by_rule(
    samples: DataFrame, rule, sample_size: int, settings: KMeansSettings, engine: KeyedKMeans | None = None
) -> list[Model]:
    """Models with the cluster count a size rule gives; countries below 2 clusters have none."""
    with nullcontext(engine) if engine else KeyedKMeans(samples, settings=settings) as engine:
        profiles = engine.profiles()
        if not profiles:
            return []
        keys = list(profiles)
        sizes = engine.spark.createDataFrame(
            [(i, p.n) for i, p in enumerate(profiles.values())], "i int, n long"
        )
        counts = sizes.select("i", rule(F.col("n"), sample_size).alias("k")).where("k >= 2").collect()
        return engine.fit([(keys[r.i], r.k) for r in counts], profiles)


def quotas(clusters: DataFrame, sample_size: int) -> DataFrame:
    """(country_id, cluster_number, quota, short): draws per cluster and rows still missing."""
    country = Window.partitionBy("country_id")
    return (
        clusters.withColumn("_rows", F.sum("sample_count").over(country))
        .withColumn("quota", cluster_quota(F.col("sample_count"), F.col("_rows"), sample_size))
        .withColumn("short", F.greatest(F.lit(sample_size) - F.sum("quota").over(country), F.lit(0)))
        .select("country_id", "cluster_number", "quota", "short")
    )


def draw_proportional(
    labelled: DataFrame, clusters: DataFrame, sample_size: int, seed: int = D.SEED
) -> DataFrame:
    """Draw each cluster's quota, then fill a short country from its remaining rows.

    One pass ranks the rows inside their clusters. Quota and shortfall are each at most the sample
    size, so rows ranked beyond twice that size cannot be drawn and are cut before the shuffle.
    ``clusters`` must be as small as a fitted set of centres.
    """
    ranked = random_rank(labelled, ["country_id", "cluster_number"], 2 * sample_size, seed)
    planned = ranked.join(
        lookup_side(quotas(clusters, sample_size)), ["country_id", "cluster_number"]
    )
    spare = Window.partitionBy("country_id", "_spare").orderBy(KEY, "id")
    return (
        planned.where("_rank <= quota + short")
        .withColumn("_spare", F.col("_rank") > F.col("quota"))
        .withColumn(KEY, draw_key("id", seed))
        .withColumn("_place", F.row_number().over(spare))
        .where("not _spare or _place <= short")
        .drop(KEY, "_rank", "_spare", "_place", "quota", "short")
    )


def cluster_sample(
    samples: DataFrame, sample_size: int = D.SAMPLE_SIZE, seed: int = D.SEED,
    settings: KMeansSettings | None = None, engine: KeyedKMeans | None = None,
) -> DataFrame:
    """Rows drawn from every cluster in proportion to its size.

    The floor of one row per cluster may push a country above ``sample_size``. Countries too small
    to cluster are sampled at random.
    """
    models = _fit_by_rule(samples, proportional_k, sample_size, settings or KMeansSettings(seed=seed), engine)
    return _proportional_from(samples, models, sample_size, seed)


def _proportional_from(samples, models, sample_size, seed) -> DataFrame:
    spark = samples.sparkSession
    labelled = samples.withColumn("cluster_number", once(model_labels(spark, models)))
    drawn = draw_proportional(
        labelled.where("cluster_number is not null"), clusters_frame(spark, models, 1),
        sample_size, seed,
    )
    return drawn.drop("cluster_number").unionByName(
        _plain_rest(samples, models, sample_size, seed)
    )


def _plain_rest(samples, models, sample_size, seed) -> DataFrame:
    """Random sample of the countries that have no model."""
    modelled = samples.sparkSession.createDataFrame([(m.group,) for m in models], "country_id long")
    others = samples.join(lookup_side(modelled), "country_id", "left_anti").select(*samples.columns)
    return random_sample(others, sample_size, seed)


def pick_cluster(clusters: DataFrame, sample_size: int, seed: int = D.SEED) -> DataFrame:
    """(country_id, cluster_number): a random cluster among those large enough, else the largest."""
    ticket = F.md5(F.concat_ws(":", F.lit(str(seed)), "country_id", "cluster_number"))
    fits = F.col("sample_count") >= sample_size
    best = clusters.groupBy("country_id").agg(
        F.min(F.when(fits, F.struct(ticket.alias("ticket"), "cluster_number"))).alias("_drawn"),
        F.max(
            F.struct("sample_count", (-F.col("cluster_number")).alias("minus_number"))
        ).alias("_largest"),
    )
    number = F.coalesce(F.col("_drawn.cluster_number"), -F.col("_largest.minus_number"))
    return best.select("country_id", number.alias("cluster_number"))


def draw_single(
    labelled: DataFrame, clusters: DataFrame, sample_size: int, seed: int = D.SEED
) -> DataFrame:
    """Random rows of one picked cluster per country; ``clusters`` as in draw_proportional."""
    chosen = labelled.join(
        lookup_side(pick_cluster(clusters, sample_size, seed)), ["country_id", "cluster_number"]
    )
    return random_rank(chosen, ["country_id"], sample_size, seed).drop("_rank")


def single_cluster_sample(
    samples: DataFrame, sample_size: int = D.SAMPLE_SIZE, seed: int = D.SEED,
    settings: KMeansSettings | None = None, engine: KeyedKMeans | None = None,
) -> DataFrame:
    """Rows of one cluster per country; countries too small to cluster are sampled at random."""
    models = _fit_by_rule(
        samples, single_cluster_k, sample_size, settings or KMeansSettings(seed=seed), engine
    )
    spark = samples.sparkSession
    labelled = samples.withColumn("cluster_number", once(model_labels(spark, models)))
    drawn = draw_single(
        labelled.where("cluster_number is not null"), clusters_frame(spark, models, 1),
        sample_size, seed,
    )
    return drawn.select(*samples.columns).unionByName(
        _plain_rest(samples, models, sample_size, seed)
    )


def draw_samples(
    samples: DataFrame, method: str = "random", sample_size: int = D.SAMPLE_SIZE,
    seed: int = D.SEED, settings: KMeansSettings | None = None, engine: KeyedKMeans | None = None,
) -> DataFrame:
    """Rows by one of the three methods. An ``engine`` with these settings over the same groups' rows may be handed in."""
    if method == "random":
        return random_sample(samples, sample_size, seed)
    if method == "clustering":
        return cluster_sample(samples, sample_size, seed, settings, engine)
    if method == "single_cluster":
        return single_cluster_sample(samples, sample_size, seed, settings, engine)
    raise ValueError(f"unknown sampling method: {method}")


def restrict_to_sample(samples: DataFrame, sampled_ids: DataFrame) -> DataFrame:
    return samples.join(sampled_ids.select("id"), "id", "left_semi")


def remaining_samples(samples: DataFrame, sampled_ids: DataFrame) -> DataFrame:
    return samples.join(sampled_ids.select("id"), "id", "left_anti")
