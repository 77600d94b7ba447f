"""Per-country statistics over drawn samples, their summary and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold import defaults as D
from terrafold import schemas
from terrafold.operators.kmeans import KeyedKMeans, KMeansSettings
from terrafold.operators.sampling import draw_samples
from terrafold.operators.tables import (
    result_rows, stored_table_exists, surrogate_ids, with_row_defaults,
)
from terrafold.session import cut_lineage


def _present(name: str) -> Column:
    """Value with NaN read as missing."""
    return F.nanvl(F.col(name), F.lit(None).cast("double"))


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0.0))


def sample_statistics(sampled: DataFrame) -> DataFrame:
    """Mean and sample variance of carbon and mean of clay per country."""
    return sampled.where("country_id is not null").groupBy("country_id").agg(
        F.count(F.lit(1)).alias("sample_size"),
        _or_zero(F.avg(_present("soc_percent"))).alias("soc_mean"),
        _or_zero(F.var_samp(_present("soc_percent"))).alias("soc_variance"),
        _or_zero(F.avg(_present("clay_fraction"))).alias("clay_fraction_mean"),
    )


def sql_sample_statistics(sampled: DataFrame) -> DataFrame:
    """The same figures with population variance."""
    return sampled.where("country_id is not null").groupBy("country_id").agg(
        _or_zero(F.avg("soc_percent")).alias("soc_mean"),
        _or_zero(F.var_pop("soc_percent")).alias("soc_variance"),
        _or_zero(F.avg("clay_fraction")).alias("clay_fraction_mean"),
    )


def country_statistics(
    samples: DataFrame,
    countries: DataFrame,
    method: str = "random",
    sample_size: int = D.SAMPLE_SIZE,
    min_samples: int = D.MIN_SAMPLES_PER_COUNTRY,
    seed: int = D.SEED,
    settings: KMeansSettings | None = None,
    engine: KeyedKMeans | None = None,
) -> DataFrame:
    """One result row per known country with at least ``min_samples`` samples.

    Country totals come from their own narrow count, so the threshold and the names are joined to
    one row per country and the samples themselves are never joined.
    """
    columns = ["id", "country_id", "latitude", "longitude", "soc_percent", "clay_fraction"]
    held = samples.select(*columns).where("country_id is not null")
    totals = (
        held.groupBy("country_id")
        .agg(F.count(F.lit(1)).alias("total_samples"))
        .where(F.col("total_samples") >= min_samples)
    )
    figures = sample_statistics(draw_samples(held, method, sample_size, seed, settings, engine))
    names = countries.select(
        F.col("id").alias("country_id"), F.col("name").alias("country_name"),
        F.col("iso_code").alias("country_code"),
    )
    return (
        figures.join(totals, "country_id")
        .join(names, "country_id")
        .select(
            "country_id", "country_name", "country_code", F.lit(method).alias("sampling_method"),
            "total_samples", "sample_size", "soc_mean", "soc_variance", "clay_fraction_mean",
        )
    )


def country_full_stats(countries: DataFrame, samples: DataFrame) -> DataFrame:
    """Figures over all samples of every country, empty countries included.

    The samples are reduced to one row per country before the join.
    """
    per_country = samples.where("country_id is not null").groupBy("country_id").agg(
        F.count("id").alias("_n"),
        F.avg("soc_percent").alias("soc_mean"),
        F.var_samp("soc_percent").alias("soc_variance"),
        F.avg("clay_fraction").alias("clay_fraction_mean"),
    )
    return countries.join(per_country, countries["id"] == per_country["country_id"], "left").select(
        countries["id"].alias("country_id"),
        "name",
        F.coalesce("_n", F.lit(0)).alias("total_samples"),
        "soc_mean",
        "soc_variance",
        "clay_fraction_mean",
    )


def overall_summary(results: DataFrame) -> DataFrame:
    """One row over all result rows, with the per-country list as an array.

    The variance is that of the country means weighted by sample size; the spread inside a country
    does not enter it (also given as ``between_country_variance``).
    """
    size = F.col("sample_size")
    total = F.coalesce(F.sum("sample_size"), F.lit(0))

    def weighted(column: Column) -> Column:
        return _or_zero(F.try_divide(F.sum(column * size), F.sum(size)))

    mean = results.agg(weighted(F.col("soc_mean")).alias("m"))
    spread = (F.col("soc_mean") - mean.scalar()) * (F.col("soc_mean") - mean.scalar())
    listed = F.struct(
        "country_code", "country_name", "sample_size", "soc_mean", "soc_variance",
        "clay_fraction_mean",
    )
    return results.agg(
        F.count(F.lit(1)).alias("total_countries"),
        total.alias("total_samples_analyzed"),
        weighted(F.col("soc_mean")).alias("overall_soc_mean"),
        F.when(total > 1, weighted(spread)).otherwise(F.lit(0.0)).alias("overall_soc_variance"),
        weighted(F.col("clay_fraction_mean")).alias("overall_clay_fraction_mean"),
        F.sort_array(F.collect_list(listed)).alias("country_summary"),
    ).withColumn("between_country_variance", F.col("overall_soc_variance"))


def result_warnings(results: DataFrame) -> DataFrame:
    """One row per failed rule of a result row: (country_id, rule, warning)."""
    name = F.col("country_name")
    size, soc, clay = F.col("sample_size"), F.col("soc_mean"), F.col("clay_fraction_mean")

    def finding(condition: Column, rule: str, text: Column) -> Column:
        return F.when(condition, F.struct(F.lit(rule).alias("rule"), text.alias("warning")))

    findings = F.array(
        finding(size == 0, "zero_samples", F.format_string(D.RESULT_WARNINGS["zero_samples"], name)),
        finding(
            (size != 0) & (size < D.LOW_SAMPLE_COUNT),
            "low_samples",
            F.format_string(D.RESULT_WARNINGS["low_samples"], name, size),
        ),
        finding(
            (soc > D.SOC_MEAN_LIMIT) | (soc < 0),
            "anomalous_soc",
            F.format_string(D.RESULT_WARNINGS["anomalous_soc"], name, soc),
        ),
        finding(
            (clay > D.CLAY_MEAN_LIMIT) | (clay < 0),
            "anomalous_clay",
            F.format_string(D.RESULT_WARNINGS["anomalous_clay"], name, clay),
        ),
    )
    return results.select(
        "country_id", F.explode(F.filter(findings, lambda f: f.isNotNull())).alias("f")
    ).select("country_id", "f.rule", "f.warning")


def validate_results(results: DataFrame) -> DataFrame:
    """One row of counters over all result rows."""
    size, soc, clay = F.col("sample_size"), F.col("soc_mean"), F.col("clay_fraction_mean")
    return results.agg(
        F.count(F.lit(1)).alias("total_results"),
        F.count_if(size == 0).alias("countries_with_zero_samples"),
        F.count_if((size != 0) & (size < D.LOW_SAMPLE_COUNT)).alias("countries_with_low_samples"),
        F.count_if((soc > D.SOC_MEAN_LIMIT) | (soc < 0)).alias("anomalous_soc_values"),
        F.count_if((clay > D.CLAY_MEAN_LIMIT) | (clay < 0)).alias("anomalous_clay_values"),
    )


def results_by_country(results: DataFrame, countries: DataFrame) -> DataFrame:
    names = countries.select(F.col("id").alias("country_id"), F.col("name").alias("country_name"))
    return (
        results.join(names, "country_id")
        .select(
            "country_name", "sampling_method", "soc_mean", "soc_variance", "clay_fraction_mean"
        )
        .orderBy(F.desc("soc_mean"), "country_name")
    )


def store_results(results: DataFrame, path: str | None = None) -> DataFrame:
    """Result rows as stored, with id and analysis date; appended to ``path`` when given, ids behind those there."""
    start: int | DataFrame = 0
    if path is not None and stored_table_exists(results.sparkSession, path):
        start = results.sparkSession.read.schema(schemas.RESULTS).parquet(path).agg(F.max("id").alias("m"))
    numbered = surrogate_ids(result_rows(results), ["country_id", "sampling_method"], start)
    rows = cut_lineage(with_row_defaults(numbered, schemas.RESULTS))
    if path is not None:
        rows.write.mode("append").parquet(path)
    return rows
