"""The full analysis: locate, count, cluster, sample, summarise, validate."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold import defaults as D
from terrafold import schemas
from terrafold.operators import clustering, quality, reports, runlog, spatial, statistics, tables
from terrafold.operators.clustering import ClusterSettings
from terrafold.operators.kmeans import KeyedKMeans, clusters_frame
from terrafold.session import cut_lineage
from terrafold.sources.countries import boundary_rings


@dataclass(frozen=True)
class AnalysisSettings:
    sampling_method: str = "random"
    sample_size: int = D.SAMPLE_SIZE
    min_samples_per_country: int = D.MIN_SAMPLES_PER_COUNTRY
    seed: int = D.SEED
    grid: float = D.GRID_DEGREES
    clustering: ClusterSettings = field(default_factory=ClusterSettings)


@dataclass
class Analysis:
    """All outcome frames of a run."""

    samples: DataFrame
    countries: DataFrame
    clusters: DataFrame
    results: DataFrame
    coverage: DataFrame
    imbalance: DataFrame
    clustering_coverage: DataFrame
    summary: DataFrame
    validation: DataFrame
    counts: DataFrame


@dataclass
class ClusterReports:
    stats: DataFrame
    details: DataFrame
    soc: DataFrame
    variability: DataFrame
    headline: DataFrame
    extent: DataFrame
    labels: DataFrame


def locate_samples(samples: DataFrame, countries: DataFrame, grid: float = D.GRID_DEGREES) -> DataFrame:
    """Samples with ``country_id``, from countries with stored outlines."""
    usable = spatial.valid_boundaries(countries)
    outlines = usable.select(F.col("id").alias("country_id"), boundary_rings("boundary").alias("rings"))
    return spatial.assign_polygons(samples, outlines, grid)


def country_overview(samples: DataFrame, boundaries: DataFrame, countries: DataFrame) -> DataFrame:
    """Count, mean and variance per country, straight from points and outlines."""
    located = spatial.assign_polygons(samples, boundaries)
    return statistics.country_full_stats(countries, located)


def run_analysis(
    samples: DataFrame, countries: DataFrame, settings: AnalysisSettings | None = None
) -> Analysis:
    """Run every stage over a samples and a countries table.

    The located samples are written once to the shared folder because clustering, sampling and the
    reports all read them.
    """
    settings = settings or AnalysisSettings()
    located = cut_lineage(locate_samples(samples, countries, settings.grid))
    counted = spatial.refresh_sample_counts(countries, located)
    smallest = settings.clustering.min_rows_per_cluster
    # One set of location blocks and draws serves the clusters and the samples drawn from clusters.
    with KeyedKMeans(located, settings=settings.clustering.kmeans) as engine:
        models = clustering.choose_models(located, settings.clustering, engine=engine)
        found = clusters_frame(located.sparkSession, models, smallest)
        clusters = tables.surrogate_ids(
            clustering.store_clusters(found), ["country_id", "cluster_number"]
        )
        placed = clustering.place_samples(located, models, clusters, smallest)
        results = cut_lineage(
            statistics.country_statistics(
                located, counted, settings.sampling_method, settings.sample_size,
                settings.min_samples_per_country, settings.seed, settings.clustering.kmeans, engine,
            )
        )
    return Analysis(
        samples=placed,
        countries=counted,
        clusters=clusters,
        results=results,
        coverage=spatial.association_coverage(located, counted),
        imbalance=quality.data_imbalance(located, counted),
        clustering_coverage=clustering.clustering_coverage(clusters, located),
        summary=statistics.overall_summary(results),
        validation=statistics.validate_results(results),
        counts=tables.table_counts(located, counted, results),
    )


def persist_run(run: Analysis, folder: str, run_id: str) -> None:
    """Write the tables of a run below ``folder`` and append its results and one log row per stage.

    Samples, countries and clusters are those of the latest run; results and the log of all runs stay.
    """
    spark = run.samples.sparkSession
    latest = {
        "soil_samples": (run.samples, schemas.SAMPLES),
        "countries": (run.countries, schemas.COUNTRIES),
        "clusters": (run.clusters, schemas.CLUSTERS),
    }
    entries = []
    for name, (rows, schema) in latest.items():
        began = time.monotonic()
        held = cut_lineage(tables.with_row_defaults(rows, schema))
        held.write.mode("overwrite").parquet(f"{folder}/{name}")
        entries.append((name, began, held.count()))
    began = time.monotonic()
    stored = statistics.store_results(run.results, f"{folder}/analysis_results")
    entries.append(("analysis_results", began, stored.count()))
    for name, began, n in entries:
        spent = int((time.monotonic() - began) * 1000)
        row = runlog.log_row(spark, run_id, name, "INFO", f"{n} rows written", spent, n)
        runlog.append_run_log(row, f"{folder}/pipeline_logs")


def cluster_reports(clusters: DataFrame, countries: DataFrame, samples: DataFrame) -> ClusterReports:
    """All reporting frames over stored clusters."""
    stats = reports.cluster_stats_by_country(clusters, countries)
    details = reports.cluster_details(clusters, countries)
    soc = reports.cluster_soc(clusters, countries, samples)
    return ClusterReports(
        stats=stats,
        details=details,
        soc=soc,
        variability=reports.soc_variability(soc),
        headline=reports.cluster_report(stats, details, soc),
        extent=reports.map_extent(clusters),
        labels=reports.label_positions(clusters, countries),
    )
