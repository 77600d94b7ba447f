"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_KEYS     comma-separated subset of the keys, for work on single queries
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import catalog, inputs  # noqa: E402
from terrafold.operators.tables import surrogate_ids  # noqa: E402
from terrafold.plans.analysis import AnalysisSettings, cluster_reports, run_analysis  # noqa: E402
from terrafold.session import local_session  # noqa: E402
from terrafold.sources import samples as sample_source  # noqa: E402

KEYS = [
    "load_samples", "upsert_samples", "surrogate_ids", "required_columns_check", "validate_ranges",
    "quality_report", "describe_column", "points_in_polygons", "points_in_concave_polygons",
    "refresh_sample_counts", "country_full_stats", "association_coverage", "random_sample",
    "random_sample_large", "country_statistics", "overall_summary", "grouped_kmeans", "kmeans_inertia_curve",
    "cluster_country_samples", "points_in_polygons_shuffled",
    "cluster_sample", "single_cluster_sample", "cluster_report", "stage_performance",
]


def whole_run(spark, folder, method):
    """Load, locate, cluster, sample, summarise, validate and report, with every frame computed."""
    raw = inputs.raw_samples(spark, folder)
    loaded = sample_source.load_into(None, raw, ["line"])
    numbered = surrogate_ids(loaded, ["raw_data_id"])
    outcome = run_analysis(
        numbered, inputs.countries(spark), AnalysisSettings(sampling_method=method)
    )
    reports = cluster_reports(outcome.clusters, outcome.countries, outcome.samples)
    for frame in (
        outcome.results, outcome.coverage, outcome.imbalance, outcome.clustering_coverage,
        outcome.summary, outcome.validation, outcome.counts, reports.details, reports.variability,
        reports.headline,
    ):
        force(frame)


def force(frame):
    """Compute every row and column without collecting."""
    frame.write.format("noop").mode("overwrite").save()


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    wanted = os.environ.get("BENCH_KEYS")
    timed = {key: (lambda k=key: force(catalog.QUERIES[k](spark, folder))) for key in KEYS}
    timed["whole_run_random"] = lambda: whole_run(spark, folder, "random")
    timed["whole_run_clustering"] = lambda: whole_run(spark, folder, "clustering")
    if wanted:
        timed = {k: v for k, v in timed.items() if k in wanted.split(",")}
    force(inputs.located(spark, folder))  # start the workers before the clock
    spent = {}
    for key, run in timed.items():
        began = time.time()
        run()
        spent[key] = round(time.time() - began, 3)
        print(key, spent[key], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(spent.values()), 3), "unit": "sec",
        "queries": spent, "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
