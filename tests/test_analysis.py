import pytest

from checks import inputs
from terrafold.operators.clustering import ClusterSettings
from terrafold.operators.kmeans import KMeansSettings
from terrafold.operators.tables import surrogate_ids
from terrafold import schemas
from terrafold.plans.analysis import AnalysisSettings, cluster_reports, persist_run, run_analysis
from terrafold.sources.samples import load_into


@pytest.mark.parametrize("method", ["random", "clustering", "single_cluster"])
def test_whole_run(spark, folder, method, tmp_path):
    loaded = load_into(None, inputs.raw_samples(spark, folder), ["line"])
    numbered = surrogate_ids(loaded, ["raw_data_id"])
    settings = AnalysisSettings(
        sampling_method=method, clustering=ClusterSettings(kmeans=KMeansSettings(restarts=2)))
    run = run_analysis(numbered, inputs.countries(spark), settings)
    total = numbered.count()
    assert run.samples.count() == total
    located = {r.country_id: r["count"] for r in run.samples.groupBy("country_id").count().collect()}
    results = {r.country_id: r for r in run.results.collect()}
    assert set(results) == {c for c, n in located.items() if c is not None and n >= 10}
    for c, r in results.items():
        assert r.total_samples == located[c] and r.sampling_method == method
        if method != "clustering":
            assert r.sample_size <= 100
    clusters = {(r.country_id, r.id): r.sample_count for r in run.clusters.collect()}
    held = {(r.country_id, r.cluster_id): r["count"] for r in
            run.samples.where("cluster_id is not null").groupBy("country_id", "cluster_id").count().collect()}
    assert held == clusters and min(clusters.values()) >= 5
    coverage = run.coverage.first()
    assert coverage.total_samples == total and coverage.unassigned_samples == located[None]
    counts = run.counts.first()
    assert (counts.soil_samples, counts.countries, counts.analysis_results) == (total, 9, len(results))
    assert run.clustering_coverage.first().total_samples_clustered == sum(clusters.values())
    assert run.summary.first().total_countries == len(results) == run.validation.first().total_results
    reports = cluster_reports(run.clusters, run.countries, run.samples)
    assert reports.headline.first().distinct_regions == len(clusters) == reports.soc.count()
    if method == "random":
        for _ in range(2):
            persist_run(run, str(tmp_path), "r1")
        stored = spark.read.parquet(f"{tmp_path}/analysis_results")
        assert sorted(r.id for r in stored.collect()) == list(range(1, 2 * len(results) + 1))
        assert stored.schema.names == schemas.RESULTS.names and stored.where("analysis_date is null").isEmpty()
        assert spark.read.parquet(f"{tmp_path}/soil_samples").count() == total
        assert spark.read.parquet(f"{tmp_path}/pipeline_logs").count() == 8
