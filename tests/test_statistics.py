import math
import statistics as st

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.operators import quality, reports
from terrafold.operators import statistics as S

SAMPLES = "id long, country_id long, latitude double, longitude double, soc_percent double, clay_fraction double"
RESULTS = ("country_id long, country_name string, country_code string, sample_size long, "
           "soc_mean double, soc_variance double, clay_fraction_mean double")


def test_sample_statistics(spark):
    nan = float("nan")
    rows = [(1, 1, 0.0, 0.0, 2.0, .1), (2, 1, 0.0, 0.0, 4.0, .3), (3, 1, 0.0, 0.0, None, None),
            (4, 1, 0.0, 0.0, nan, nan), (5, 2, 0.0, 0.0, 7.0, .2), (6, 3, 0.0, 0.0, None, None)]
    got = {r.country_id: r for r in S.sample_statistics(spark.createDataFrame(rows, SAMPLES)).collect()}
    assert (got[1].sample_size, got[1].soc_mean, got[1].soc_variance) == (4, 3.0, 2.0)
    assert got[1].clay_fraction_mean == pytest.approx(0.2)
    assert (got[2].soc_mean, got[2].soc_variance) == (7.0, 0.0)
    assert (got[3].soc_mean, got[3].soc_variance, got[3].clay_fraction_mean) == (0.0, 0.0, 0.0)


def test_population_variance(spark):
    rows = [(i, 1, 0.0, 0.0, v, .1) for i, v in enumerate([1.0, 2.0, 6.0])]
    got = S.sql_sample_statistics(spark.createDataFrame(rows, SAMPLES)).first()
    assert got.soc_variance == pytest.approx(st.pvariance([1, 2, 6]))


def test_country_statistics_thresholds(spark):
    rows = [(i, 1, 0.0, 0.0, float(i), .1) for i in range(15)]
    rows += [(100 + i, 2, 0.0, 0.0, 1.0, .1) for i in range(9)]
    rows += [(200 + i, 3, 0.0, 0.0, 1.0, .1) for i in range(20)] + [(300, None, 0.0, 0.0, 1.0, .1)]
    countries = spark.createDataFrame([(1, "A", "AA"), (2, "B", "BB")], "id long, name string, iso_code string")
    got = S.country_statistics(spark.createDataFrame(rows, SAMPLES), countries, sample_size=12).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.country_name, row.country_code, row.total_samples, row.sample_size) == ("A", "AA", 15, 12)


def test_full_stats_keep_empty_countries(spark):
    rows = [(1, 1, 0.0, 0.0, 2.0, .1)]
    countries = spark.createDataFrame([(1, "A"), (2, "B")], "id long, name string")
    got = {r.country_id: r for r in
           S.country_full_stats(countries, spark.createDataFrame(rows, SAMPLES)).collect()}
    assert (got[1].total_samples, got[1].soc_variance) == (1, None)
    assert (got[2].total_samples, got[2].soc_mean) == (0, None)


def _results(spark, *rows):
    return spark.createDataFrame(list(rows), RESULTS)


def test_overall_summary(spark):
    got = S.overall_summary(_results(
        spark, (1, "A", "AA", 1, 2.0, 0.0, .1), (2, "B", "BB", 3, 6.0, 1.0, .3))).first()
    assert (got.total_countries, got.total_samples_analyzed) == (2, 4)
    assert (got.overall_soc_mean, got.overall_soc_variance) == (5.0, 3.0)
    assert got.overall_soc_variance == np.var([2.0, 6.0, 6.0, 6.0])
    assert got.overall_clay_fraction_mean == pytest.approx(0.25)
    assert [c.country_code for c in got.country_summary] == ["AA", "BB"]


def test_overall_summary_of_nothing(spark):
    got = S.overall_summary(spark.createDataFrame([], RESULTS)).first()
    assert (got.total_countries, got.total_samples_analyzed, got.overall_soc_mean) == (0, 0, 0.0)
    assert (got.overall_soc_variance, got.country_summary) == (0.0, [])
    one = S.overall_summary(_results(spark, (1, "A", "AA", 1, 2.0, 0.0, .1))).first()
    assert one.overall_soc_variance == 0.0


def test_validation(spark):
    results = _results(
        spark, (1, "A", "AA", 0, 1.0, 0.0, .1), (2, "B", "BB", 9, 51.0, 0.0, 1.5),
        (3, "C", "CC", 10, -0.5, 0.0, -.1), (4, "D", "DD", 100, 50.0, 0.0, 1.0))
    got = S.validate_results(results).first()
    assert tuple(got) == (4, 1, 1, 2, 2)
    texts = {(r.country_id, r.rule): r.warning for r in S.result_warnings(results).collect()}
    assert texts[(1, "zero_samples")] == "Country A has zero samples"
    assert texts[(2, "low_samples")] == "Country B has only 9 samples"
    assert texts[(2, "anomalous_soc")] == "Country B has anomalous SOC mean: 51.000%"
    assert texts[(3, "anomalous_clay")] == "Country C has anomalous clay fraction: -0.100"
    assert len(texts) == 6


# --- quality ----------------------------------------------------------------


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [3.0, 1.0, 2.0], [1.0] * 50 + [2.0], list(range(101)),
    [float(i * i % 977) for i in range(30_000)], [1e300] + [float(i % 7) for i in range(25_000)],
])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    shares = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = {r.share: r.value for r in quality.exact_quantiles(df, ["v"], shares).collect()}
    want = np.quantile(np.array(values, dtype=float), shares)
    assert [got[s] for s in shares] == pytest.approx(list(want))


def test_quantile_brackets_are_narrowed(spark, monkeypatch):
    monkeypatch.setattr(quality, "MAX_RANKED", 200)
    values = [float((i * 7919) % 30_011) for i in range(30_000)] + [5.0] * 4000
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    shares = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)
    got = {r.share: r.value for r in quality.exact_quantiles(df, ["v"], shares, 100).collect()}
    assert [got[s] for s in shares] == pytest.approx(list(np.quantile(np.array(values), shares)))


def test_describe_and_missing(spark):
    rows = [(1.0, None), (2.0, 5.0), (float("nan"), None), (4.0, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = {r.column_name: r for r in quality.describe_columns(df, ("a", "b")).collect()}
    assert (got["a"].n, got["a"].q50, got["a"].max) == (3, 2.0, 4.0)
    assert (got["b"].n, got["b"].std, got["b"].q25) == (1, None, 5.0)
    assert {r.column_name: r.n_missing for r in quality.missing_counts(df).collect()} == {"a": 1, "b": 3}


QUALITY = ("latitude double, longitude double, soc_percent double, top_depth_cm int, bottom_depth_cm int, "
           "sampling_date string, lab_analysis_date string")


def test_quality_score_and_ranges(spark):
    good = (50.0, 10.0, 3.0, 0, 20, "2001-05-01", "2001")
    bad = (95.0, 10.0, 120.0, 0, 2000, "1999-12-31", None)
    report = quality.quality_report(spark.createDataFrame([good, bad], QUALITY)).first()
    assert report.quality_score == 80 and len(report.issues) == 2
    assert (report.sampling_date_min, report.lab_date_max) == ("1999-12-31", "2001")
    rules = {r.rule for r in quality.validate_ranges(spark.createDataFrame([good, bad], QUALITY)).collect()}
    assert rules == {"missing_values", "latitude_range", "soc_range", "depth_range"}
    clean = spark.createDataFrame([good], QUALITY)
    assert quality.quality_report(clean).first().quality_score == 100
    assert quality.validate_ranges(clean).count() == 0


def test_imbalance(spark):
    df = spark.createDataFrame([(i, 1 if i < 6 else 2) for i in range(9)] + [(9, None)],
                               "id long, country_id long")
    countries = spark.createDataFrame([(1, "A"), (2, "B")], "id long, name string")
    got = [(r.country_name, r.n_samples, r.percentage, r.dominant)
           for r in quality.data_imbalance(df, countries).collect()]
    assert got == [("A", 6, 60.0, True), ("B", 3, 30.0, False)]
    assert quality.top_country(df).first().country_id == 1


# --- reports ----------------------------------------------------------------


def test_cluster_reports(spark):
    clusters = spark.createDataFrame(
        [(1, 1, 1, 50.0, 10.0, 300), (2, 1, 2, 52.0, 14.0, 100), (3, 2, 1, 40.0, 0.0, 6)],
        "id long, country_id long, cluster_number long, center_latitude double, "
        "center_longitude double, sample_count long")
    countries = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "id long, name string")
    samples = spark.createDataFrame(
        [(1, 1, 1, 2.0), (2, 1, 1, 4.0), (3, 1, 2, 9.0), (4, 2, 3, 5.0), (5, 2, 1, 5.0), (6, 1, None, 1.0)],
        "id long, country_id long, cluster_id long, soc_percent double")
    soc = reports.cluster_soc(clusters, countries, samples)
    assert [tuple(r) for r in soc.collect()] == [("A", 1, 2, 3.0), ("A", 2, 1, 9.0), ("B", 1, 1, 5.0)]
    stats = reports.cluster_stats_by_country(clusters, countries)
    assert [tuple(r) for r in stats.collect()] == [("A", 2, 200.0, 400, 100, 300), ("B", 1, 6.0, 6, 6, 6)]
    head = reports.cluster_report(stats, reports.cluster_details(clusters, countries), soc).first()
    assert (head.most_clusters, head.largest_avg_cluster, head.most_samples) == ("A", "A", "A")
    assert (head.large_cluster_countries, head.small_cluster_countries) == ("A", "B")
    assert head.cluster_size_cv == pytest.approx(st.stdev([200, 6]) / 103)
    assert (head.distinct_regions, head.soc_measurements, head.max_soc) == (3, 3, 9.0)
    spread = {r.country_name: r for r in reports.soc_variability(soc).collect()}
    assert spread["A"].std_soc == round(math.sqrt(18), 3) and spread["B"].std_soc is None
    extent = reports.map_extent(clusters).first()
    assert tuple(extent) == (-3.0, 17.0, 37.0, 55.0)
    labels = {r.country_name: r.label_longitude for r in
              reports.label_positions(clusters, countries).collect()}
    assert labels == {"A": 12.0, "B": 0.0}
    assert stats.where(F.col("country_name") == "C").count() == 0
