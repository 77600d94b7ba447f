import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terrafold.operators import ranking, sampling
from terrafold.operators.kmeans import KMeansSettings


def _key(i, seed=42):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i


def _frame(spark, sizes, parts=3, seed=9):
    rng = random.Random(seed)
    rows, i = [], 0
    for g, n in sizes.items():
        for _ in range(n):
            rows.append((i, g, rng.uniform(40, 60), rng.uniform(0, 20)))
            i += 1
    schema = "id long, country_id long, latitude double, longitude double"
    return spark.createDataFrame(rows, schema).repartition(parts)


@pytest.mark.parametrize("parts", [1, 6])
def test_random_sample_is_first_by_digest(spark, parts):
    df = _frame(spark, {1: 300, 2: 5, None: 4}, parts)
    got = {}
    for r in sampling.random_sample(df, 20).collect():
        got.setdefault(r.country_id, set()).add(r.id)
    ids = {}
    for r in df.collect():
        ids.setdefault(r.country_id, []).append(r.id)
    assert set(got) == {1, 2} and len(got[2]) == 5
    assert got[1] == set(sorted(ids[1], key=_key)[:20])
    other = {r.id for r in sampling.random_sample(df, 20, seed=7).collect() if r.country_id == 1}
    assert other != got[1]


def test_prefix_cut_equals_plain_ranking(spark, monkeypatch):
    df = _frame(spark, {1: 3000, 2: 150, 3: 7})
    for n in (1, 40, 149, 150, 2999, 5000):
        monkeypatch.setattr(ranking, "group_limit", lambda _: 0)
        cut = {(r.id, r._rank) for r in ranking.random_rank(df, ["country_id"], n, 42).collect()}
        monkeypatch.setattr(ranking, "group_limit", lambda _: 10**9)
        plain = {(r.id, r._rank) for r in ranking.random_rank(df, ["country_id"], n, 42).collect()}
        assert cut == plain


def test_ranking_is_pruned_before_the_shuffle(spark):
    df = _frame(spark, {1: 50}).select("id", "country_id")
    plan = sampling.random_sample(df, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def _labelled(spark, sizes):
    rows, i = [], 0
    for (g, c), n in sizes.items():
        for _ in range(n):
            rows.append((i, g, c))
            i += 1
    df = spark.createDataFrame(rows, "id long, country_id long, cluster_number long").repartition(4)
    return df, df.groupBy("country_id", "cluster_number").agg(F.count(F.lit(1)).alias("sample_count"))


def test_proportional_draw_may_exceed_the_size(spark):
    df, clusters = _labelled(spark, {(1, 1): 950, (1, 2): 45, (1, 3): 4, (1, 4): 1})
    drawn = Counter(r.cluster_number for r in sampling.draw_proportional(df, clusters, 100).collect())
    assert drawn == {1: 95, 2: 4, 3: 1, 4: 1}


def _plain_proportional(rows, size):
    by_cluster = {}
    for r in rows:
        by_cluster.setdefault(r.cluster_number, []).append(r.id)
    taken = []
    for ids in by_cluster.values():
        quota = min(max(1, int(size * (len(ids) / len(rows)))), len(ids))
        taken += sorted(ids, key=_key)[:quota]
    rest = sorted((r.id for r in rows if r.id not in set(taken)), key=_key)
    return set(taken) | set(rest[:max(0, size - len(taken))])


@pytest.mark.parametrize("size", [10, 37, 100, 1000])
def test_proportional_draw_against_brute_force(spark, size):
    rng = random.Random(size)
    sizes = {(g, c): rng.randint(1, 90) for g in (1, 2, 3) for c in range(1, 8)}
    df, clusters = _labelled(spark, sizes)
    got = {}
    for r in sampling.draw_proportional(df, clusters, size).collect():
        got.setdefault(r.country_id, []).append(r.id)
    for g in (1, 2, 3):
        rows = [r for r in df.collect() if r.country_id == g]
        assert len(got[g]) == len(set(got[g]))
        assert set(got[g]) == _plain_proportional(rows, size)


def test_single_draw_prefers_large_enough_clusters(spark):
    df, clusters = _labelled(spark, {
        (1, 1): 30, (1, 2): 50, (1, 3): 5, (2, 1): 7, (2, 2): 9, (2, 3): 9})
    picked = {r.country_id: r.cluster_number for r in sampling.pick_cluster(clusters, 20).collect()}
    assert picked[1] in (1, 2) and picked[2] == 2
    drawn = Counter((r.country_id, r.cluster_number)
                    for r in sampling.draw_single(df, clusters, 20).collect())
    assert drawn == {(1, picked[1]): 20, (2, 2): 9}
    seen = {sampling.pick_cluster(clusters, 20, seed).where("country_id = 1").first().cluster_number
            for seed in range(12)}
    assert seen == {1, 2}


@pytest.mark.parametrize("method", sampling.METHODS)
def test_methods_are_reproducible(spark, method):
    settings = KMeansSettings(restarts=2)
    sizes = {1: 1200, 2: 80, 3: 1}
    one, two = (
        {r.id for r in sampling.draw_samples(_frame(spark, sizes, p), method, 30, 42, settings).collect()}
        for p in (1, 5))
    assert one == two
    counted = Counter(
        r.country_id for r in
        sampling.draw_samples(_frame(spark, sizes), method, 30, 42, settings).collect())
    assert counted[3] == 1
    assert counted[2] >= 30 if method == "clustering" else counted[2] <= 30


def test_unknown_method(spark):
    with pytest.raises(ValueError, match="unknown sampling method"):
        sampling.draw_samples(_frame(spark, {1: 3}), "best")


def test_sample_and_rest_partition_the_rows(spark):
    df = _frame(spark, {1: 60, 2: 10})
    drawn = sampling.random_sample(df, 15)
    inside = {r.id for r in sampling.restrict_to_sample(df, drawn).collect()}
    outside = {r.id for r in sampling.remaining_samples(df, drawn).collect()}
    assert len(inside) == 25 and len(outside) == 45 and not inside & outside
