import hashlib
import math
import random
import time

import numpy as np
import pytest

from terrafold.operators import clustering, kmeans
from terrafold.operators.kmeans import KeyedKMeans, KMeansSettings


def _rows(sizes, seed=3, repeats=0):
    rng = random.Random(seed)
    rows, i = [], 0
    for group, n in sizes.items():
        for _ in range(n):
            rows.append((i, group, round(rng.gauss(50, 3), 3), round(rng.gauss(10, 5), 3)))
            i += 1
    for _ in range(repeats):
        rows.append((i, 1, 48.0, 9.0))
        i += 1
    return rows


def _frame(spark, rows, parts=3):
    return spark.createDataFrame(
        rows, "id long, country_id long, latitude double, longitude double").repartition(parts)


def _drawn(own, restart, k):
    """The first k distance-weighted draws among the distinct locations of (id, lat, lon) rows, one by one."""
    count = {}
    for _, la, lo in own:
        count[la, lo] = count.get((la, lo), 0) + 1
    wait = {}
    for la, lo in count:
        digest = hashlib.md5(f"42:{math.floor(la * 1e6)}:{math.floor(lo * 1e6)}".encode()).hexdigest()
        bits = (int(digest[:13], 16) + restart * int(digest[13:26], 16)) % 2**52
        wait[la, lo] = -math.log((bits + 0.5) / 2**52)
    drawn = []
    while len(drawn) < min(k, len(count)):
        near = {x: min(((x[0] - a) ** 2 + (x[1] - b) ** 2 for a, b in drawn), default=1.0) for x in count}
        drawn.append(min((wait[x] / (count[x] * near[x]), x) for x in count if near[x] > 0)[1])
    return drawn


def _plain_fit(rows, group, k, restarts, max_iter=300, tolerance=1e-4):
    """Straightforward Lloyd iterations for one group; (inertia, sorted centres)."""
    own = [(i, la, lo) for i, g, la, lo in rows if g == group]
    x = np.array([(la, lo) for _, la, lo in own])
    limit = tolerance * x.var(axis=0).mean()
    best = None
    for r in range(restarts):
        c = np.round(np.array(_drawn(own, r, k)), 9)
        for _ in range(max_iter):
            d = ((x[:, None] - c) ** 2).sum(axis=2)
            j, far = d.argmin(axis=1), sorted({(-v, *p) for v, p in zip(d.min(axis=1), map(tuple, x))})
            new, sent = c.copy(), 0
            for m in range(len(c)):
                if (j == m).any():
                    new[m] = np.round(x[j == m].mean(axis=0), 9)
                else:
                    new[m], sent = np.round(far[sent][1:], 9), sent + 1
            shift = ((new - c) ** 2).sum()
            c = new
            if shift <= limit:
                break
        inertia = round(((x[:, None] - c) ** 2).sum(axis=2).min(axis=1).sum(), 6)
        if best is None or inertia < best[0]:
            best = (inertia, c[np.lexsort((c[:, 1], c[:, 0]))])
    return best


@pytest.mark.parametrize("max_centers", [1, 10, 200_000])
def test_fit_equals_plain_iterations(spark, max_centers):
    rows = _rows({1: 150, 2: 60}, repeats=80)
    settings = KMeansSettings(restarts=3, max_centers=max_centers)
    with KeyedKMeans(_frame(spark, rows), settings=settings) as engine:
        profiles = engine.profiles()
        models = engine.fit([(1, 4), (1, 7), (2, 3)], profiles)
    assert profiles[1].n == 230 and profiles[1].locations <= 151
    for model in models:
        inertia, centers = _plain_fit(rows, model.group, model.k, 3)
        assert model.inertia == pytest.approx(inertia, abs=2e-6)
        assert np.allclose(np.column_stack([model.latitude, model.longitude]), centers, atol=1e-8)
        assert model.rows.sum() == sum(1 for r in rows if r[1] == model.group)


def test_result_does_not_depend_on_partitions_or_batches(spark):
    rows = _rows({1: 120, 2: 90})
    specs = [(1, 3), (2, 5), (1, 6)]
    found = []
    for parts, settings in (
        (1, KMeansSettings(restarts=2)),
        (9, KMeansSettings(restarts=2, max_centers=12)),
        (5, KMeansSettings(restarts=2, max_centers=1)),
    ):
        with KeyedKMeans(_frame(spark, rows, parts), settings=settings) as engine:
            models = engine.fit(specs, engine.profiles())
        found.append([(m.group, m.k, m.restart, m.inertia, m.latitude.tolist()) for m in models])
    assert found[0] == found[1] == found[2]


def test_shuffled_sums_equal_direct_sums(spark, monkeypatch):
    rows = _rows({1: 80})
    settings = KMeansSettings(restarts=2)
    with KeyedKMeans(_frame(spark, rows), settings=settings) as engine:
        profiles = engine.profiles()
        direct = engine.fit([(1, 4)], profiles)[0]
        monkeypatch.setattr(kmeans, "MAX_PARTIAL_ROWS", 0)
        shuffled = engine.fit([(1, 4)], profiles)[0]
    assert direct.latitude.tolist() == shuffled.latitude.tolist()
    assert direct.inertia == shuffled.inertia


@pytest.mark.parametrize("keys, block", [(64, 256), (1, 7), (3, 1)])
def test_draws_equal_draws_one_by_one(spark, monkeypatch, keys, block):
    monkeypatch.setattr(kmeans, "DRAWN_KEYS", keys)
    monkeypatch.setattr(kmeans, "BLOCK_POINTS", block)
    rows = _rows({1: 400, 2: 6}, repeats=50) + [(999, 3, 1.0, 1.0)] * 5
    with KeyedKMeans(_frame(spark, rows), settings=KMeansSettings(restarts=2)) as engine:
        asked = {(1, 0): 20, (1, 1): 3, (2, 0): 9, (3, 1): 4}
        found = engine._seeds(asked)
        more = engine._seeds({(1, 1): 12})
    for (g, r), depth in {**asked, (1, 1): 12}.items():
        own = [(i, la, lo) for i, group, la, lo in rows if group == g]
        got = more[1, 1] if (g, r) == (1, 1) else found[g, r]
        assert list(zip(*got))[:depth] == _drawn(own, r, depth)


def test_ids_do_not_matter(spark):
    """Null ids, one id for all rows, and any number of partitions give one result."""
    rows = _rows({1: 300, 2: 40}, repeats=30)
    found = []
    for parts, ids in ((3, lambda i: i), (7, lambda i: 5), (1, lambda i: None), (5, lambda i: None if i % 9 else i)):
        frame = _frame(spark, [(ids(i), *rest) for i, *rest in rows], parts)
        models, labelled = kmeans.grouped_kmeans(frame, [(1, 6), (2, 3)], KMeansSettings(restarts=3))
        found.append([(m.group, m.inertia, m.latitude.tolist(), m.rows.tolist()) for m in models])
        assert labelled.count() == len(rows)
    assert found[0] == found[1] == found[2] == found[3]


def _plus_plus(x, k, restarts, seed=0):
    """Least inertia of Lloyd iterations from plain k-means++ draws."""
    rng, best = np.random.default_rng(seed), np.inf
    for _ in range(restarts):
        c = x[rng.integers(len(x))][None]
        while len(c) < k:
            d = ((x[:, None] - c) ** 2).sum(axis=2).min(axis=1)
            c = np.vstack([c, x[rng.choice(len(x), p=d / d.sum())]])
        for _ in range(100):
            j = ((x[:, None] - c) ** 2).sum(axis=2).argmin(axis=1)
            c = np.array([x[j == m].mean(axis=0) if (j == m).any() else c[m] for m in range(k)])
        best = min(best, ((x[:, None] - c) ** 2).sum(axis=2).min(axis=1).sum())
    return best


@pytest.mark.parametrize("k", [10, 20])
def test_towns_of_unequal_size_get_their_centres(spark, k):
    rng = np.random.default_rng(4)
    towns = rng.uniform(0, 60, (20, 2))
    x = np.concatenate([rng.normal(t, 0.15, (int(n), 2)) for t, n in zip(towns, np.geomspace(600, 6, 20))]).round(4)
    frame = _frame(spark, [(i, 1, float(a), float(b)) for i, (a, b) in enumerate(x)])
    with KeyedKMeans(frame) as engine:
        model, = engine.fit([(1, k)], engine.profiles())
    assert model.inertia <= 1.1 * _plus_plus(x, k, 10)


def test_a_centre_without_members_moves_to_the_farthest_location(spark):
    rows = [(i, 1, float(i % 10), 0.0) for i in range(100)] + [(200, 1, 50.0, 0.0), (201, 1, 51.0, 0.0), (202, 1, 80.0, 0.0)]
    with KeyedKMeans(_frame(spark, rows)) as engine:
        start = {1: [(7, np.array([4.0, 900.0, 901.0]), np.array([0.0, 0.0, 0.0]))]}
        far = kmeans.farthest_locations(engine.blocks, start, {7: 2}, spark)
        batch = kmeans._Batch([1], np.array([3]), np.array([0]), start[1][0][1].copy(), start[1][0][2].copy())
        sums = kmeans._settle(engine.blocks, batch, np.array([0.0]), 50, 2)
    assert far[7].tolist() == [[80.0, 0.0], [51.0, 0.0]]
    assert sorted(batch.lat.round(6)) == [4.5, 50.5, 80.0] and sums["w"].sum() == 103


def test_a_task_moves_a_centre_without_members_to_the_farthest_location():
    lat, w = np.array([*map(float, range(10)), 50.0, 51.0, 80.0]), np.array([10.0] * 10 + [1.0] * 3)
    places = kmeans._Places(lat, np.zeros(13), w, 42)
    places.starts = lambda restart, depth: (np.array([4.0, 900.0, 901.0]), np.zeros(3))
    got, _, sums = places.settled(0, 3, 0.0, 50)
    assert sorted(got.round(6)) == [4.5, 50.5, 80.0] and sums[0].sum() == 103 and sums[3].sum() == pytest.approx(825.5)


def test_models_of_one_task_equal_models_of_all_tasks(spark):
    """Groups below, at and above the bound; many equal distances; more centres than a block has points."""
    rng = np.random.default_rng(6)
    rows = _rows({1: 700, 2: 40, 3: 1}, repeats=60)
    rows += [(i, 4, float(a), float(b)) for i, (a, b) in enumerate(rng.integers(0, 9, (400, 2)))]
    specs, found = [(1, 3), (2, 5), (1, 90), (3, 1), (4, 6), (4, 200)], []
    for bound in (0, 81, 500_000):
        settings = KMeansSettings(restarts=2, max_centers=150, near_locations=bound)
        with KeyedKMeans(_frame(spark, rows), settings=settings) as engine:
            profiles = engine.profiles()
            models, curve = engine.fit(specs, profiles), engine.curve(specs, profiles)
        assert [(m.group, m.k, m.inertia) for m in models] == curve
        found.append([(m.group, m.k, m.restart, m.inertia, m.latitude.tolist(), m.longitude.tolist(), m.rows.tolist()) for m in models])
    assert profiles[4].locations <= 81 < profiles[1].locations
    assert found[0] == found[1] == found[2]


def test_jobs_of_a_pass_do_not_follow_its_iterations(spark):
    rows, group = _rows({1: 900, 2: 300}), "jobs of a fit"
    with KeyedKMeans(_frame(spark, rows), settings=KMeansSettings(restarts=4, max_centers=20)) as engine:
        profiles = engine.profiles()
        spark.sparkContext.setJobGroup(group, group)
        engine.curve([(1, 5), (2, 5)], profiles)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setJobGroup("other", "other")
    assert 2 <= jobs <= 12  # two passes


def test_blocks_find_the_nearest_centre(spark):
    rng = np.random.default_rng(2)
    for n, k in ((500, 3), (3000, 60), (2000, 400)):
        lat, lon = rng.integers(0, 40, n) / 2, rng.integers(0, 40, n) / 2  # many ties
        clat, clon = rng.integers(0, 40, k) / 2, rng.integers(0, 40, k) / 2
        d = (lat[:, None] - clat) ** 2 + (lon[:, None] - clon) ** 2
        index, best = kmeans.nearest(lat, lon, clat, clon)
        assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
        rows = [(i, 1, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))]
        with KeyedKMeans(_frame(spark, rows)) as engine:
            for cost in (True, False):
                got = kmeans.center_sums(engine.blocks, {1: [(0, clat, clon), (5, clat[:1], clon[:1])]}, spark, 4, with_cost=cost)
                one = got[got.model == 0].set_index("j")
                assert one.w.to_dict() == {j: float(c) for j, c in enumerate(np.bincount(d.argmin(axis=1), minlength=k)) if c}
                assert got[got.model == 5].w.tolist() == [float(n)]
            assert not cost or one.s_dist.sum() == pytest.approx(d.min(axis=1).sum())


def test_a_location_with_most_rows_leaves_no_centre_empty(spark):
    rows = [(i, 1, 50.0, 10.0) for i in range(960)] + [(1000 + i, 1, 40.0 + i % 8, float(i // 8)) for i in range(40)]
    with KeyedKMeans(_frame(spark, rows), settings=KMeansSettings(restarts=3)) as engine:
        five, many = engine.fit([(1, 5), (1, 100)], engine.profiles())
    assert (five.rows > 0).all() and len(five.rows) == 5 and five.rows.sum() == 1000
    assert len(many.rows) == 41 and many.inertia == 0


def test_rows_without_coordinates_are_left_out(spark):
    nan = float("nan")
    rows = _rows({1: 200}) + [(900, 1, nan, 1.0), (901, 1, 1.0, nan), (902, 1, None, 1.0), (903, None, 1.0, 1.0)]
    models, labelled = kmeans.grouped_kmeans(_frame(spark, rows), [(1, 3)], KMeansSettings(restarts=2))
    assert models[0].rows.sum() == 200 and np.isfinite(models[0].inertia)
    assert labelled.where("id >= 900").count() == 0


def test_many_groups(spark):
    rows = [(3 * g + j, g, float(g % 90), float(j)) for g in range(20_000) for j in range(3)]
    began = time.time()
    models, labelled = kmeans.grouped_kmeans(
        _frame(spark, rows), [(g, 2) for g in range(20_000)], KMeansSettings(restarts=1, max_iter=3))
    assert len(models) == 20_000 and labelled.count() == 60_000
    assert time.time() - began < 240


def test_labels_are_nearest_centres(spark):
    rows = _rows({1: 100, 2: 40, 3: 1})
    models, labelled = kmeans.grouped_kmeans(
        _frame(spark, rows), [(1, 4), (2, 2), (3, 2)], KMeansSettings(restarts=2))
    assert {m.group for m in models} == {1, 2}
    centers = {m.group: np.column_stack([m.latitude, m.longitude]) for m in models}
    got = labelled.collect()
    assert len(got) == 140
    for r in got:
        d = ((centers[r.country_id] - (r.latitude, r.longitude)) ** 2).sum(axis=1)
        assert r.cluster_number == d.argmin() + 1


def test_single_steps(spark, monkeypatch):
    rows = [(1, 1, 0.0, 0.0), (2, 1, 0.0, 2.0), (3, 1, 0.0, 9.0), (4, 2, 0.0, 0.0)]
    centers = spark.createDataFrame(
        [(1, 1, 0.0, 0.0), (1, 2, 0.0, 4.0)],
        "country_id long, cluster_number long, center_latitude double, center_longitude double")
    step = kmeans.kmeans_assign(_frame(spark, rows), centers)
    assert {r.id: r.cluster_number for r in step.collect()} == {1: 1, 2: 1, 3: 2, 4: None}
    monkeypatch.setattr(kmeans, "STEP_CENTERS", 1)
    again = kmeans.kmeans_assign(_frame(spark, rows), centers)
    assert {r.id: r.cluster_number for r in again.collect()} == {1: 1, 2: 1, 3: 2, 4: None}
    new = {r.cluster_number: (r.center_longitude, r.sample_count)
           for r in kmeans.kmeans_update(step).collect()}
    assert new == {1: (1.0, 2), 2: (9.0, 1)}


# --- cluster-count search ---------------------------------------------------


def _curve(spark, values, start=2):
    return spark.createDataFrame(
        [(1, start + i, float(v)) for i, v in enumerate(values)], "country_id long, k long, inertia double")


@pytest.mark.parametrize("values, k", [
    ([100, 50, 40, 35], 3), ([100, 80, 62, 46], 5), ([100, 50], 2), ([100], 2),
    ([100, 100, 90, 80], 5), ([100, 60, 50], 3), ([100, 90, 85, 84], 4),
])
def test_elbow_k(spark, values, k):
    assert clustering.elbow_k(_curve(spark, values)).first().k == k


def _reference_elbow(inertia, ks):
    drops = [a - b for a, b in zip(inertia, inertia[1:])]
    if len(drops) < 2:
        return ks[0]
    for i, (before, after) in enumerate(zip(drops, drops[1:])):
        if (after / before if before > 0 else 1) < 0.5:
            return ks[i + 1]
    return ks[-1]


def test_elbow_on_random_curves(spark):
    rng = random.Random(1)
    curves = {g: [round(rng.uniform(1, 100), 3) for _ in range(rng.randint(1, 9))] for g in range(150)}
    df = spark.createDataFrame(
        [(g, 2 + i, v) for g, c in curves.items() for i, v in enumerate(c)],
        "country_id long, k long, inertia double")
    got = {r.country_id: r.k for r in clustering.elbow_k(df).collect()}
    assert got == {g: _reference_elbow(c, list(range(2, 2 + len(c)))) for g, c in curves.items()}


@pytest.mark.parametrize("horizon", [1, 3, 50])
def test_search_in_rounds_equals_whole_curve(spark, monkeypatch, horizon):
    monkeypatch.setattr(clustering, "FIRST_HORIZON", horizon)
    rows = _rows({1: 1300, 2: 60, 3: 9, 4: 11})
    settings = clustering.ClusterSettings(kmeans=KMeansSettings(restarts=2))
    frame = _frame(spark, rows).persist()
    curve = clustering.inertia_curve(frame, settings)
    chosen = {r.country_id: r.k for r in clustering.elbow_k(curve).collect()}
    tops = {r.country_id: r["max(k)"] for r in curve.groupBy("country_id").max("k").collect()}
    if 1300 / chosen[1] > 300:
        chosen[1] = min(chosen[1] + int(1300 / chosen[1] // 200), tops[1])
    models = clustering.choose_models(frame, settings)
    assert {m.group: m.k for m in models} == chosen and set(chosen) == {1, 2, 4}
    frame.unpersist()


def test_small_clusters_are_dropped_and_numbers_keep_gaps(spark):
    near = [(i, 1, 50.0 + i * 1e-3, 10.0) for i in range(20)]
    lone = [(20, 1, 10.0, 10.0), (21, 1, 10.001, 10.0)]
    far = [(30 + i, 1, 70.0 + i * 1e-3, 10.0) for i in range(8)]
    frame = _frame(spark, near + lone + far)
    with KeyedKMeans(frame, settings=KMeansSettings(restarts=5)) as engine:
        models = engine.fit([(1, 3)], engine.profiles())
    clusters, members = clustering.label_clusters(frame, models, 5)
    got = {r.cluster_number: r.sample_count for r in clusters.collect()}
    assert got == {2: 20, 3: 8}
    assert members.count() == 28 and members.where("cluster_number = 1").count() == 0


def test_min_group_filter(spark):
    df = _frame(spark, _rows({1: 12, 2: 9}) + [(99, None, 1.0, 1.0)])
    kept = clustering.min_group_filter(df, 10)
    assert kept.count() == 12 and {r.country_id for r in kept.collect()} == {1}


def test_nothing_to_cluster(spark):
    frame = _frame(spark, _rows({1: 5}))
    assert clustering.choose_models(frame) == []
    clusters, members = clustering.cluster_country_samples(frame)
    assert clusters.count() == 0 and members.count() == 0
    row = clustering.clustering_coverage(clusters, frame).first()
    assert (row.total_clusters, row.avg_cluster_size, row.clustering_coverage) == (0, 0.0, 0.0)


# --- followed centres --------------------------------------------------------


@pytest.mark.parametrize("pairs, step", [(1 << 22, 16_000), (1 << 22, 60), (2_000, 300)])
def test_followed_centres_have_the_nearest_locations(monkeypatch, pairs, step):
    """Centres that rest, creep, jump or settle, on places with ties, towns, a line and far outliers; to the bit."""
    monkeypatch.setattr(kmeans, "LISTED_PAIRS", pairs)
    monkeypatch.setattr(kmeans, "STEP_LOCATIONS", step)
    rng = np.random.default_rng(8)
    layouts = [
        rng.integers(0, 30, (1500, 2)) / 2, rng.normal(0, 1, (1200, 2)), np.exp(rng.normal(0, 3, (900, 2))),
        np.concatenate([rng.normal(c, 0.01, (200, 2)) for c in rng.uniform(0, 50, (5, 2))]),
        np.column_stack([rng.uniform(0, 10, 600), np.zeros(600)]),
    ]
    for x, k in zip(layouts, (200, 90, 70, 150, 1)):
        x = np.unique(x, axis=0)
        places = kmeans._Places(*x.T.copy(), rng.integers(1, 9, len(x)).astype(float), 42)
        c = x[rng.choice(len(x), k, replace=False)].copy()
        followed = kmeans._Followed(places, *c.T.copy(), kmeans.nearest(places.lat, places.lon, *c.T)[0])
        for way in rng.integers(0, 5, 25):
            some = rng.random(k) < (1, 0.1, 0, 0.5, 0)[way]
            c[some] += rng.normal(0, np.ptp(x) / k**0.5 * (0.1, 0.3, 0, 0.01, 0)[way], (some.sum(), 2))
            if way == 2:
                c[rng.integers(0, k)] = x[rng.integers(0, len(x))]
            elif way == 4:
                held = followed.sums[0] > 0
                c[held] = (followed.sums[1:, held] / followed.sums[0, held]).T.round(9)
            elif k == 200:
                c = np.round(c * 2) / 2  # equal distances
            followed.follow(*c.T.copy())
            index, best = kmeans.nearest(places.lat, places.lon, *c.T)
            assert (followed.own == index).all() and (followed.squares() == best).all()
            assert all((total == np.bincount(index, line, k)).all() for total, line in zip(followed.sums, places.lines))


def test_followed_models_equal_models_by_blocks(monkeypatch):
    rng = np.random.default_rng(9)
    x = np.unique(np.concatenate([rng.normal(t, 0.4, (300, 2)) for t in rng.uniform(0, 20, (6, 2))]).round(2), axis=0)
    w = rng.integers(1, 5, len(x)).astype(float)
    found = []
    for bound in (0, 10**9):
        monkeypatch.setattr(kmeans, "FOLLOWED_CENTERS", bound)
        places = kmeans._Places(*x.T.copy(), w, 42)
        found.append([places.settled(r, k, 1e-4, 300) for r in (0, 1) for k in (3, 70, 400, len(x))])
    for (lat, lon, sums), (lat_, lon_, sums_) in zip(*found):
        assert np.allclose(lat, lat_, atol=3e-9) and np.allclose(lon, lon_, atol=3e-9)
        assert (sums[0] == sums_[0]).all() and sums[3].sum() == pytest.approx(sums_[3].sum(), abs=1e-6)


def test_followed_centres_leave_most_locations_alone():
    """Near rest, a step with one moved centre looks at its surroundings only."""
    rng = np.random.default_rng(10)
    x = rng.uniform(0, 10, (20_000, 2))
    places, c = kmeans._Places(*x.T.copy(), np.ones(len(x)), 42), rng.uniform(0, 10, (400, 2))
    followed = kmeans._Followed(places, *c.T.copy(), kmeans.nearest(places.lat, places.lon, *c.T)[0])
    looked, measured = [], followed._measured
    followed._measured = lambda at, next_: (looked.append(len(at)), measured(at, next_))[1]
    for i in range(6):
        c[7, 0] += 0.01
        looked.clear()
        followed.follow(*c.T.copy())
        assert i == 0 or sum(looked) < 2_000
    assert (followed.own == kmeans.nearest(places.lat, places.lon, *c.T)[0]).all()


def test_a_curve_takes_one_pass_however_many_centres(spark):
    rows, group = _rows({1: 900}), "jobs of a curve"
    with KeyedKMeans(_frame(spark, rows), settings=KMeansSettings(restarts=2, max_centers=60)) as engine:
        profiles = engine.profiles()
        spark.sparkContext.setJobGroup(group, group)
        curve = engine.curve([(1, k) for k in range(2, 21)], profiles)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setJobGroup("other", "other")
        some = engine.fit([(1, 2), (1, 20)], profiles)
    assert jobs <= 6  # 418 centres were seven passes and more
    assert [p for p in curve if p[1] in (2, 20)] == [(m.group, m.k, m.inertia) for m in some]
