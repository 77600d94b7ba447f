import random

import pytest
from pyspark.sql import functions as F

from terrafold.functions.geometry import wkt_rings
from terrafold.operators import spatial


def _boundaries(spark, *shapes):
    df = spark.createDataFrame(list(shapes), "country_id long, wkt string")
    return df.select("country_id", wkt_rings("wkt").alias("rings"))


def _assign(spark, points, boundaries, **options):
    df = spark.createDataFrame(points, "id long, longitude double, latitude double")
    return {r.id: r.country_id for r in spatial.assign_polygons(df, boundaries, **options).collect()}


BOX = "POLYGON ((5.9 47.3, 15 47.3, 15 55.1, 5.9 55.1, 5.9 47.3))"
BOTH = [{}, {"max_broadcast_edges": -1}]


@pytest.mark.parametrize("options", BOTH)
def test_outline_points_do_not_match(spark, options):
    points = [(1, 5.9, 47.3), (2, 5.9, 50.0), (3, 10.0, 55.1), (4, 10.0, 50.0), (5, 20.0, 50.0)]
    got = _assign(spark, points, _boundaries(spark, (7, BOX)), **options)
    assert got == {1: None, 2: None, 3: None, 4: 7, 5: None}


@pytest.mark.parametrize("options", BOTH)
def test_highest_id_wins_overlaps(spark, options):
    other = "POLYGON ((9 50, 30 50, 30 60, 9 60, 9 50))"
    got = _assign(spark, [(1, 10.0, 52.0), (2, 8.0, 49.0), (3, 20.0, 55.0)],
                  _boundaries(spark, (3, BOX), (2, other)), **options)
    assert got == {1: 3, 2: 3, 3: 2}


@pytest.mark.parametrize("options", BOTH)
def test_unusable_coordinates_stay_unassigned(spark, options):
    around_zero = "POLYGON ((-5 -5, 5 -5, 5 5, -5 5, -5 -5))"
    points = [(1, float("nan"), 0.5), (2, None, 0.5), (3, 0.5, float("nan")), (4, 0.5, 0.5)]
    got = _assign(spark, points, _boundaries(spark, (1, around_zero)), **options)
    assert got == {1: None, 2: None, 3: None, 4: 1}


def _inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * ((y - y1) / (y2 - y1)):
                odd = not odd
    return odd


@pytest.mark.parametrize("grid", [0.3, 1.0, 7.0])
@pytest.mark.parametrize("options", BOTH)
def test_against_brute_force(spark, grid, options):
    rng = random.Random(5)
    shapes = []
    for i in range(12):
        cx, cy = rng.uniform(-10, 10), rng.uniform(-10, 10)
        import math
        star = [(round(cx + r * math.cos(a), 2), round(cy + r * math.sin(a), 2))
                for a, r in ((k * math.pi / 6, rng.uniform(0.5, 4)) for k in range(12))]
        hole = [(cx - 0.2, cy - 0.2), (cx + 0.2, cy - 0.2), (cx + 0.2, cy + 0.2), (cx - 0.2, cy - 0.2)]
        shapes.append((i + 1, [star + star[:1], hole]))
    # Points on a coarse lattice hit vertices' latitudes and horizontal edges.
    points = [(i, round(rng.uniform(-14, 14), 1), round(rng.uniform(-14, 14), 1)) for i in range(1500)]
    points += [(5000 + i, float(x), float(y)) for i, (x, y) in
               enumerate(p for _, rings in shapes for p in rings[0])]
    rows = [(i, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for i, rings in shapes]
    boundaries = spark.createDataFrame(
        rows, "country_id long, rings array<array<struct<x double, y double>>>")
    want = {i: max((c for c, rings in shapes if _inside(rings, x, y)), default=None)
            for i, x, y in points}
    assert _assign(spark, points, boundaries, grid=grid, **options) == want
    assert any(v for v in want.values())


def test_covered_cells_carry_no_edges(spark):
    cells = spatial.polygon_cells(_boundaries(spark, (1, BOX)))
    assert cells.where("covered and size(edges) > 0").count() == 0
    covered = {(r.cell_x, r.cell_y) for r in cells.where("covered").collect()}
    assert covered == {(x, y) for x in range(6, 14) for y in range(48, 55)}


def test_counts_and_coverage(spark):
    countries = spark.createDataFrame([(1, "A", "AA"), (2, "B", "BB")], "id long, name string, iso_code string")
    samples = spark.createDataFrame([(1, 1), (2, 1), (3, None)], "id long, country_id long")
    counted = {r.id: r.sample_count for r in spatial.refresh_sample_counts(countries, samples).collect()}
    assert counted == {1: 2, 2: 0}
    row = spatial.association_coverage(samples, countries).first()
    assert row.coverage_percentage == pytest.approx(200 / 3)
    assert (row.total_samples, row.associated_samples, row.unassigned_samples) == (3, 2, 1)
    assert (row.countries_with_samples, row.total_countries) == (1, 2)
    empty = spatial.association_coverage(samples.limit(0), countries).first()
    assert (empty.total_samples, empty.coverage_percentage) == (0, 0.0)
    spread = {r.iso_code: r.n_samples for r in spatial.country_distribution(samples, countries).collect()}
    assert spread == {"AA": 2, "BB": 0}
    assert [r.id for r in spatial.active_countries(countries, samples).collect()] == [1]
    found = samples.where("country_id is not null")
    assert [r.id for r in spatial.unassigned_samples(samples, found).collect()] == [3]


def test_points_are_neither_shuffled_nor_multiplied(spark):
    points = spark.range(100).select(
        "id", (F.col("id") / 10).alias("longitude"), F.lit(50.0).alias("latitude"))
    plan = spatial.assign_polygons(points, _boundaries(spark, (1, BOX)))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text and "SortMergeJoin" not in text


def test_null_and_repeated_ids_are_placed_alike_on_both_ways(spark):
    shapes = _boundaries(spark, (7, BOX), (3, "POLYGON ((0 0, 30 0, 30 60, 0 60, 0 0))"))
    points = [(None, 10.0, 50.0), (None, 40.0, 50.0), (1, 10.0, 50.0), (1, 20.0, 20.0), (1, None, 1.0), (2, float("nan"), 50.0)]
    df = spark.createDataFrame(points, "id long, longitude double, latitude double")
    found = [
        sorted(map(str, spatial.assign_polygons(df, shapes, **options).select("id", "longitude", "country_id").collect()))
        for options in BOTH
    ]
    assert found[0] == found[1] and len(found[0]) == 6
    assert [r.country_id for r in spatial.assign_polygons(df, shapes, **BOTH[1]).where("id = 1").orderBy("longitude").collect()] == [None, 7, 3]


def _lattice(spark, n):
    """n * n square outlines side by side in the degree from (10, 50); ids go by rows."""
    side = 1.0 / n
    square = F.transform(
        F.array(*[F.struct(F.lit(u).alias("u"), F.lit(v).alias("v")) for u, v in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]),
        lambda c: F.struct((10 + (F.col("i") + c["u"]) * side).alias("x"), (50 + (F.col("j") + c["v"]) * side).alias("y")),
    )
    cells = spark.range(n * n).select("id", (F.col("id") % n).alias("i"), F.floor(F.col("id") / n).alias("j"))
    return cells.select(F.col("id").alias("country_id"), F.array(square).alias("rings"))


@pytest.mark.parametrize("options", BOTH)
def test_a_hundred_thousand_outlines_in_one_degree(spark, options):
    n = 320
    shapes = _lattice(spark, n)
    cells, splits = spatial.adaptive_cells(shapes)
    cells = cells.cache()
    assert splits and cells.agg(F.max(F.size("edges"))).first()[0] <= 8
    per_cell = cells.groupBy(*spatial.CELL).agg(F.sum(F.size("edges")).alias("n"))
    assert per_cell.agg(F.max("n")).first()[0] <= 2 * spatial.CELL_EDGES
    cells.unpersist()
    samples = spark.range(4000).select(
        "id", (10 + (F.pmod(F.col("id") * 7919, F.lit(n)) + 0.5) / n).alias("longitude"),
        (50 + (F.pmod(F.col("id") * 104729, F.lit(n)) + 0.25) / n).alias("latitude"))
    wrong = spatial.assign_polygons(samples, shapes, **options).where(
        ~F.col("country_id").eqNullSafe(F.pmod(F.col("id") * 104729, F.lit(n)) * n + F.pmod(F.col("id") * 7919, F.lit(n))))
    assert wrong.count() == 0


@pytest.mark.parametrize("options", [{"max_edges": 4}, {"max_edges": 4, "max_broadcast_edges": -1, "cell_samples": 10}])
@pytest.mark.parametrize("grid", [1.0, 7.0])
def test_split_cells_against_brute_force(spark, grid, options):
    test_against_brute_force(spark, grid, options)


def test_a_crowded_cell_is_shared_by_tasks(spark):
    shapes = _boundaries(spark, (7, BOX), (3, "POLYGON ((0 0, 30 0, 30 60, 0 60, 0 0))"))
    points = spark.range(5000).select(
        "id", F.when(F.col("id") % 10 < 3, 10.5).otherwise((F.col("id") % 977) / 40).alias("longitude"),
        F.when(F.col("id") % 10 < 3, 50.5).when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 1013) / 17).alias("latitude"))
    near = spatial.assign_polygons(points, shapes)
    far = spatial.assign_polygons(points, shapes, max_broadcast_edges=-1, cell_samples=100)
    assert far.count() == 5000 and near.exceptAll(far).count() == 0
    assert far.where("country_id = 7").count() >= 1500
    plan = far._jdf.queryExecution().executedPlan().toString()
    assert "_copy" in plan and "country_id" in far.columns


def test_polygons_of_one_id_stay_apart(spark):
    """Equal outlines under one id do not cancel out; neither do nested ones of several rows."""
    shapes = _boundaries(spark, (7, BOX), (7, BOX), (7, "POLYGON ((8 49, 9 49, 9 50, 8 50, 8 49))"))
    for options in BOTH:
        assert _assign(spark, [(1, 8.5, 49.5), (2, 12.0, 52.0), (3, 0.0, 0.0)], shapes, **options) == {1: 7, 2: 7, 3: None}


@pytest.mark.parametrize("options", BOTH)
def test_no_outlines_and_no_samples(spark, options):
    none = _boundaries(spark, (7, BOX)).limit(0)
    assert _assign(spark, [(1, 8.5, 49.5)], none, **options) == {1: None}
    empty = spark.createDataFrame([], "id long, longitude double, latitude double")
    assert spatial.assign_polygons(empty, _boundaries(spark, (7, BOX)), **options).count() == 0
