import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrafold import defaults as D
from terrafold.functions.geometry import wkt_rings
from terrafold.operators import runlog, simplify
from terrafold.sources import countries as C
from terrafold.sources import files, outlines
from terrafold.sources import samples as S

RAW = [
    {"raw_data_id": "a", "longitude": 10.0, "latitude": 50.0,
     "soc_percent": '{"value": 2.5, "method": "dry, \\"hot\\""}', "top_depth_cm": 0,
     "bottom_depth_cm": 20, "sampling_date": "2001-01-01", "lab_analysis_date": None},
    {"raw_data_id": "b", "longitude": 11.0, "latitude": 51.0, "soc_percent": "oops",
     "top_depth_cm": 5, "bottom_depth_cm": 30, "sampling_date": "2002-01-01",
     "lab_analysis_date": "2002"},
]


@pytest.mark.parametrize("fmt", S.FORMATS)
def test_readers_give_the_same_rows(spark, tmp_path, fmt):
    from terrafold import schemas
    path = str(tmp_path / fmt)
    df = spark.createDataFrame(RAW, schemas.RAW_SAMPLES)
    writer = df.write.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)
    got = {r.raw_data_id: r for r in S.load_samples(spark, path, fmt).collect()}
    assert (got["a"].soc_percent, got["a"].soc_method, got["a"].clay_fraction) == (2.5, 'dry, "hot"', .25)
    assert (got["b"].soc_percent, got["b"].soc_parsed, got["b"].clay_fraction) == (0.0, False, .15)
    assert got["a"].lab_analysis_date is None and got["b"].bottom_depth_cm == 30


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        S.read_raw_samples(spark, "x", "xls")


def test_load_into_rejects_missing_values(spark):
    from terrafold import schemas
    rows = [dict(RAW[0], latitude=None)]
    with pytest.raises(Exception, match="missing value in one of"):
        S.load_into(None, spark.createDataFrame(rows, schemas.RAW_SAMPLES), ["sampling_date"]).count()
    kept = S.load_into(None, spark.createDataFrame(RAW, schemas.RAW_SAMPLES), ["sampling_date"])
    assert kept.count() == 2


DUMP = {"elements": [
    {"type": "node", "id": 1, "tags": {"ISO3166-1": "DE", "name": "no"}},
    {"type": "relation", "id": 2, "tags": {"ISO3166-1": "DE", "name": "Deutschland"}, "members": [
        {"type": "way", "ref": 5, "role": "outer"}]},
    {"type": "relation", "id": 3, "tags": {"ISO3166-1": "DE", "name": "later"}},
    {"type": "relation", "id": 4, "tags": {"ISO3166-1": "FR", "name:en": "France"}},
    {"type": "relation", "id": 5, "tags": {"ISO3166-1": "SE"}},
    {"type": "relation", "id": 6, "tags": {"ISO3166-1": ""}},
    {"type": "relation", "id": 7},
    {"type": "relation", "id": 8, "tags": {"ISO3166-1": "CH", "name": "Schweiz"}},
]}


def test_country_dump(spark, tmp_path):
    path = tmp_path / "dump.json"
    path.write_text(json.dumps(DUMP, indent=1))
    dumps = C.read_country_dump(spark, str(path))
    got = {r.iso_code: (r.name, r.relation_id) for r in C.load_countries(dumps, ["dump"]).collect()}
    assert got == {"DE": ("Deutschland", 2), "FR": ("France", 4), "SE": ("Unknown", 5), "CH": ("Schweiz", 8)}
    table = C.countries_from_dumps(dumps, ["dump"])
    assert {r.iso_code for r in table.collect()} == {"DE", "FR"}
    ring = table.where("iso_code = 'DE'").select(C.boundary_rings("boundary").alias("r")).first().r[0]
    assert [(p.x, p.y) for p in ring] == [
        (5.9, 47.3), (15.0, 47.3), (15.0, 55.1), (5.9, 55.1), (5.9, 47.3)]
    with_ch = C.countries_from_dumps(dumps, ["dump"], codes=["CH"], existing=table)
    assert {r.iso_code for r in with_ch.collect()} == {"DE", "FR", "CH"}


def _dump(ways, code="AA", **extra):
    members = [{"type": "way", "ref": ref, "role": role, "geometry": [{"lat": y, "lon": x} for x, y in points]} for ref, role, points in ways]
    return {"type": "relation", "id": 1, "tags": {"ISO3166-1": code, "name": code}, "members": members, **extra}


def _assembled(spark, *elements):
    rows = [(k, json.dumps({"elements": e})) for k, e in enumerate(elements)]
    dumps = C.dump_from_text(spark.createDataFrame(rows, "doc int, text string"), "text")
    return {r.iso_code: ([[(p.x, p.y) for p in ring] for ring in r.rings], r.open_ways)
            for r in outlines.assembled_rings(dumps, ["doc"]).collect()}


def test_rings_from_shuffled_ways(spark):
    """Random rings cut into ways in any order and direction come back whole, whatever the cuts."""
    rng = np.random.default_rng(6)
    elements, want = [], {}
    for c in range(12):
        ways, rings = [], []
        for k in range(int(rng.integers(1, 5))):
            n = int(rng.integers(3, 40))
            angles = np.sort(rng.uniform(0, 2 * np.pi, n))
            ring = [(round(100 * k + r * np.cos(a), 6), round(r * np.sin(a), 6)) for a, r in zip(angles, rng.uniform(1, 9, n))]
            ring.append(ring[0])
            cuts = np.unique(np.concatenate([[0, n], rng.integers(0, n + 1, 4)]))
            inner = k == 3
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = ring[a : b + 1]
                ways.append((len(ways), "inner" if inner else "outer", part[::-1] if rng.random() < 0.5 else part))
            rings.append(outlines.turned(np.array(ring), inner))
        order = rng.permutation(len(ways))
        ways = [(int(order[i]), role, points) for i, (_, role, points) in enumerate(ways)]
        elements.append(_dump(ways, f"C{c}"))
        want[f"C{c}"] = sorted([tuple(map(tuple, r.tolist())) for r in rings])
    got = _assembled(spark, elements)
    assert {k: sorted(tuple(r) for r in rings) for k, (rings, _) in got.items()} == want
    assert all(n == 0 for _, n in got.values())


def test_odd_relations(spark):
    square = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
    got = _assembled(
        spark,
        [_dump([(1, "outer", square[:3]), (1, "outer", square[:3]), (2, "", square[2:]), (3, "outer", [(5, 5), (6, 6)]), (4, "outer", [(9, 9)])]),
         _dump([], "BB"), {"type": "relation", "id": 3, "tags": {"ISO3166-1": "CC"}, "members": None}, {"type": "way", "id": 9}],
        [_dump([(7, "outer", [(0, 0), (1, 0), (0, 0)])], "DD"), _dump([(5, "inner", square)], "AA")],
        # two squares that touch in a corner
        [_dump([(1, "outer", square), (2, "outer", [(2, 2), (4, 2), (4, 4)]), (3, "outer", [(2, 2), (2, 4), (4, 4)])], "EE")],
    )
    assert got["AA"] == ([[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]], 1)
    assert got["DD"] == ([], 1) and set(got) == {"AA", "DD", "EE"}
    assert len(got["EE"][0]) == 2 and got["EE"][1] == 0


def test_stitched_outlines_come_before_built_in_ones(spark):
    square = [(0, 0), (0, 2), (2, 2), (2, 0), (0, 0)]
    text = json.dumps({"elements": [_dump([(1, "outer", square[:3]), (2, "outer", square[2:])], "DE"), _dump([], "FR")]})
    dumps = C.dump_from_text(spark.createDataFrame([(0, text)], "doc int, text string"), "text")
    found = C.countries_from_dumps(dumps, ["doc"], with_members=True).select("iso_code", C.boundary_rings("boundary").alias("r"))
    rings = {r.iso_code: [(p.x, p.y) for p in r.r[0]] for r in found.collect()}
    assert rings["DE"] == [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)] and rings["FR"][0] == (-5.1, 41.3)


def test_default_codes(spark):
    assert len(D.DEFAULT_COUNTRY_CODES) == 27 and "CH" not in D.DEFAULT_COUNTRY_CODES
    both = C.filter_country_codes(C.outline_table(spark))
    assert both.count() == 9


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_export(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a, \"b\"", 1.5), (2, None, None)], "id int, t string, v double")
    path = str(tmp_path / fmt)
    files.export_table(df, path, fmt)
    back = spark.read.schema(df.schema).option("header", True).format(fmt).load(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(ValueError):
        files.export_table(df, path + "2", "xml")


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    for i, (stage, level, ms) in enumerate([("load", "INFO", 1500), ("load", "WARNING", None),
                                            ("join", "ERROR", 20)]):
        runlog.append_run_log(
            runlog.log_row(spark, "r1", stage, level, f"m{i}", ms, 10 * i, None), path)
    log = runlog.read_run_log(spark, path)
    assert log.count() == 3 and log.where("timestamp is null").count() == 0
    assert [r.message for r in runlog.slow_operations(log).collect()] == ["m0"]
    assert {r.message for r in runlog.errors_and_warnings(log, "r1").collect()} == {"m1", "m2"}
    got = {r.stage_name: r for r in runlog.stage_performance(log, "r1").collect()}
    assert (got["load"].entries, got["load"].total_ms, got["load"].records) == (2, 1500, 10)
    counts = spark.createDataFrame([(3, 2)], "soil_samples long, countries long")
    rows = {(r.section, r.key): r.value for r in
            runlog.run_summary(counts, "r1", {"size": 5, "codes": None}).collect()}
    assert rows == {("counts", "soil_samples"): "3", ("counts", "countries"): "2",
                    ("run", "run_id"): "r1", ("settings", "size"): "5", ("settings", "codes"): "None"}


def _distance_to_path(p, path):
    best = np.inf
    for a, b in zip(path, path[1:]):
        ab = b - a
        t = 0 if not ab @ ab else np.clip((p - a) @ ab / (ab @ ab), 0, 1)
        best = min(best, np.linalg.norm(p - a - t * ab))
    return best


def test_simplify_stays_within_tolerance(spark):
    rng = np.random.default_rng(4)
    angles = np.linspace(0, 2 * np.pi, 400)
    ring = np.column_stack([np.cos(angles), np.sin(angles)]) * (1 + rng.normal(0, 0.001, 400))[:, None]
    ring[-1] = ring[0]
    kept = simplify.kept_vertices(ring, 0.01)
    assert 8 < len(kept) < 100 and kept[0] == 0 and kept[-1] == 399
    assert max(_distance_to_path(p, ring[kept]) for p in ring) <= 0.01 + 1e-12


def _crossings(lines):
    pairs = set()
    for i in range(len(lines)):
        for j in range(i):
            p, q, r, s = (x[None] for x in (lines[i, :2], lines[i, 2:], lines[j, :2], lines[j, 2:]))
            a, b, c, d = (simplify._side(*x) for x in ((p, q, r), (p, q, s), (r, s, p), (r, s, q)))
            touch = [simplify._inside(*x)[0] for x in ((p, q, r, a), (p, q, s, b), (r, s, p, c), (r, s, q, d))]
            if (a * b < 0)[0] and (c * d < 0)[0] or any(touch):
                pairs.add((j, i))
    return pairs


def test_simplify_makes_no_crossings():
    rng = np.random.default_rng(0)
    for _ in range(25):
        n = int(rng.integers(8, 70))
        angles, far = np.sort(rng.uniform(0, 2 * np.pi, n)), rng.uniform(0.3, 1.5, n)
        ring = np.column_stack([far * np.cos(angles), far * np.sin(angles)])
        ring = np.vstack([ring, ring[:1]])
        for tolerance in (0.05, 0.4, 0.9):
            kept = simplify.kept_of_shape([ring, ring * 0.2], tolerance)
            lines, _ = simplify._segments([ring, ring * 0.2], kept)
            assert not _crossings(lines) and not len(simplify._meeting(lines)[0])
    # an outline that already crosses itself is left with its crossing
    bow = np.array([(0, 0), (1, 1.0), (2, 2), (2, 0), (1, 1.01), (0, 2), (0, 0)], float)
    assert len(simplify.kept_of_shape([bow], 0.1)[0]) >= 4


def test_a_notch_stays_inside_its_outline():
    ring = np.array([(0, 0), (2, -0.3), (4, 0), (4, 4), (2.2, 4), (2, -0.2), (1.8, 4), (0, 4), (0, 0)], float)
    kept, = simplify.kept_of_shape([ring], 0.35)
    lines, _ = simplify._segments([ring], [kept])
    assert not _crossings(lines)


def test_shapes_are_simplified_together(monkeypatch):
    """Many shapes take the steps of one and come out as each does on its own, shapes with NaN and without rings among them."""
    rng, shapes = np.random.default_rng(7), []
    for _ in range(300):
        rings = [np.round(rng.normal(size=(int(rng.integers(0, 30)), 2)), 1) for _ in range(int(rng.integers(0, 4)))]
        for ring in rings:
            ring[-1:] = ring[:1]
            ring[rng.random(len(ring)) < 0.005] = np.nan
        shapes.append(rings)
    alone = [simplify.kept_of_shape(rings, 0.6) for rings in shapes]
    steps, meeting = [], simplify._meeting
    monkeypatch.setattr(simplify, "_meeting", lambda *x: steps.append(1) or meeting(*x))
    lists = [pa.array([[r[:, c].tolist() for r in rings] for rings in shapes] + [None], pa.list_(pa.list_(pa.float64()))) for c in (0, 1)]
    got = simplify._kept_lists(*lists, 0.6).to_pylist()
    assert got == [[k.tolist() for k in kept] for kept in alone] + [None]
    assert len(steps) < 20
    monkeypatch.setattr(simplify, "STEP_VERTICES", 50)
    assert simplify._kept_lists(*lists, 0.6).to_pylist() == got


def test_shapes_of_one_file_are_spread_over_tasks(spark):
    square = [[(0.0, 0.0), (0.5, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]]
    df = spark.createDataFrame([(i, square) for i in range(400)], "id int, rings array<array<struct<x double, y double>>>").coalesce(1)
    got = simplify.simplify_boundaries(df, 0.01).select("id", F.spark_partition_id().alias("task"), F.size(F.flatten("rings")).alias("n")).collect()
    assert sorted(r.id for r in got) == list(range(400)) and {r.n for r in got} == {5}
    assert len({r.task for r in got}) >= spark.sparkContext.defaultParallelism


def test_simplify_gives_a_row_for_each_row(spark):
    square = [[(0.0, 0.0), (0.5, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]]
    rows = [("a", square), ("a", square), ("b", square * 2), ("c", None), ("d", []), (None, [None, []])]
    df = spark.createDataFrame(rows, "name string, rings array<array<struct<x double, y double>>>")
    got = sorted((r.name or "", None if r.rings is None else [x and len(x) for x in r.rings]) for r in simplify.simplify_boundaries(df, 0.01).collect())
    assert got == [("", [None, []]), ("a", [5]), ("a", [5]), ("b", [5, 5]), ("c", None), ("d", [])]
    assert simplify.simplify_boundaries(df.select("rings"), 0.01).count() == 6


def test_simplify_keeps_rows_rings_and_triangles(spark):
    wkts = [(1, "a", "POLYGON ((0 0, 5 0.0005, 10 0, 10 10, 0 10, 0 0), (2 2, 3 2, 3 3, 2 2))"),
            (2, "b", "POLYGON ((0 0, 0.0001 0, 0.0001 0.0001, 0 0))")]
    df = spark.createDataFrame(wkts, "id int, name string, wkt string").select(
        "id", "name", wkt_rings("wkt").alias("rings"))
    got = {r.id: r for r in simplify.simplify_boundaries(df).collect()}
    assert [len(ring) for ring in got[1].rings] == [5, 4] and got[1].name == "a"
    assert [len(ring) for ring in got[2].rings] == [4]
    assert got[1].rings[0][1] == (10.0, 0.0)
    assert simplify.simplify_boundaries(df.where(F.lit(False))).count() == 0
