import math

import pytest
from pyspark.sql import functions as F

from terrafold.functions import geometry as G
from terrafold.functions import sizing as S
from terrafold.functions.measurement import clay_fraction, parse_measurement


@pytest.mark.parametrize("text, soc, method, parsed", [
    ('{"value":2.5,"method":"dry"}', 2.5, "dry", True),
    ('{"value":"2.5"}', 2.5, "", True),
    ('{"value": 1e2, "method": null}', 100.0, "", True),
    ('{"value": 0}', 0.0, "", True),
    ('{"value":null}', 0.0, "", False),
    ('{"v":1}', 0.0, "", False),
    ("3.5", 0.0, "", False),
    ("oops", 0.0, "", False),
    ("", 0.0, "", False),
    (None, 0.0, "", False),
    ('{"value":"2.5d","method":"dry"}', 0.0, "", False),
    ('{"value":true}', 1.0, "", True),
    ('{"value":"true"}', 0.0, "", False),
    ("{'value': 2.5}", 0.0, "", False),
    ('{"value": 2.5} junk', 0.0, "", False),
    ('{"value": 2.5}]', 0.0, "", False),
    ('{"value": 2.5}}', 0.0, "", False),
    ('{"value": 1}, {"value": 2}', 0.0, "", False),
    ('[{"value": 1}]', 0.0, "", False),
    ('{"value": 5, "value": 7}', 7.0, "", True),
    ('{"value": 2.5', 0.0, "", False),
    ('{"value": 2.5, "method": bad}', 0.0, "", False),
    ('{"value": -Infinity}', float("-inf"), "", True),
    ('{"value": 1.5, "method": {"a": 2}}', 1.5, '{"a":2}', True),
    ('{"value": 01}', 0.0, "", False),
    ("null", 0.0, "", False),
    ('{"value":{"a":1}}', 0.0, "", False),
])
def test_parse_measurement(spark, text, soc, method, parsed):
    df = spark.createDataFrame([(text,)], "raw string")
    got = df.select(parse_measurement("raw").alias("m")).first().m
    assert (got.soc_percent, got.soc_method, got.soc_parsed) == (soc, method, parsed)


def test_clay_fraction(spark):
    values = [0.99, 1.0, 2.99, 3.0, float("nan"), -1.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.c for r in df.select("i", clay_fraction("v").alias("c")).orderBy("i").collect()]
    assert got == [0.15, 0.25, 0.25, 0.35, 0.35, 0.15]


def test_wkt_round_trip(spark):
    texts = [
        "POLYGON ((5.9 47.3, 15 47.3, 15 55.1, 5.9 55.1, 5.9 47.3))",
        "POLYGON ((0 0, 9 0, 9 9, 0 0), (1 1, 2 1, 2 2, 1 1))",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "wkt string")
    quoted = df.select("wkt", G.json_quote("wkt").alias("q"))
    assert quoted.first().q == f'"{texts[0]}"'
    back = quoted.select("wkt", G.rings_wkt(G.wkt_rings(G.json_unquote("q"))).alias("b")).collect()
    assert all(r.wkt == r.b for r in back)


def test_multipolygon_rings_and_box(spark):
    wkt = "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 0)), ((5 5, 7 5, 7 8, 5 5), (5.5 5.2, 6 5.2, 6 5.4, 5.5 5.2)))"
    df = spark.createDataFrame([(wkt,)], "wkt string").select(G.wkt_rings("wkt").alias("rings"))
    row = df.select(F.size("rings").alias("n"), G.bounding_box("rings").alias("b")).first()
    assert row.n == 3 and tuple(row.b) == (0.0, 0.0, 7.0, 8.0)


def test_mercator_round_trip(spark):
    df = spark.createDataFrame([(12.5, 41.9), (-179.0, -80.0), (0.0, 0.0)], "lon double, lat double")
    m = df.select("lon", "lat", G.to_web_mercator("lon", "lat").alias("m"))
    for r in m.select("lon", "lat", "m.*", G.from_web_mercator("m.x", "m.y").alias("b")).collect():
        assert r.x == pytest.approx(math.radians(r.lon) * 6378137.0)
        assert (r.b.longitude, r.b.latitude) == (pytest.approx(r.lon), pytest.approx(r.lat))


def _value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def _n(value):
    return F.lit(value).cast("long")


@pytest.mark.parametrize("n, k", [(4929, 32), (9, 1), (1000, 10), (1001, 10), (3000, 20), (30, 6)])
def test_k_upper_bound(spark, n, k):
    assert _value(spark, S.k_upper_bound(_n(n))) == k


@pytest.mark.parametrize("n, k, top, want", [(4929, 4, 32, 10), (1000, 2, 10, 2), (4929, 31, 32, 31),
                                             (9000, 2, 12, 12)])
def test_k_large_adjust(spark, n, k, top, want):
    assert _value(spark, S.k_large_adjust(_n(n), _n(k), _n(top))) == want


@pytest.mark.parametrize("n, size, want", [(5000, 100, 5), (5000, 400, 20), (1500, 1000, 10),
                                           (800, 100, 10), (4, 100, 4), (50, 3, 3), (1, 100, 1)])
def test_proportional_k(spark, n, size, want):
    assert _value(spark, S.proportional_k(_n(n), size)) == want


@pytest.mark.parametrize("n, size, want", [(5000, 100, 10), (120, 100, 2), (99, 100, 1), (7, 1, 7)])
def test_single_cluster_k(spark, n, size, want):
    assert _value(spark, S.single_cluster_k(_n(n), size)) == want


def test_cluster_quota(spark):
    got = [_value(spark, S.cluster_quota(_n(c), _n(1000), 100)) for c in (950, 45, 4, 1)]
    assert got == [95, 4, 1, 1]
