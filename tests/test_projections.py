import pytest
from pyspark.sql import functions as F

from terrafold.functions import projections as P


def _xy(spark, lon, lat, make):
    df = spark.createDataFrame([(lon, lat)], "longitude double, latitude double")
    return df.select(make.alias("m")).select("m.*").first()


def test_known_points(spark):
    tower = _xy(spark, -(79 + 23 / 60 + 13.7 / 3600), 43 + 38 / 60 + 33.24 / 3600,
                P.to_transverse_mercator("longitude", "latitude", P.zone_meridian("longitude")))
    assert (tower.x, tower.y) == (pytest.approx(630084, abs=1), pytest.approx(4833438, abs=1))
    pole = _xy(spark, 3.0, 89.999999999, P.to_transverse_mercator("longitude", "latitude", F.lit(3.0)))
    assert (pole.x, pole.y) == (pytest.approx(500000), pytest.approx(0.9996 * 10001965.729, abs=2e-3))
    grid = _xy(spark, 5.0, 50.0, P.to_equal_area("longitude", "latitude"))
    assert (grid.x, grid.y) == (pytest.approx(3962799.45, abs=0.01), pytest.approx(2999718.85, abs=0.01))
    centre = _xy(spark, 10.0, 52.0, P.to_equal_area("longitude", "latitude"))
    assert (centre.x, centre.y) == (pytest.approx(4321000, abs=1e-6), pytest.approx(3210000, abs=1e-6))


def test_round_trips_to_a_millimetre(spark):
    places = spark.range(4000).select(
        ((F.col("id") * 7919 % 6000) / 100 - 20).alias("longitude"), ((F.col("id") * 104729 % 16000) / 100 - 80).alias("latitude"))
    degree = 1e-3 / 111320
    mid = F.lit(10.0)
    zone = P.from_transverse_mercator("m.x", "m.y", "mid")
    moved = places.withColumn("mid", P.zone_meridian("longitude")).withColumn("m", P.to_transverse_mercator("longitude", "latitude", "mid"))
    wide = places.withColumn("mid", mid).withColumn("m", P.to_transverse_mercator("longitude", "latitude", mid))
    area = places.withColumn("m", P.to_equal_area("longitude", "latitude"))
    for df, back in ((moved, zone), (wide, zone), (area, P.from_equal_area("m.x", "m.y"))):
        off = df.withColumn("b", back).agg(
            F.max(F.abs(F.col("b.latitude") - F.col("latitude"))).alias("a"),
            F.max(F.abs(F.col("b.longitude") - F.col("longitude")) * F.cos(F.radians("latitude"))).alias("o")).first()
        assert off.a < degree and off.o < degree


def test_nulls_and_the_centre(spark):
    gone = _xy(spark, None, 50.0, P.to_equal_area("longitude", "latitude"))
    assert gone.x is None
    back = _xy(spark, 0.0, 0.0, P.from_equal_area(F.lit(4321000.0), F.lit(3210000.0)))
    assert (back.longitude, back.latitude) == (pytest.approx(10), pytest.approx(52))
