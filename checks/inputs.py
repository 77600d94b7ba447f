"""Spark frames behind the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views
from terrafold.operators.spatial import assign_polygons
from terrafold.sources.countries import filter_country_codes, outline_table, stored_boundary
from terrafold.functions.geometry import wkt_rings


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, sql: str, source: str) -> DataFrame:
    text = sql.replace("{", "{{").replace("}", "}}").replace(f"from {source}", "from {src}")
    return spark.sql(text, src=table(spark, folder, source))


def samples(spark, folder) -> DataFrame:
    return view(spark, folder, views.SAMPLES, "orders")


def raw_samples(spark, folder) -> DataFrame:
    return view(spark, folder, views.RAW_SAMPLES, "orders")


def wild_samples(spark, folder) -> DataFrame:
    return view(spark, folder, views.WILD_SAMPLES, "lineitem")


def run_log(spark, folder) -> DataFrame:
    return view(spark, folder, views.RUN_LOG, "events")


def stored_outlines(spark, folder) -> DataFrame:
    return view(spark, folder, views.STORED_OUTLINES, "orders")


def customer_countries(spark, folder) -> DataFrame:
    return view(spark, folder, views.CUSTOMER_COUNTRIES, "customer")


def countries_and_nowhere(spark) -> DataFrame:
    """The countries and one that no sample reaches."""
    known = countries(spark)
    return known.unionByName(
        spark.createDataFrame([(99, "Nowhere", "XX")], "id long, name string, iso_code string"), allowMissingColumns=True
    )


def countries(spark) -> DataFrame:
    """The nine default countries with stored outlines."""
    named = spark.sql(views.COUNTRIES).select(F.col("id").cast("long"), "name", "iso_code")
    outlines = filter_country_codes(outline_table(spark))
    return named.join(outlines, "iso_code").select(
        "id", "name", "iso_code", stored_boundary("wkt").alias("boundary")
    )


def boundaries(spark) -> DataFrame:
    named = spark.sql(views.COUNTRIES).select(F.col("id").cast("long").alias("country_id"), "iso_code")
    outlines = filter_country_codes(outline_table(spark))
    return named.join(outlines, "iso_code").select("country_id", wkt_rings("wkt").alias("rings"))


def located(spark, folder) -> DataFrame:
    """Samples with the country they lie in."""
    return assign_polygons(samples(spark, folder), boundaries(spark))


def zones(located_samples) -> DataFrame:
    """Located samples with a zone number: latitude degree modulo 4, plus 1."""
    zone = (F.floor("latitude") % 4 + 1).cast("long")
    return located_samples.where("country_id is not null").withColumn("cluster_number", zone)


def zone_clusters(spark, folder) -> DataFrame:
    """A clusters table made of zones, without ids."""
    return clusters_of(zones(located(spark, folder)))


def clusters_of(zoned) -> DataFrame:
    return zoned.groupBy("country_id", "cluster_number").agg(
        F.avg("latitude").alias("center_latitude"),
        F.avg("longitude").alias("center_longitude"),
        F.count(F.lit(1)).alias("sample_count"),
    )


def tidy(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Doubles rounded and integers widened, so that both engines give the same values."""
    def plain(f):
        kind = f.dataType.typeName()
        if kind in ("double", "float"):
            # Adding zero turns -0.0 into 0.0.
            return (F.round(f.name, places) + F.lit(0.0)).alias(f.name)
        if kind in ("integer", "short", "byte"):
            return F.col(f.name).cast("long").alias(f.name)
        return F.col(f.name)

    kept = [f for f in df.schema.fields if not columns or f.name in columns]
    return df.select(*[plain(f) for f in kept])
