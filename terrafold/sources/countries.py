"""Country dimension: saved map dumps, outlines, the countries table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold import defaults as D
from terrafold import schemas
from terrafold.functions.geometry import (
    bounding_box, box_rings, json_quote, json_unquote, rings_wkt, wkt_rings,
)
from terrafold.operators.tables import upsert_countries
from terrafold.sources.outlines import member_outlines


def read_country_dump(spark: SparkSession, path: str) -> DataFrame:
    """Saved dumps, one JSON document per file, with their file name as ``dump``."""
    return (
        spark.read.schema(schemas.COUNTRY_DUMP).option("multiLine", True).json(path)
        .withColumn("dump", F.input_file_name())
    )


def dump_from_text(texts: DataFrame, text_col: str) -> DataFrame:
    """The same from documents held in a string column."""
    parsed = F.from_json(text_col, schemas.COUNTRY_DUMP)
    return texts.withColumn("elements", parsed["elements"]).drop(text_col)


def load_countries(dumps: DataFrame, order_cols: list[str]) -> DataFrame:
    """(iso_code, name, relation_id): the first relation of every country code.

    First means by ``order_cols`` of the dump, then by position inside it. The minimum is taken in
    partial aggregates, so a code that fills the dump is reduced before the shuffle.
    """
    relations = (
        dumps.select(*order_cols, F.posexplode("elements").alias("_pos", "_e"))
        .where(F.col("_e.type") == "relation")
        .select(
            *order_cols,
            "_pos",
            F.col("_e.tags").getItem("ISO3166-1").alias("iso_code"),
            F.coalesce(
                F.col("_e.tags").getItem("name"), F.col("_e.tags").getItem("name:en"), F.lit("Unknown")
            ).alias("name"),
            F.col("_e.id").alias("relation_id"),
        )
        .where("iso_code is not null and iso_code <> ''")
    )
    first = F.min(F.struct(*order_cols, "_pos", "name", "relation_id"))
    return relations.groupBy("iso_code").agg(first.alias("_f")).select(
        "iso_code", "_f.name", "_f.relation_id"
    )


def filter_country_codes(countries: DataFrame, codes: list[str] | None = None) -> DataFrame:
    return countries.where(F.col("iso_code").isin(codes or D.DEFAULT_COUNTRY_CODES))


def outline_table(spark: SparkSession) -> DataFrame:
    """(iso_code, wkt) of the built-in outlines."""
    boxes = spark.createDataFrame(
        D.COUNTRY_BOXES,
        "iso_code string, min_lon double, min_lat double, max_lon double, max_lat double",
    )
    return boxes.select(
        "iso_code", rings_wkt(box_rings("min_lon", "min_lat", "max_lon", "max_lat")).alias("wkt")
    )


def country_boundaries(countries: DataFrame, outlines: DataFrame | None = None) -> DataFrame:
    """Countries with the outline of their code; codes without one are dropped.

    The built-in outlines have ten rows and are broadcast. Other tables are joined as Spark sees fit.
    """
    if outlines is None:
        outlines = F.broadcast(outline_table(countries.sparkSession))
    return countries.join(outlines, "iso_code")


def stored_boundary(wkt) -> Column:
    """Outline text as stored: a JSON string holding WKT."""
    return json_quote(wkt)


def boundary_rings(stored) -> Column:
    """Rings of a stored outline."""
    return wkt_rings(json_unquote(stored))


def country_bbox(countries: DataFrame, rings_col: str = "rings") -> DataFrame:
    others = [c for c in countries.columns if c != rings_col]
    return countries.select(*others, bounding_box(rings_col).alias("_b")).select(*others, "_b.*")


def countries_from_dumps(
    dumps: DataFrame, order_cols: list[str], codes: list[str] | None = None,
    existing: DataFrame | None = None, with_members: bool = False,
) -> DataFrame:
    """Dump to countries table in one plan: parse, filter codes, attach outlines, upsert by name.

    ``with_members`` stitches outlines from the geometry of the relations' ways; codes without any keep the built-in one.
    """
    outlines = None
    if with_members:
        found = member_outlines(dumps, order_cols)
        built_in = outline_table(dumps.sparkSession)
        outlines = found.unionByName(built_in.join(found, "iso_code", "left_anti"))
    found = country_boundaries(filter_country_codes(load_countries(dumps, order_cols), codes), outlines)
    rows = found.select("name", "iso_code", stored_boundary("wkt").alias("boundary"))
    return upsert_countries(existing, rows, ["iso_code"])
