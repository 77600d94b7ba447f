"""Sample files: reading, cleaning, loading into the samples table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold import schemas
from terrafold.functions.measurement import clay_fraction, parse_measurement
from terrafold.operators.tables import enforce_columns, upsert_samples

FORMATS = ("parquet", "csv", "json")


def read_raw_samples(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Raw samples with numeric longitude and latitude columns."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format: {fmt}")
    reader = spark.read.schema(schemas.RAW_SAMPLES)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    return reader.format(fmt).load(path)


def clean_samples(raw: DataFrame) -> DataFrame:
    """Parsed measurement and clay class; the columns the samples table takes, plus ``soc_parsed``."""
    parsed = raw.withColumn("_m", parse_measurement("soc_percent"))
    return parsed.select(
        "raw_data_id",
        "latitude",
        "longitude",
        F.col("_m.soc_percent").alias("soc_percent"),
        F.col("_m.soc_method").alias("soc_method"),
        "top_depth_cm",
        "bottom_depth_cm",
        "sampling_date",
        "lab_analysis_date",
        clay_fraction("_m.soc_percent").alias("clay_fraction"),
        F.col("_m.soc_parsed").alias("soc_parsed"),
        *[c for c in raw.columns if c.startswith("_seq")],
    )


def load_samples(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return clean_samples(read_raw_samples(spark, path, fmt))


def load_into(existing: DataFrame | None, raw: DataFrame, order_cols: list[str]) -> DataFrame:
    """Clean raw rows, insist on the required columns, replace earlier rows with the same key.

    One lazy plan: a missing required value fails the job that computes it.
    """
    incoming = enforce_columns(
        clean_samples(raw.withColumns({f"_seq{i}": F.col(c) for i, c in enumerate(order_cols)}))
    )
    ordered = [f"_seq{i}" for i in range(len(order_cols))]
    return upsert_samples(existing, incoming, ordered).drop(*ordered)
