"""Table files: columnar storage and text exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def export_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a table as csv (with header) or json lines, one file per partition."""
    if fmt == "csv":
        df.write.mode("errorifexists").option("header", True).csv(path)
    elif fmt == "json":
        df.write.mode("errorifexists").option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"unknown format: {fmt}")


def read_exported(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    """An exported table, with the types it had."""
    if fmt == "csv":
        # A bare empty field is null and a quoted one is empty text, so the null marker must not be empty.
        return spark.read.schema(schema).option("header", True).option("nullValue", "\u0000").csv(path)
    return spark.read.schema(schema).option("allowNonNumericNumbers", True).json(path)
