"""Run-log rows and the reports on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold import defaults as D
from terrafold import schemas


def log_row(
    spark: SparkSession, run_id: str, stage: str, level: str, message: str,
    duration_ms: int | None = None, record_count: int | None = None,
    error_details: str | None = None,
) -> DataFrame:
    """One log entry, stamped with the current time."""
    row = [(run_id, stage, level, message, None, duration_ms, record_count, error_details)]
    return spark.createDataFrame(row, schemas.RUN_LOG).withColumn("timestamp", F.current_timestamp())


def append_run_log(rows: DataFrame, path: str) -> None:
    rows.select(*schemas.RUN_LOG.fieldNames()).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUN_LOG).parquet(path)


def slow_operations(log: DataFrame, threshold_ms: int = D.SLOW_STAGE_MS) -> DataFrame:
    return log.where(F.col("duration_ms") > threshold_ms)


def stage_performance(log: DataFrame, run_id: str | None = None) -> DataFrame:
    """Durations and records per run and stage."""
    chosen = log if run_id is None else log.where(F.col("run_id") == run_id)
    return chosen.groupBy("run_id", "stage_name").agg(
        F.count(F.lit(1)).alias("entries"),
        F.min("duration_ms").alias("min_ms"),
        F.max("duration_ms").alias("max_ms"),
        F.sum("duration_ms").alias("total_ms"),
        F.sum("record_count").alias("records"),
    )


def errors_and_warnings(log: DataFrame, run_id: str | None = None) -> DataFrame:
    chosen = log if run_id is None else log.where(F.col("run_id") == run_id)
    return chosen.where(F.col("log_level").isin("ERROR", "WARNING"))


def run_summary(counts: DataFrame, run_id: str, settings: dict) -> DataFrame:
    """(section, key, value) rows: table counts followed by the run's settings."""
    spark = counts.sparkSession
    figures = counts.unpivot(
        [], list(counts.columns), "key", "value"
    ).select(F.lit("counts").alias("section"), "key", F.col("value").cast("string").alias("value"))
    shown = [("run", "run_id", run_id)]
    shown += [("settings", k, "None" if v is None else str(v)) for k, v in settings.items()]
    return figures.unionByName(
        spark.createDataFrame(shown, "section string, key string, value string")
    )
