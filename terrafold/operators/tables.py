"""Keyed tables: upsert, append with key checks, surrogate ids, keyed column updates, scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold import schemas
from terrafold.session import cut_lineage


class ConstraintError(ValueError):
    """A required value is missing or a unique key occurs twice."""


def keep_last(df: DataFrame, key_cols: list[str], order_cols: list[str]) -> DataFrame:
    """One row per key: the last one in input order.

    ``order_cols`` must order the rows of a key totally; files have no row order of their own. The
    rank-1 filter reduces each input partition before the shuffle, so a hot key costs one row per
    partition.
    """
    newest = Window.partitionBy(*key_cols).orderBy(*[F.col(c).desc() for c in order_cols])
    return df.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def upsert(
    existing: DataFrame | None, incoming: DataFrame, key_cols: list[str], order_cols: list[str]
) -> DataFrame:
    """Insert-or-replace: an incoming row replaces any earlier row with its key."""
    if existing is None:
        return keep_last(incoming, key_cols, order_cols)
    stacked = existing.withColumn("_batch", F.lit(0)).unionByName(
        incoming.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    return keep_last(stacked, key_cols, ["_batch", *order_cols]).drop("_batch")


def upsert_samples(existing, incoming, order_cols, key_cols=("raw_data_id",)) -> DataFrame:
    return upsert(existing, incoming, list(key_cols), order_cols)


def upsert_countries(existing, incoming, order_cols, key_cols=("name",)) -> DataFrame:
    return upsert(existing, incoming, list(key_cols), order_cols)


def upsert_counts(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """One row: rows handed in and rows held afterwards."""
    n_in = incoming.agg(F.count(F.lit(1)).alias("input_rows"))
    n_held = stored.agg(F.count(F.lit(1)).alias("stored_rows"))
    return n_in.select("input_rows", n_held.scalar().alias("stored_rows"))


def duplicate_keys(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def require_unique(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """The frame itself, or ConstraintError when a key repeats."""
    repeated = duplicate_keys(df, key_cols).limit(1).collect()
    if repeated:
        raise ConstraintError(f"duplicate key ({', '.join(key_cols)}): {repeated[0].asDict()}")
    return df


def append_unique(df: DataFrame, path: str, key_cols: list[str]) -> DataFrame:
    """Append to a stored table whose key must stay unique; ConstraintError before anything is written.

    The keys are checked among the new rows and against the stored ones.
    """
    spark = df.sparkSession
    fresh = cut_lineage(require_unique(df, key_cols))
    if stored_table_exists(spark, path):
        known = spark.read.parquet(path).select(*key_cols)
        clash = fresh.select(*key_cols).join(known, key_cols, "left_semi").limit(1).collect()
        if clash:
            raise ConstraintError(f"key already stored ({', '.join(key_cols)}): {clash[0].asDict()}")
    fresh.write.mode("append").parquet(path)
    return fresh


def stored_table_exists(spark, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def with_row_defaults(df: DataFrame, schema) -> DataFrame:
    """The columns of a stored table: absent time stamps are now, other absent columns are null."""
    stamps = {"created_at", "analysis_date", "timestamp"}
    return df.select(*[
        (F.col(f.name) if f.name in df.columns
         else F.current_timestamp() if f.name in stamps else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def replace_with_ids(
    existing: DataFrame | None, incoming: DataFrame, key_cols: list[str], order_cols: list[str],
    id_col: str = "id",
) -> DataFrame:
    """Insert-or-replace into a table with generated ids: every row that comes in, also a replacing one, gets
    a new id behind all ids that were ever given in ``existing``."""
    newest = keep_last(incoming, key_cols, order_cols)
    if existing is None:
        return surrogate_ids(newest, key_cols, 0, id_col)
    start = existing.agg(F.max(id_col).alias("m"))
    numbered = surrogate_ids(newest.drop(id_col), key_cols, start, id_col)
    kept = existing.join(newest.select(*key_cols), key_cols, "left_anti")
    return kept.unionByName(numbered, allowMissingColumns=True)


def missing_required(required: list[str], df: DataFrame):
    """Condition: some required column is null, or NaN where it is a float."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    failed = F.lit(False)
    for name in required:
        failed = failed | F.col(name).isNull()
        if name in floats:
            failed = failed | F.coalesce(F.isnan(name), F.lit(False))
    return failed


def required_columns_check(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """All rows with a flag ``rejected``."""
    required = required or schemas.REQUIRED_SAMPLE_COLUMNS
    return df.withColumn("rejected", missing_required(required, df))


def require_columns(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """The frame itself, or ConstraintError when a required value is missing."""
    required = required or schemas.REQUIRED_SAMPLE_COLUMNS
    if df.where(missing_required(required, df)).limit(1).count():
        raise ConstraintError(f"missing value in one of: {', '.join(required)}")
    return df


def enforce_columns(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """The same frame, failing when computed if a required value is missing.

    The check rides on the first required column, so it costs no pass of its own and holds as long
    as that column (the key) is used.
    """
    required = required or schemas.REQUIRED_SAMPLE_COLUMNS
    carrier = required[0]
    failure = F.raise_error(F.lit(f"missing value in one of: {', '.join(required)}"))
    kind = df.schema[carrier].dataType
    checked = F.when(missing_required(required, df), failure.cast(kind)).otherwise(F.col(carrier))
    return df.withColumn(carrier, checked)


def surrogate_ids(
    df: DataFrame, order_cols: list[str], start_after: int | DataFrame = 0, id_col: str = "id"
) -> DataFrame:
    """Consecutive integer ids in the given order, following ``start_after``.

    The rows are range-partitioned and sorted once and kept in the shared folder; an id is then the
    number of rows in the partitions before plus the position in the own one. No task sees more than
    its range. ``start_after`` may be a one-row, one-column frame (the current maximum id).
    """
    position = F.monotonically_increasing_id()
    per_partition = 1 << 33
    placed = cut_lineage(
        df.repartitionByRange(*order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", position % per_partition)
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the range exchange, so this side is as small as the partition count.
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    base = start_after.scalar() if isinstance(start_after, DataFrame) else F.lit(start_after)
    new_id = F.coalesce(base, F.lit(0)) + F.col("_before") + F.col("_pos") + 1
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(id_col, new_id.cast("long"))
        .drop("_part", "_pos", "_before")
    )


def assign_column(
    df: DataFrame, mapping: DataFrame, key_col: str, value_col: str
) -> DataFrame:
    """Keyed update: rows found in the mapping take its value, the others keep theirs.

    A key that the mapping repeats counts once, with its largest value; null keys match nothing.
    """
    fresh = mapping.groupBy(key_col).agg(F.max(value_col).alias("_new"))
    updated = df.join(fresh, key_col, "left")
    if value_col not in df.columns:
        return updated.withColumnRenamed("_new", value_col)
    return updated.withColumn(value_col, F.coalesce("_new", value_col)).drop("_new")


def scan_samples(samples: DataFrame) -> DataFrame:
    return samples.select(*[c for c in schemas.SAMPLE_COLUMNS if c in samples.columns]).orderBy("id")


def scan_countries(countries: DataFrame) -> DataFrame:
    kept = [c for c in schemas.COUNTRY_COLUMNS if c in countries.columns]
    return countries.select(*kept).orderBy("id")


def view_samples(samples: DataFrame, country_id: int | None = None, limit: int = 100) -> DataFrame:
    """First rows by id, of one country or of all."""
    chosen = samples if country_id is None else samples.where(F.col("country_id") == country_id)
    return chosen.orderBy("id").limit(limit)


def view_clusters(clusters: DataFrame, country_id: int) -> DataFrame:
    return clusters.where(F.col("country_id") == country_id).orderBy("cluster_number")


def view_country_statistics(results: DataFrame) -> DataFrame:
    return results.orderBy("country_id")


def result_rows(results: DataFrame) -> DataFrame:
    """The stored columns of result rows."""
    return results.select(
        "country_id", "sampling_method", "sample_size", "soc_mean", "soc_variance",
        "clay_fraction_mean",
    )


def table_counts(samples: DataFrame, countries: DataFrame, results: DataFrame) -> DataFrame:
    """One row: sizes of the three tables and the countries that hold samples."""
    per_country = countries.agg(
        F.count(F.lit(1)).alias("countries"),
        F.count_if(F.col("sample_count") > 0).alias("countries_with_samples"),
    )
    n_samples = samples.agg(F.count(F.lit(1)).alias("n"))
    n_results = results.agg(F.count(F.lit(1)).alias("n"))
    return per_country.select(
        n_samples.scalar().alias("soil_samples"),
        "countries",
        n_results.scalar().alias("analysis_results"),
        "countries_with_samples",
    )


def referential_check(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    known = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")
