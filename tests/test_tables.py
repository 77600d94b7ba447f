import pytest
from pyspark.sql import functions as F

from terrafold import schemas
from terrafold.operators import tables


def test_keep_last_takes_last_in_order(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")],
                               "key string, seq int, v string")
    got = {r.key: r.v for r in tables.keep_last(df, ["key"], ["seq"]).collect()}
    assert got == {"a": "z", "b": "q"}


def test_upsert_replaces_existing_rows(spark):
    old = spark.createDataFrame([("a", 9, "old"), ("c", 1, "kept")], "key string, seq int, v string")
    new = spark.createDataFrame([("a", 1, "new"), ("b", 1, "b")], "key string, seq int, v string")
    got = {r.key: r.v for r in tables.upsert(old, new, ["key"], ["seq"]).collect()}
    assert got == {"a": "new", "b": "b", "c": "kept"}
    counts = tables.upsert_counts(new, tables.upsert(None, new, ["key"], ["seq"])).first()
    assert (counts.input_rows, counts.stored_rows) == (2, 2)


@pytest.mark.parametrize("parts", [1, 7])
def test_surrogate_ids_are_consecutive_in_order(spark, parts):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("key")).repartition(parts)
    rows = tables.surrogate_ids(df, ["key"], 50).orderBy("id").collect()
    assert [r.id for r in rows] == list(range(51, 1051))
    assert [r.key for r in rows] == sorted(r.key for r in rows)
    start = spark.range(5).agg(F.max("id").alias("m"))
    assert tables.surrogate_ids(df, ["key"], start).agg(F.min("id")).first()[0] == 5


def test_empty_start_counts_as_zero(spark):
    start = spark.range(0).agg(F.max("id").alias("m"))
    df = spark.range(3).select(F.col("id").alias("key"))
    assert sorted(r.id for r in tables.surrogate_ids(df, ["key"], start).collect()) == [1, 2, 3]


def test_required_columns(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 2.0, 3.0, 1, 2), (None, 1.0, 2.0, 3.0, 1, 2), ("c", float("nan"), 2.0, 3.0, 1, 2),
         ("d", 1.0, 2.0, 3.0, None, 2)],
        "raw_data_id string, latitude double, longitude double, soc_percent double, "
        "top_depth_cm int, bottom_depth_cm int")
    flags = [r.rejected for r in tables.required_columns_check(df).collect()]
    assert sorted(flags) == [False, True, True, True]
    with pytest.raises(tables.ConstraintError):
        tables.require_columns(df)
    assert tables.require_columns(df.where("raw_data_id = 'a'")).count() == 1


def test_duplicate_clusters_raise(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 1)], "country_id long, cluster_number long")
    with pytest.raises(tables.ConstraintError):
        tables.require_unique(df, ["country_id", "cluster_number"])


def test_assign_column_keeps_unmatched(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id long, country_id long")
    mapping = spark.createDataFrame([(1, 7)], "id long, country_id long")
    got = {r.id: r.country_id for r in tables.assign_column(df, mapping, "id", "country_id").collect()}
    assert got == {1: 7, 2: 6, 3: None}


def test_referential_check_ignores_null_keys(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id long, country_id long")
    parent = spark.createDataFrame([(1,)], "id long")
    got = tables.referential_check(child, "country_id", parent, "id").collect()
    assert [r.id for r in got] == [2]


def test_scan_orders_by_id_and_prunes(spark):
    df = spark.createDataFrame([(2, "b", 1), (1, "a", 2)], "id long, raw_data_id string, junk int")
    got = tables.scan_samples(df)
    assert got.columns == ["id", "raw_data_id"] and [r.id for r in got.collect()] == [1, 2]
    assert schemas.SAMPLE_COLUMNS[0] == "id" and len(schemas.SAMPLE_COLUMNS) == 14


def test_a_stored_key_cannot_be_appended_again(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.append_unique(rows, path, ["k"])
    with pytest.raises(tables.ConstraintError):
        tables.append_unique(spark.createDataFrame([(3, "c"), (2, "z")], "k int, v string"), path, ["k"])
    tables.append_unique(spark.createDataFrame([(3, "c")], "k int, v string"), path, ["k"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_replaced_rows_get_new_ids(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id long, k string, v int")
    new = spark.createDataFrame([("b", 21), ("c", 30), ("b", 22)], "k string, v int")
    got = {r.k: (r.id, r.v) for r in tables.replace_with_ids(old, new, ["k"], ["v"]).collect()}
    assert got == {"a": (1, 10), "b": (3, 22), "c": (4, 30)}


def test_a_mapping_with_repeated_keys_does_not_multiply_rows(spark):
    rows = spark.createDataFrame([(1, 5), (2, 6), (None, 7)], "id long, country_id long")
    twice = spark.createDataFrame([(1, 8), (1, 9), (None, 3)], "id long, country_id long")
    got = tables.assign_column(rows, twice, "id", "country_id").collect()
    assert sorted((r.id or 0, r.country_id) for r in got) == [(0, 7), (1, 9), (2, 6)]
