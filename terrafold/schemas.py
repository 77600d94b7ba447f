"""Declared schemas. Readers use these; nothing is inferred."""

from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType,
    TimestampType,
)

RAW_SAMPLES = StructType([
    StructField("raw_data_id", StringType()),
    StructField("longitude", DoubleType()),
    StructField("latitude", DoubleType()),
    StructField("soc_percent", StringType()),
    StructField("top_depth_cm", IntegerType()),
    StructField("bottom_depth_cm", IntegerType()),
    StructField("sampling_date", StringType()),
    StructField("lab_analysis_date", StringType()),
])

SAMPLES = StructType([
    StructField("id", LongType(), False),
    StructField("raw_data_id", StringType(), False),
    StructField("latitude", DoubleType(), False),
    StructField("longitude", DoubleType(), False),
    StructField("soc_percent", DoubleType(), False),
    StructField("soc_method", StringType()),
    StructField("top_depth_cm", IntegerType(), False),
    StructField("bottom_depth_cm", IntegerType(), False),
    StructField("sampling_date", StringType()),
    StructField("lab_analysis_date", StringType()),
    StructField("country_id", LongType()),
    StructField("cluster_id", LongType()),
    StructField("clay_fraction", DoubleType()),
    StructField("created_at", TimestampType()),
])

COUNTRIES = StructType([
    StructField("id", LongType(), False),
    StructField("name", StringType(), False),
    StructField("iso_code", StringType()),
    StructField("boundary", StringType(), False),
    StructField("sample_count", LongType()),
    StructField("created_at", TimestampType()),
])

CLUSTERS = StructType([
    StructField("id", LongType(), False),
    StructField("country_id", LongType(), False),
    StructField("cluster_number", LongType(), False),
    StructField("center_latitude", DoubleType()),
    StructField("center_longitude", DoubleType()),
    StructField("sample_count", LongType()),
    StructField("created_at", TimestampType()),
])

RESULTS = StructType([
    StructField("id", LongType(), False),
    StructField("country_id", LongType(), False),
    StructField("sampling_method", StringType()),
    StructField("sample_size", LongType()),
    StructField("soc_mean", DoubleType()),
    StructField("soc_variance", DoubleType()),
    StructField("clay_fraction_mean", DoubleType()),
    StructField("analysis_date", TimestampType()),
])

RUN_LOG = StructType([
    StructField("run_id", StringType(), False),
    StructField("stage_name", StringType(), False),
    StructField("log_level", StringType(), False),
    StructField("message", StringType(), False),
    StructField("timestamp", TimestampType()),
    StructField("duration_ms", LongType()),
    StructField("record_count", LongType()),
    StructField("error_details", StringType()),
])

COUNTRY_DUMP = StructType([
    StructField("elements", ArrayType(StructType([
        StructField("type", StringType()),
        StructField("id", LongType()),
        StructField("tags", MapType(StringType(), StringType())),
        StructField("members", ArrayType(StructType([
            StructField("type", StringType()),
            StructField("ref", LongType()),
            StructField("role", StringType()),
            StructField("geometry", ArrayType(StructType([
                StructField("lat", DoubleType()),
                StructField("lon", DoubleType()),
            ]))),
        ]))),
    ]))),
])

REQUIRED_SAMPLE_COLUMNS = [
    "raw_data_id", "latitude", "longitude", "soc_percent", "top_depth_cm", "bottom_depth_cm",
]
SAMPLE_COLUMNS = [f.name for f in SAMPLES.fields]
COUNTRY_COLUMNS = [f.name for f in COUNTRIES.fields]
