"""Explicit schemas for the bronze feeds (no inference pass over raw files)."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

SENSUS = StructType(
    [
        StructField("meter_id", StringType()),
        StructField("timestamp_utc", StringType()),
        StructField("reading_data", StructType([StructField("flow_kl", DoubleType())])),
    ]
)

ITRON = StructType(
    [
        StructField("itron_device_id", StringType()),
        StructField("read_datetime", StringType()),
        StructField("consumption_m3", DoubleType()),
    ]
)

ASSET_MASTER = StructType(
    [
        StructField("asset_id", StringType()),
        StructField("asset_type", StringType()),
        StructField("install_date", StringType()),
        StructField("last_maintenance_date", StringType()),
        StructField("manufacturer", StringType()),
        StructField("model_number", StringType()),
        StructField(
            "location",
            StructType(
                [
                    StructField("latitude", DoubleType()),
                    StructField("longitude", DoubleType()),
                ]
            ),
        ),
    ]
)

MAINTENANCE_LOG = StructType(
    [
        StructField("asset_id", StringType()),
        StructField("install_date", DateType()),
        StructField("asset_type", StringType()),
        StructField("material", StringType()),
        StructField("last_maintenance_date", DateType()),
        StructField("failure_event", IntegerType()),
    ]
)

# Silver fact after conform: one row per reading (source text kept next to
# the parsed UTC timestamp).
SILVER_READINGS = StructType(
    [
        StructField("meter_id", StringType()),
        StructField("reading_timestamp", StringType()),
        StructField("consumption_kl", DoubleType()),
        StructField("reading_ts", TimestampNTZType()),
    ]
)

# The silver fact as stored: partitioned by reading_date.
SILVER_READINGS_BY_DATE = StructType(SILVER_READINGS.fields + [StructField("reading_date", DateType())])
