"""Bronze -> silver conform.

Each feed is projected onto the silver reading shape, the feeds are unioned
by name, and the text timestamp is parsed once into ``reading_ts``
(TIMESTAMP_NTZ, UTC wall clock). Projections are narrow: Catalyst prunes the
unused JSON / Parquet columns, nested ones included.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.time import parse_utc_timestamp
from meterflow.params import M3_TO_KL

READING_COLUMNS = ["meter_id", "reading_timestamp", "consumption_kl"]


def conform_sensus(bronze: DataFrame) -> DataFrame:
    """Un-nest the sensus feed."""
    return bronze.select(
        F.col("meter_id"),
        F.col("timestamp_utc").alias("reading_timestamp"),
        F.col("reading_data.flow_kl").cast("double").alias("consumption_kl"),
    )


def conform_itron(bronze: DataFrame, m3_to_kl: float = M3_TO_KL) -> DataFrame:
    """Rename the flat feed; convert m3 -> kL."""
    v = F.col("consumption_m3").cast("double")
    return bronze.select(
        F.col("itron_device_id").alias("meter_id"),
        F.col("read_datetime").alias("reading_timestamp"),
        (v if m3_to_kl == 1.0 else v * F.lit(m3_to_kl)).alias("consumption_kl"),
    )


def union_readings(*conformed: DataFrame) -> DataFrame:
    """UNION ALL by column name; duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), [c.select(*READING_COLUMNS) for c in conformed])


def with_reading_ts(readings: DataFrame) -> DataFrame:
    """Parse ``reading_timestamp`` text into ``reading_ts`` (UTC, NTZ)."""
    return readings.withColumn("reading_ts", parse_utc_timestamp(F.col("reading_timestamp")))


def fct_meter_readings(sensus: DataFrame | None = None, itron: DataFrame | None = None,
                       *extra_flat: DataFrame) -> DataFrame:
    """Silver fact from raw feeds: conform, union, parse the timestamp.

    Columns: meter_id, reading_timestamp (source text), reading_ts, consumption_kl.
    """
    parts = []
    if sensus is not None:
        parts.append(conform_sensus(sensus))
    if itron is not None:
        parts.append(conform_itron(itron))
    parts.extend(conform_itron(x) for x in extra_flat)
    if not parts:
        raise ValueError("no feed given")
    return with_reading_ts(union_readings(*parts)).select(
        "meter_id", "reading_timestamp", "reading_ts", "consumption_kl"
    )


def dim_asset(asset_master: DataFrame) -> DataFrame:
    """Flatten the asset master to 8 columns; dates parsed to DATE."""
    return asset_master.select(
        F.col("asset_id"),
        F.col("asset_type"),
        F.col("install_date").try_cast("date").alias("install_date"),
        F.col("last_maintenance_date").try_cast("date").alias("last_maintenance_date"),
        F.col("manufacturer"),
        F.col("model_number"),
        F.col("location.latitude").alias("latitude"),
        F.col("location.longitude").alias("longitude"),
    )
