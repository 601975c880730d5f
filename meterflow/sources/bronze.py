"""Bronze readers: JSON feeds and CSV logs, always with an explicit schema.

JSON Lines is the default; ``multiline=True`` reads one JSON document (an
array) per file, as the original feeds were landed. A multi-line file cannot
be split, so each file becomes one task: land large feeds as JSON Lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from meterflow.sources import schemas


def read_json(
    spark: SparkSession, path: str | list[str], schema: StructType, multiline: bool = False
) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("multiLine", str(multiline).lower())
        .option("mode", "PERMISSIVE")
        .json(path)
    )


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def read_sensus(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """Nested smart-meter readings (meter_id, timestamp_utc, reading_data.flow_kl)."""
    return read_json(spark, path, schemas.SENSUS, multiline)


def read_itron(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """Flat readings (itron_device_id, read_datetime, consumption_m3)."""
    return read_json(spark, path, schemas.ITRON, multiline)


def read_asset_master(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """S3: nested asset master data."""
    return read_json(spark, path, schemas.ASSET_MASTER, multiline)


def read_maintenance_log(spark: SparkSession, path) -> DataFrame:
    """Asset maintenance log, CSV with header."""
    return read_csv(spark, path, schemas.MAINTENANCE_LOG)


# CSV landings of the meter feeds (T18: the documentation describes CSV
# bronze files, the jobs read JSON; both are accepted). The nested feed's
# CSV form carries ``flow_kl`` as a plain column and is re-nested on read,
# so both forms conform through the same code.
SENSUS_CSV = "meter_id string, timestamp_utc string, flow_kl double"


def read_sensus_csv(spark: SparkSession, path) -> DataFrame:
    from pyspark.sql import functions as F

    raw = spark.read.schema(SENSUS_CSV).option("header", "true").option("mode", "PERMISSIVE").csv(path)
    return raw.select("meter_id", "timestamp_utc", F.struct(F.col("flow_kl")).alias("reading_data"))


def read_itron_csv(spark: SparkSession, path) -> DataFrame:
    return read_csv(spark, path, schemas.ITRON)


def read_feed(spark: SparkSession, path, feed: str, fmt: str = "json", multiline: bool = False) -> DataFrame:
    """Read a meter feed (``feed`` = "sensus" | "itron") landed as JSON or CSV."""
    if fmt == "json":
        return read_sensus(spark, path, multiline) if feed == "sensus" else read_itron(spark, path, multiline)
    if fmt == "csv":
        return read_sensus_csv(spark, path) if feed == "sensus" else read_itron_csv(spark, path)
    raise ValueError(f"unsupported bronze format {fmt!r}")
