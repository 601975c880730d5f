"""Lineage as a table (L1-L3).

Each edge (upstream dataset -> downstream dataset, job) is recorded with the
row counts observed on both sides in the same run: the jobs pass counts that
their own writes observed, so nothing is read again; DataFrames are counted in
one job. Building and appending lineage is best effort: a failure is logged
and never fails the ETL job that produced the data.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Edges of the bronze -> silver -> gold flow.
BRONZE_TO_SILVER = [
    ("bronze.smart-meter.sensus_readings", "silver.fct_meter_readings", "bronze_to_silver"),
    ("bronze.smart-meter.itron_readings", "silver.fct_meter_readings", "bronze_to_silver"),
    ("bronze.asset.asset_master_data", "silver.dim_asset", "bronze_to_silver"),
]
SILVER_TO_GOLD = [
    ("silver.fct_meter_readings", "gold.nrw_daily_summary", "silver_to_gold"),
    ("silver.dim_asset", "gold.asset_failure_features", "silver_to_gold"),
]


def dataset_counts(datasets: dict[str, DataFrame | int]) -> DataFrame:
    """(dataset, rows) for each named count or DataFrame (counted in one job)."""
    spark = SparkSession.getActiveSession()
    known = [(k, int(v)) for k, v in datasets.items() if not isinstance(v, DataFrame)]
    parts = [spark.createDataFrame(known, "dataset string, rows long")] if known else []
    parts += [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows")
              for name, df in datasets.items() if isinstance(df, DataFrame)]
    return reduce(lambda a, b: a.unionByName(b), parts)


def lineage_edges(spark: SparkSession, edges: list[tuple[str, str, str]],
                  datasets: dict[str, DataFrame | int] | None = None,
                  run_ts: dt.datetime | None = None) -> DataFrame:
    """Edge table: upstream, downstream, job, run_ts, upstream_rows, downstream_rows."""
    e = spark.createDataFrame(edges, "upstream string, downstream string, job string")
    e = e.withColumn("run_ts", F.lit(run_ts).cast("timestamp_ntz") if run_ts else F.lit(None).cast("timestamp_ntz"))
    if not datasets:
        return e.withColumn("upstream_rows", F.lit(None).cast("long")).withColumn(
            "downstream_rows", F.lit(None).cast("long"))
    c = F.broadcast(dataset_counts(datasets))
    up = c.select(F.col("dataset").alias("upstream"), F.col("rows").alias("upstream_rows"))
    down = c.select(F.col("dataset").alias("downstream"), F.col("rows").alias("downstream_rows"))
    return e.join(up, "upstream", "left").join(down, "downstream", "left").select(
        "upstream", "downstream", "job", "run_ts", "upstream_rows", "downstream_rows")


def record_lineage(edges: DataFrame | Callable[[], DataFrame], path: str, fmt: str = "parquet") -> bool:
    """L3: append edges (or what builds them) to the lineage table; never raises."""
    try:
        (edges() if callable(edges) else edges).write.format(fmt).mode("append").save(path)
        return True
    except Exception as exc:  # noqa: BLE001 - lineage must not fail the job
        log.warning("failed to record lineage at %s: %s", path, exc)
        return False
