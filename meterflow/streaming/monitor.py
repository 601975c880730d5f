"""Operational monitoring of the stream: open days stay current, late and untimed rows are counted.

Each micro-batch is one aggregate per (status, day, district), written under its
batch id: a batch that is run again after a crash replaces what it wrote. A row
is ``untimed`` if its time doesn't parse, ``late`` if its day was closed by what
*earlier* batches had seen (their latest time less the delay), else
``accepted``; so a batch has the same outcome whenever it is run. Late rows are
also kept whole, for a refresh of their days. Accepted, late and untimed rows
together are the input.

A summary of all batches so far is written every ``compact_every`` batches, so
that readers and the next batch read few files however long the stream runs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.functions.measures import DEFAULT_SCALE, exact_ratio, exact_sum_units, pct, units_to_volume
from meterflow.functions.rules import billed_by_hash, district_of
from meterflow.sources.tables import path_exists
from meterflow.streaming.jobs import read_feeds

STATE = ("status string, report_date date, district string, supplied_u decimal(38,0), billed_u decimal(38,0), readings long, "
         "last_ts timestamp_ntz")
_KEYS = ["status", "report_date", "district"]


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*_KEYS).agg(
        F.sum("supplied_u").cast("decimal(38,0)").alias("supplied_u"), F.sum("billed_u").cast("decimal(38,0)").alias("billed_u"),
        F.sum("readings").alias("readings"), F.max("last_ts").alias("last_ts"))


def _compacted(spark: SparkSession, out_dir: str, before: int | None) -> int:
    """The last batch of the newest summary that is older than batch ``before``; -1: none."""
    base = f"{out_dir.rstrip('/')}/summary"
    if not path_exists(spark, base):
        return -1
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(base)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(folder)
            if s.getPath().getName().startswith("upto=") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return max((b for b in done if before is None or b < before), default=-1)


def state(spark: SparkSession, out_dir: str, before: int | None = None) -> DataFrame:
    """What batches (those before ``before``) have added up to, one row per status, day and district."""
    out = out_dir.rstrip("/")
    upto = _compacted(spark, out, before)
    parts = spark.createDataFrame([], STATE)
    if path_exists(spark, f"{out}/batches"):
        newer = spark.read.schema(STATE + ", batch_id long").parquet(f"{out}/batches").where(F.col("batch_id") > upto)
        parts = parts.unionByName((newer if before is None else newer.where(F.col("batch_id") < before)).drop("batch_id"))
    if upto >= 0:
        parts = parts.unionByName(spark.read.schema(STATE).parquet(f"{out}/summary/upto={upto}"))
    return _summed(parts)


def watermark(spark: SparkSession, out_dir: str, delay: dt.timedelta, before: int | None = None) -> dt.datetime | None:
    """The latest time seen (late rows included) less the delay."""
    last = state(spark, out_dir, before).agg(F.max("last_ts")).first()[0]
    return None if last is None else last - delay


def add_batch(batch: DataFrame, batch_id: int, out_dir: str, delay: dt.timedelta, billing_rule: Column | None = None,
              scale: int = DEFAULT_SCALE, compact_every: int = 100) -> None:
    """Classifies and adds up one micro-batch; running it again replaces its own outcome."""
    spark, out = batch.sparkSession, out_dir.rstrip("/")
    rule = billing_rule if billing_rule is not None else billed_by_hash("meter_id", "reading_ts")
    mark = watermark(spark, out, delay, batch_id)
    day = F.to_date("reading_ts")
    closed = F.lit(False) if mark is None else F.date_add(day, 1).cast("timestamp_ntz") <= F.lit(str(mark)).cast("timestamp_ntz")
    status = F.when(F.col("reading_ts").isNull(), "untimed").when(closed, "late").otherwise("accepted")
    rows = batch.withColumn("status", status)
    rows.groupBy("status", day.alias("report_date"), district_of(F.col("meter_id")).alias("district")).agg(
        exact_sum_units("consumption_kl", scale).alias("supplied_u"), exact_sum_units("consumption_kl", scale, rule).alias("billed_u"),
        F.count(F.lit(1)).alias("readings"), F.max("reading_ts").alias("last_ts"),
    ).write.mode("overwrite").parquet(f"{out}/batches/batch_id={batch_id}")
    if mark is not None:
        rows.where("status = 'late'").drop("status").write.mode("overwrite").parquet(f"{out}/late/batch_id={batch_id}")
    if compact_every and batch_id % compact_every == compact_every - 1:
        state(spark, out, batch_id + 1).coalesce(1).write.mode("overwrite").parquet(f"{out}/summary/upto={batch_id}")


def start_monitor(spark: SparkSession, sensus_dir: str | None, itron_dir: str | None, out_dir: str, checkpoint: str,
                  billing_rule: Column | None = None, delay: dt.timedelta = dt.timedelta(hours=1), available_now: bool = True,
                  max_files_per_trigger: int | None = None, compact_every: int = 100) -> StreamingQuery:
    """Follow landed feeds; ``current_days`` and ``row_counts`` read the outcome at any time."""
    feed = read_feeds(spark, sensus_dir, itron_dir, max_files_per_trigger)
    q = feed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: add_batch(batch, batch_id, out_dir, delay, billing_rule, compact_every=compact_every))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


def current_days(spark: SparkSession, out_dir: str, delay: dt.timedelta = dt.timedelta(hours=1), decimals: int | None = None,
                 scale: int = DEFAULT_SCALE) -> DataFrame:
    """The daily summary of all accepted rows so far, open days included; ``closed`` days take no more rows."""
    mark = watermark(spark, out_dir, delay)
    s, b = F.col("supplied_u"), F.col("billed_u")
    closed = F.lit(False) if mark is None else F.date_add("report_date", 1).cast("timestamp_ntz") <= F.lit(str(mark)).cast("timestamp_ntz")
    return state(spark, out_dir).where("status = 'accepted'").select(
        "report_date", "district", units_to_volume(s, scale).alias("total_supplied_kl"), units_to_volume(b, scale).alias("total_billed_kl"),
        units_to_volume(s - b, scale).alias("nrw_kl"),
        (pct(s - b, s) if decimals is None else exact_ratio(s - b, s, decimals, 2)).alias("nrw_percent"), closed.alias("closed"))


def row_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """Rows by status: accepted, late, untimed."""
    return state(spark, out_dir).groupBy("status").agg(F.sum("readings").alias("readings"))
