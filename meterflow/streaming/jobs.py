"""Streaming versions of the silver conform and the daily NRW summary.

Both read landed bronze files with an explicit schema (file source: new
files are picked up per micro-batch), reuse the batch operators, and write
to a Parquet file sink with a checkpoint in the shared checkpoint folder:
after an executor or driver loss the query restarts from the checkpoint and
the file sink's log keeps the output exactly-once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.functions.measures import DEFAULT_SCALE, exact_ratio, exact_sum_units, pct, units_to_volume
from meterflow.functions.rules import billed_by_hash, district_of
from meterflow.operators.conform import conform_itron, conform_sensus, union_readings, with_reading_ts
from meterflow.sources import schemas


def read_feeds(spark: SparkSession, sensus_dir: str | None, itron_dir: str | None,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming silver readings from landed JSON Lines directories."""
    def src(schema, path):
        r = spark.readStream.schema(schema)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.json(path)

    parts = []
    if sensus_dir:
        parts.append(conform_sensus(src(schemas.SENSUS, sensus_dir)))
    if itron_dir:
        parts.append(conform_itron(src(schemas.ITRON, itron_dir)))
    return with_reading_ts(union_readings(*parts))


def start_conform(spark: SparkSession, sensus_dir: str | None, itron_dir: str | None,
                  out_dir: str, checkpoint: str, available_now: bool = True, once: str | None = None) -> StreamingQuery:
    """Continuously conform landed feeds into the silver fact (append),
    partitioned by reading_date like the batch silver table. With ``once`` (a
    delay) readings sent again within it are dropped, see ``once_within``."""
    feed = read_feeds(spark, sensus_dir, itron_dir)
    feed = (once_within(feed, once) if once else feed).withColumn("reading_date", F.to_date("reading_ts"))
    q = feed.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode(
        "append").partitionBy("reading_date")
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start(out_dir)


def once_within(readings: DataFrame, delay: str) -> DataFrame:
    """Readings sent again are dropped: same meter, time text and volume within ``delay`` of event time.

    State holds a key until the watermark passes its time by ``delay``; rows
    older than that are dropped as late. Rows without a time have no place in
    event time and pass as they are. For late rows that must not be lost, use
    ``start_conform_once``.
    """
    keys = ["meter_id", "reading_timestamp", "consumption_kl"]
    timed = readings.where("reading_ts is not null")
    instant = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("reading_ts")).cast("timestamp")
    kept = timed.withColumn("event_time", instant).withWatermark("event_time", delay).dropDuplicatesWithinWatermark(keys).drop("event_time")
    return kept.unionByName(readings.where("reading_ts is null"))


def start_conform_once(spark: SparkSession, sensus_dir: str | None, itron_dir: str | None, out_dir: str, checkpoint: str,
                       available_now: bool = True) -> StreamingQuery:
    """X10a for feeds that are delivered repeatedly: each micro-batch adds only what the silver fact doesn't hold.

    Exact however late a repeat or a reading is, and idempotent: a batch that is
    run again after a crash finds its rows there.
    """
    from meterflow.plans.refresh import append_new

    q = read_feeds(spark, sensus_dir, itron_dir).writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, _: append_new(batch, out_dir))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


def daily_nrw_stream(readings: DataFrame, billing_rule: Column | None = None,
                     watermark: str = "1 hour", scale: int = DEFAULT_SCALE,
                     decimals: int | None = None) -> DataFrame:
    """Tumbling one-day windows per district with a watermark.

    Readings older than the watermark are dropped; in append mode a day is
    emitted once the watermark passes its end, so each row is final.
    Windows are aligned to UTC midnight.
    """
    rule = billing_rule if billing_rule is not None else billed_by_hash("meter_id", "reading_ts")
    # Watermarks need TIMESTAMP (an instant), not NTZ. reading_ts holds the UTC
    # wall clock: re-express it in the session zone before the cast so the
    # instant is right whatever spark.sql.session.timeZone is.
    zone = F.current_timezone()
    instant = F.convert_timezone(F.lit("UTC"), zone, F.col("reading_ts")).cast("timestamp")
    ev = readings.withColumn("event_time", instant).withWatermark("event_time", watermark)
    agg = ev.groupBy(F.window("event_time", "1 day").alias("w"),
                     district_of(F.col("meter_id")).alias("district")).agg(
        exact_sum_units("consumption_kl", scale).alias("supplied_u"),
        exact_sum_units("consumption_kl", scale, rule).alias("billed_u"),
    )
    # Windows are aligned to UTC midnight; name each by its UTC date.
    start_utc = F.convert_timezone(zone, F.lit("UTC"), F.col("w.start").cast("timestamp_ntz"))
    return agg.select(
        F.to_date(start_utc).alias("report_date"),
        "district",
        units_to_volume(F.col("supplied_u"), scale).alias("total_supplied_kl"),
        units_to_volume(F.col("billed_u"), scale).alias("total_billed_kl"),
        units_to_volume(F.col("supplied_u") - F.col("billed_u"), scale).alias("nrw_kl"),
        (pct(F.col("supplied_u") - F.col("billed_u"), F.col("supplied_u")) if decimals is None
         else exact_ratio(F.col("supplied_u") - F.col("billed_u"), F.col("supplied_u"), decimals, 2))
        .alias("nrw_percent"),
    )


def start_daily_nrw(spark: SparkSession, sensus_dir: str | None, itron_dir: str | None,
                    out_dir: str, checkpoint: str, billing_rule: Column | None = None,
                    watermark: str = "1 hour", decimals: int | None = None,
                    available_now: bool = True) -> StreamingQuery:
    """Run X10b from landed feeds into a Parquet sink (closed days only)."""
    s = daily_nrw_stream(read_feeds(spark, sensus_dir, itron_dir), billing_rule, watermark,
                         decimals=decimals)
    q = s.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start(out_dir)
