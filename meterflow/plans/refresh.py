"""Refresh that finds its own work: new files, the days they touch, and readings that were sent before.

``refresh_new_files`` keeps a manifest of the files it has taken. A run reads
only files that aren't in it, writes their readings as one load of the silver
fact, recomputes the days that this load touches and commits the manifest last.
A run that dies anywhere before the commit is repeated under the same load
number and replaces what it left. ``append_new`` adds only readings that the
silver fact doesn't hold yet, so a delivery that is landed twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.operators.conform import fct_meter_readings
from meterflow.operators.nrw import nrw_daily_summary
from meterflow.sources import bronze, schemas, tables

MANIFEST = "feed string, path string, length long, modified timestamp"

#: What makes a reading the same as one sent before.
READING = ["meter_id", "reading_timestamp", "consumption_kl"]


class LandedFileChanged(RuntimeError):
    """A file that was taken has another size or time now: landed files must not change."""


def landed_files(spark: SparkSession, folder: str, feed: str) -> DataFrame:
    """The files below a landing folder (MANIFEST columns); no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.lit(feed).alias("feed"), "path", "length", F.col("modificationTime").alias("modified")).where("length > 0")


def committed_loads(spark: SparkSession, manifest: str) -> int:
    """Loads are numbered from 0 and committed in turn; the number of committed ones."""
    done = 0
    while tables.path_exists(spark, f"{manifest.rstrip('/')}/load={done}/_SUCCESS"):
        done += 1
    return done


def taken_files(spark: SparkSession, manifest: str, loads: int) -> DataFrame:
    if not loads:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST + ", load int").parquet(manifest).where(F.col("load") < loads).drop("load")


def refresh_new_files(spark: SparkSession, feeds: dict[str, str], silver: str, gold: str, manifest: str,
                      billing_rule: Column | None = None, decimals: int | None = None,
                      before_commit: Callable[[], None] | None = None) -> list[str]:
    """Takes new files of ``feeds`` ("sensus" / "itron": landing folder) into silver and gold; returns the days it recomputed.

    Silver is ``silver/load=N/reading_date=...``, gold is partitioned by
    report_date. ``before_commit`` runs after all data is written (tests).
    """
    loads = committed_loads(spark, manifest)
    listed = reduce(DataFrame.unionByName, [landed_files(spark, folder, feed) for feed, folder in sorted(feeds.items())])
    taken = taken_files(spark, manifest, loads)
    changed = listed.join(taken.select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified")), "path").where(
        "length <> _length or modified <> _modified").limit(3).collect()
    if changed:
        raise LandedFileChanged(f"changed after they were taken: {[r.path for r in changed]}")
    new = listed.join(taken.select("path"), "path", "left_anti").select("feed", "path", "length", "modified")
    files = new.collect()  # names only; a reader needs them on the driver
    if not files:
        return []
    target = f"{silver.rstrip('/')}/load={loads}"
    # A run that died may have taken a file that has gone since: its days are recomputed too.
    days = _days(spark, target) if tables.path_exists(spark, f"{target}/_SUCCESS") else set()
    paths = {feed: [f.path for f in files if f.feed == feed] for feed in ("sensus", "itron")}
    sensus = bronze.read_sensus(spark, paths["sensus"]) if paths["sensus"] else spark.createDataFrame([], schemas.SENSUS)
    itron = bronze.read_itron(spark, paths["itron"]) if paths["itron"] else spark.createDataFrame([], schemas.ITRON)
    fact = fct_meter_readings(sensus, itron).withColumn("reading_date", F.to_date("reading_ts"))
    fact.write.mode("overwrite").partitionBy("reading_date").parquet(target)
    days |= _days(spark, target)

    stored = spark.read.schema(_silver_schema()).parquet(silver).where(F.col("load") <= loads)
    touched = F.col("reading_date").isin([d for d in days if d is not None])
    part = stored.where(touched | F.col("reading_date").isNull() if None in days else touched).drop("load", "reading_date")
    summary = nrw_daily_summary(part, billing_rule, decimals=decimals)
    tables.refresh_partitions(summary.repartition("report_date"), gold, "report_date")
    if before_commit:
        before_commit()
    spark.createDataFrame(files, MANIFEST).write.mode("overwrite").parquet(f"{manifest.rstrip('/')}/load={loads}")
    return sorted(str(d) for d in days)


def _silver_schema() -> str:
    return "meter_id string, reading_timestamp string, consumption_kl double, reading_ts timestamp_ntz, reading_date date, load int"


def _days(spark: SparkSession, load: str) -> set:
    """Days of one load: its partitions, bounded by the calendar."""
    return {r.reading_date for r in spark.read.schema(schemas.SILVER_READINGS_BY_DATE).parquet(load).select("reading_date").distinct().collect()}


def append_new(readings: DataFrame, silver: str) -> None:
    """Adds the readings (SILVER_READINGS) that the date-partitioned fact at ``silver`` doesn't hold yet, each once.

    Insert-only: the stored days that the delivery touches are compared by
    meter, time text and volume (NULLs equal), nothing is rewritten. Keys hold
    the time, so a hot meter is spread. Run again, it adds nothing.
    """
    spark = readings.sparkSession
    new = readings.select(*schemas.SILVER_READINGS.fieldNames()).withColumn("reading_date", F.to_date("reading_ts")).dropDuplicates(READING)
    if tables.path_exists(spark, silver):
        stored = spark.read.schema(schemas.SILVER_READINGS_BY_DATE).parquet(silver)
        same = reduce(lambda a, b: a & b, [new[c].eqNullSafe(stored[c]) for c in ["reading_date", *READING]])
        new = new.join(stored, same, "left_anti")
    new.write.mode("append").partitionBy("reading_date").parquet(silver)
