"""Bronze -> silver job: conform the meter feeds, gate on data quality,
publish the silver fact and the asset dimension, record lineage.

The fact is written once to a staging path; the quality rules are
evaluated on that columnar copy (so the raw JSON is parsed only once), and
the copy is published only when every rule passes. A failing gate leaves
the published silver table untouched. With a quarantine, rows that break a
row rule are written there with the rules they broke, and the others are
published: accepted + rejected = input.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterflow.operators import lineage, quality
from meterflow.operators.conform import dim_asset, fct_meter_readings
from meterflow.session import apply_runtime_conf
from meterflow.sources import bronze, tables


@dataclass(frozen=True)
class BronzePaths:
    sensus: str | None
    itron: str | None
    asset_master: str | None
    multiline: bool = False
    feed_format: str = "json"  # meter feeds as "json" or "csv"


def run_bronze_to_silver(
    spark: SparkSession,
    src: BronzePaths,
    silver_dir: str,
    rules: list[quality.Rule] | None = None,
    fmt: str = "parquet",
    lineage_path: str | None = None,
    partition_by_date: bool = True,
    cluster_days: bool = False,
    quarantine_path: str | None = None,
) -> DataFrame:
    """Run the job; return the quality report (raises DataQualityError on failure).

    ``quarantine_path``: rows that break a row rule go there (all of it is
    replaced by each run); rules on columns or keys still stop the job.

    ``cluster_days``: for bronze files that mix many days (backfills), range
    partition by (reading_date, hash of the reading) before the write, so
    each task writes few day folders. The hash makes every key distinct, so
    even a hot meter on a hot day is split evenly across tasks. This costs
    one shuffle, so it is off by default: bronze normally lands per day.
    """
    apply_runtime_conf(spark)
    sensus = bronze.read_feed(spark, src.sensus, "sensus", src.feed_format, src.multiline) if src.sensus else None
    itron = bronze.read_feed(spark, src.itron, "itron", src.feed_format, src.multiline) if src.itron else None
    # The write of the staged copy counts the rows of both feeds on its way.
    seen = {n: Observation(n) for n, f in (("sensus", sensus), ("itron", itron)) if f is not None and not cluster_days}
    feeds = [f.observe(seen[n], F.count(F.lit(1)).alias("rows")) if n in seen else f for n, f in (("sensus", sensus), ("itron", itron))]
    fact = fct_meter_readings(*feeds)
    parts = None
    if partition_by_date:
        # Daily partitions: a gold refresh of some days reads only those days.
        fact = fact.withColumn("reading_date", F.to_date("reading_ts"))
        parts = ["reading_date"]
        if cluster_days:
            fact = fact.repartitionByRange(
                "reading_date", F.xxhash64("meter_id", "reading_timestamp", "consumption_kl"))
    fact_path = f"{silver_dir.rstrip('/')}/fct_meter_readings"
    tables.check_schema(spark, fact, fact_path, fmt)
    rules = rules or quality.reading_rules()
    stage = tables.stage_table(fact, fact_path, fmt, parts)
    try:
        staged = tables.read_table(spark, stage, "parquet" if fmt in tables.LOG_FORMATS else fmt)
        row_rules = frozenset(r.name for r in rules if r.violation() is not None) if quarantine_path else frozenset()
        report = quality.gate(quality.evaluate(staged, rules), row_rules)
        outcome = {r.rule: r for r in report.collect()}
        total = max((r.checked for r in outcome.values()), default=0)
        if any(not r.success for r in outcome.values()):
            accepted, rejected = quality.split_clean(staged, rules)
            tables.write_table(rejected.drop("reading_date"), quarantine_path, fmt, overwrite_schema=True)
            kept = Observation("accepted")
            tables.write_table(accepted.observe(kept, F.count(F.lit(1)).alias("rows")), fact_path, fmt, partition_by=parts)
            total = kept.get["rows"]
            tables.discard(spark, stage)
        else:
            if quarantine_path:
                empty = quality.split_clean(staged, rules)[1].where("false")
                tables.write_table(empty.drop("reading_date"), quarantine_path, fmt, overwrite_schema=True)
            tables.publish(spark, stage, fact_path, fmt, parts)
    except tables.PublishError:
        raise  # names where the new data is
    except Exception:
        tables.discard(spark, stage)
        raise

    sources = {"sensus": "bronze.smart-meter.sensus_readings", "itron": "bronze.smart-meter.itron_readings"}
    datasets: dict[str, DataFrame | int] = {"silver.fct_meter_readings": total}
    for name, feed in (("sensus", sensus), ("itron", itron)):
        if feed is not None:
            datasets[sources[name]] = seen[name].get["rows"] if name in seen else feed
    edges = [e for e in lineage.BRONZE_TO_SILVER if e[1] == "silver.fct_meter_readings"]
    if src.asset_master:
        dim_path, dims = f"{silver_dir.rstrip('/')}/dim_asset", Observation("dims")
        master = bronze.read_asset_master(spark, src.asset_master, src.multiline).observe(dims, F.count(F.lit(1)).alias("rows"))
        tables.write_table(dim_asset(master), dim_path, fmt, overwrite_schema=True)
        datasets |= {"silver.dim_asset": dims.get["rows"], "bronze.asset.asset_master_data": dims.get["rows"]}
        edges += [e for e in lineage.BRONZE_TO_SILVER if e[1] == "silver.dim_asset"]
    if lineage_path:
        lineage.record_lineage(
            lambda: lineage.lineage_edges(spark, edges, datasets, run_ts=dt.datetime.now(dt.timezone.utc)
                                          .replace(tzinfo=None)), lineage_path)
    return report
