"""Silver -> gold job: the daily NRW summary and the asset feature table.

Gold NRW is partitioned by report_date. ``refresh_days`` limits a run to
the days that received readings (dynamic partition overwrite): every other
day stays as stored, so a daily refresh costs one day of data, not the
whole history.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterflow.operators import lineage
from meterflow.operators.assets import asset_failure_features
from meterflow.operators.nrw import documented_summary, nrw_daily_summary
from meterflow.session import apply_runtime_conf
from meterflow.sources import bronze, tables


def failure_rule_by_hash(share: float = 0.05) -> Column:
    """Reproducible stand-in for ``rand() > 0.95``, for callers that ask for made-up labels."""
    return F.pmod(F.xxhash64(F.col("asset_id")), F.lit(10_000)) < F.lit(int(round(share * 10_000)))


def run_silver_to_gold(
    spark: SparkSession,
    silver_dir: str,
    gold_dir: str,
    maintenance_log: str | None = None,
    as_of: dt.date | str | None = None,
    billing_rule: Column | None = None,
    refresh_days: tuple[str, str] | None = None,
    fmt: str = "parquet",
    lineage_path: str | None = None,
    districts: DataFrame | None = None,
    failure_rule: Column | None = None,
) -> dict[str, str]:
    """Build and publish both gold products; returns their paths.

    The failure label comes from the maintenance log or from an explicit
    ``failure_rule``; without either this raises before anything is written.
    ``refresh_days`` (first, last; both needed) also recomputes the readings
    without a date, which a full run keeps as a group of their own.

    With ``districts`` (district_id, district_name, region_name) the summary
    is published with every documented column: district id and name plus
    the apparent / real loss split.
    """
    if maintenance_log is None and failure_rule is None:
        raise ValueError("the failure label needs a maintenance log or an explicit failure_rule")
    if refresh_days is not None and not all(refresh_days):
        raise ValueError("refresh_days needs the first and the last day")
    apply_runtime_conf(spark)

    def shape(summary: DataFrame) -> DataFrame:
        return summary if districts is None else documented_summary(summary, districts)
    silver, gold = silver_dir.rstrip("/"), gold_dir.rstrip("/")
    rows = F.count(F.lit(1)).alias("rows")
    seen = {n: Observation(n) for n in ("fact", "summary", "dim", "features")}
    fact = tables.read_table(spark, f"{silver}/fct_meter_readings", fmt)
    nrw_path, feat_path = f"{gold}/nrw_daily_summary", f"{gold}/asset_failure_features"

    # The summary has (days x districts) rows: cluster it by day before the
    # partitioned write so each day is one file, not one file per shuffle
    # task. A day holds only its districts' rows, so this cannot skew.
    if refresh_days:
        lo, hi = refresh_days
        # A date-partitioned silver fact prunes to the refreshed days.
        day = F.col("reading_date") if "reading_date" in fact.columns else F.to_date("reading_ts")
        part = fact.where(day.isNull() | day.between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
        summary = shape(nrw_daily_summary(part.observe(seen["fact"], rows), billing_rule)).repartition("report_date")
        summary = summary.observe(seen["summary"], rows)
        tables.refresh_partitions(summary, nrw_path, "report_date", fmt)
    else:
        summary = shape(nrw_daily_summary(fact.observe(seen["fact"], rows), billing_rule)).repartition("report_date")
        summary = summary.observe(seen["summary"], rows)
        tables.write_table(summary, nrw_path, fmt, partition_by=["report_date"])

    dim = tables.read_table(spark, f"{silver}/dim_asset", fmt)
    log: DataFrame | None = bronze.read_maintenance_log(spark, maintenance_log) if maintenance_log else None
    feats = asset_failure_features(dim.observe(seen["dim"], rows), log, as_of, rule=None if log is not None else failure_rule)
    tables.write_table(feats.observe(seen["features"], rows), feat_path, fmt)

    if lineage_path:
        names = {"fact": "silver.fct_meter_readings", "summary": "gold.nrw_daily_summary",
                 "dim": "silver.dim_asset", "features": "gold.asset_failure_features"}
        lineage.record_lineage(lambda: lineage.lineage_edges(
            spark, lineage.SILVER_TO_GOLD, {names[n]: o.get["rows"] for n, o in seen.items()},
            run_ts=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)), lineage_path)
    return {"nrw_daily_summary": nrw_path, "asset_failure_features": feat_path}


def run_feature_snapshot(
    spark: SparkSession,
    silver_dir: str,
    gold_dir: str,
    maintenance_log: str,
    sensors: DataFrame,
    snapshot_date: dt.date | str,
    fmt: str = "parquet",
) -> str:
    """The documented feature table at one snapshot date, kept as history.

    ``gold/asset_feature_snapshots`` is partitioned by snapshot_date. Each
    (weekly) run replaces only its own date (dynamic partition overwrite),
    so earlier snapshots stay as they were and re-running a date is
    idempotent. ``sensors``: asset_id, reading_ts, sensor, value.
    """
    from meterflow.operators.sensors import asset_feature_snapshot

    dim = tables.read_table(spark, f"{silver_dir.rstrip('/')}/dim_asset", fmt)
    log = bronze.read_maintenance_log(spark, maintenance_log)
    # A partition value that is a date is read back as one.
    snap = asset_feature_snapshot(dim, log, sensors, snapshot_date).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))
    path = f"{gold_dir.rstrip('/')}/asset_feature_snapshots"
    tables.refresh_partitions(snap.repartition("snapshot_date"), path, "snapshot_date", fmt)
    return path
