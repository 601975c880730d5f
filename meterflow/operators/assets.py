"""Asset features for predictive maintenance.

The maintenance log is reduced to one row per asset (map-side partial
aggregation, so a single asset with a third of all log rows costs no more
than any other) before it meets the dimension in a one-to-one join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.measures import exact_ratio, ratio
from meterflow.params import MAINTENANCE_OVERDUE_DAYS

FEATURE_COLUMNS = [
    "asset_id", "asset_type", "manufacturer", "asset_age_days",
    "days_since_last_maintenance", "failure_event",
]


def _as_of(as_of: dt.date | str | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.to_date(F.lit(str(as_of)))


def asset_age_days(install_date: Column | str, as_of=None) -> Column:
    """Whole days from install to the as-of date."""
    c = F.col(install_date) if isinstance(install_date, str) else install_date
    return F.datediff(_as_of(as_of), c.try_cast("date"))


def days_since_maintenance(last_date: Column | str, as_of=None) -> Column:
    """P10: days since the last maintenance; NULL when never maintained."""
    c = F.col(last_date) if isinstance(last_date, str) else last_date
    return F.datediff(_as_of(as_of), c.try_cast("date"))


def failure_summary(log: DataFrame) -> DataFrame:
    """Per asset: failure flag (any failure), latest maintenance date and
    number of log entries. One hash aggregation (fixed-width buffers)."""
    return log.groupBy("asset_id").agg(
        F.max(F.col("failure_event").cast("int")).alias("failure_event"),
        F.max("last_maintenance_date").alias("log_last_maintenance_date"),
        F.count(F.lit(1)).alias("maintenance_events"),
    )


def maintenance_summary(log: DataFrame) -> DataFrame:
    """Per asset: failure flag, material of the latest entry (ties: the
    larger name), latest maintenance date and number of entries.

    A string cannot sit in a hash-aggregation buffer, so the log is first
    reduced by a hash aggregation per (asset, material). String keys are fine
    there, and a hot asset is combined map-side. Only those few rows per
    asset reach the final, sort-based aggregate, never the raw log. The log
    is read once.
    """
    per_material = log.groupBy("asset_id", "material").agg(
        F.max("last_maintenance_date").alias("d"),
        F.max(F.col("failure_event").cast("int")).alias("f"),
        F.count(F.lit(1)).alias("n"),
    )
    return per_material.groupBy("asset_id").agg(
        F.max("f").alias("failure_event"),
        F.max(F.struct(F.col("d"), F.col("material")))["material"].alias("material"),
        F.max("d").alias("log_last_maintenance_date"),
        F.sum("n").alias("maintenance_events"),
    )


def latest_material(log: DataFrame) -> DataFrame:
    """Per asset: material of the latest log entry (see maintenance_summary)."""
    return maintenance_summary(log).select("asset_id", "material")


def known_by(log: DataFrame, as_of) -> DataFrame:
    """Log rows up to the as-of date; rows without a date can't be told apart and stay."""
    day = F.col("last_maintenance_date").cast("date")
    return log.where(day.isNull() | (day <= _as_of(as_of)))


def with_failure_label(dim: DataFrame, log: DataFrame | None = None,
                       rule: Column | None = None) -> DataFrame:
    """failure_event from the maintenance log (0 when absent).

    ``rule`` replaces the log with a row-level Column (the original job
    drew it at random; any deterministic rule can be given instead).
    """
    if log is None:
        if rule is None:
            raise ValueError("give a maintenance log or a failure rule")
        return dim.withColumn("failure_event", F.when(rule, 1).otherwise(0).cast("int"))
    s = failure_summary(log).select("asset_id", "failure_event")
    j = dim.join(s, "asset_id", "left")
    return j.withColumn("failure_event", F.coalesce(F.col("failure_event"), F.lit(0)).cast("int"))


def asset_failure_features(dim: DataFrame, log: DataFrame | None = None, as_of=None,
                           rule: Column | None = None) -> DataFrame:
    """Gold ``asset_failure_features`` (6 columns); the label is of the log up to the as-of date."""
    return feature_columns(with_failure_label(dim, known_by(log, as_of) if log is not None else None, rule), as_of)


def feature_columns(labelled: DataFrame, as_of=None) -> DataFrame:
    """P12's columns for assets that carry their failure_event."""
    return labelled.select(
        "asset_id",
        "asset_type",
        "manufacturer",
        asset_age_days("install_date", as_of).alias("asset_age_days"),
        days_since_maintenance("last_maintenance_date", as_of).alias("days_since_last_maintenance"),
        "failure_event",
    )


def asset_material(dim: DataFrame, log: DataFrame) -> DataFrame:
    """Material of each asset from its latest maintenance entry."""
    return dim.select("asset_id", "asset_type").join(latest_material(log), "asset_id", "left")


def failed_assets(features: DataFrame) -> DataFrame:
    """P19."""
    return features.where(F.col("failure_event") == 1)


def maintenance_priority(features: DataFrame, k: int = 100) -> DataFrame:
    """The k assets most in need of maintenance.

    Order: past failure first, then days since maintenance (never maintained
    counts as most overdue), then age; asset_id breaks ties. ``limit`` makes
    this a distributed top-k (TakeOrderedAndProject), never a global sort.
    """
    overdue = F.coalesce(F.col("days_since_last_maintenance"), F.lit(2**31 - 1))
    top = features.orderBy(
        F.desc("failure_event"), overdue.desc(), F.desc("asset_age_days"), F.asc("asset_id")
    ).limit(k)
    return top.select(
        "asset_id", "asset_type", "failure_event", "days_since_last_maintenance", "asset_age_days"
    )


def failure_by_condition(features: DataFrame, age_band_days: int = 1000,
                         overdue_days: int = MAINTENANCE_OVERDUE_DAYS,
                         decimals: int | None = None) -> DataFrame:
    """Failure rate by asset type, age band and overdue flag."""
    band = F.floor(F.col("asset_age_days") / F.lit(age_band_days)).cast("long")
    return (
        features.groupBy(
            "asset_type",
            (band * age_band_days).alias("age_band_start"),
            F.coalesce(F.col("days_since_last_maintenance") > overdue_days, F.lit(True)).alias("overdue"),
        )
        .agg(
            F.count(F.lit(1)).alias("total_assets"),
            F.sum("failure_event").cast("long").alias("failures"),
        )
        .withColumn("failure_rate", ratio("failures", "total_assets") if decimals is None
                    else exact_ratio(F.col("failures"), F.col("total_assets"), decimals))
    )


def readings_with_asset(readings: DataFrame, dim: DataFrame, asset_prefix: str = "MTR-",
                        max_broadcast_rows: int = 2_000_000,
                        max_broadcast_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """Each reading with the columns of its asset (left join).

    The asset key is ``asset_prefix`` + the meter's numeric suffix. The
    dimension (five columns) is broadcast only when its measured rows and
    bytes are within the bounds; otherwise it is a shuffle join, where AQE
    splits a hot meter's partition (skew join) instead of sending it to one
    task.
    """
    from meterflow.functions.rules import meter_suffix
    from meterflow.operators.joins import broadcast_if_small

    key = F.concat(F.lit(asset_prefix), meter_suffix("meter_id").cast("string"))
    side = broadcast_if_small(
        dim.select("asset_id", "asset_type", "manufacturer", "latitude", "longitude"),
        max_broadcast_rows, max_broadcast_bytes)
    return readings.withColumn("asset_id", key).join(side, "asset_id", "left")
