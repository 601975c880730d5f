"""Rolling sensor features (W1, W2) and the feature snapshot.

Rolling windows are computed on per-(asset, day) partial aggregates, not on
raw readings: the daily step is a map-side-combined groupBy, and the window
then sorts at most one row per asset-day. An asset holding a third of all
readings still produces only one row per day, so no task ever holds a hot
asset's raw history.

Window semantics (the documentation leaves them open): a feature "over N
days" at day D covers readings dated D-N+1 .. D, i.e. N whole UTC days
ending with D.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.measures import DEFAULT_SCALE, exact_ratio, finite, to_units, units_to_volume
from meterflow.operators.assets import (
    asset_age_days,
    days_since_maintenance,
    known_by,
    maintenance_summary,
)


def _daily(sensors: DataFrame, sensor: str) -> DataFrame:
    """Per (asset, day): sum of values in units, number of non-NULL values, max.

    An asset-day whose readings are all NULL is kept (its mean is NULL).
    """
    v = finite("value")
    u = to_units(v)  # sum and count are of the same rows
    s = sensors.where(F.col("sensor") == sensor)
    return s.groupBy("asset_id", F.to_date("reading_ts").alias("day")).agg(
        F.sum(u).alias("sum_u"),
        F.count(u).alias("n"),
        F.max(v).alias("mx"),
    )


def rolling_mean(sensors: DataFrame, sensor: str = "pressure", days: int = 30,
                 decimals: int | None = 6, out: str = "avg_pressure_30d") -> DataFrame:
    """Trailing N-day mean per asset, one row per asset-day with data."""
    d = _daily(sensors, sensor).withColumn("dn", F.unix_date("day"))
    w = Window.partitionBy("asset_id").orderBy("dn").rangeBetween(-(days - 1), 0)
    su, n = F.sum("sum_u").over(w), F.sum("n").over(w)
    mean = (F.try_divide(units_to_volume(su, DEFAULT_SCALE), n.cast("double")) if decimals is None
            else exact_ratio(su, n, decimals, -DEFAULT_SCALE))
    return d.select("asset_id", F.date_format("day", "yyyy-MM-dd").alias("report_date"), mean.alias(out))


def rolling_max(sensors: DataFrame, sensor: str = "vibration", days: int = 7,
                out: str = "max_vibration_7d") -> DataFrame:
    """Trailing N-day maximum per asset, one row per asset-day with data."""
    d = _daily(sensors, sensor).withColumn("dn", F.unix_date("day"))
    w = Window.partitionBy("asset_id").orderBy("dn").rangeBetween(-(days - 1), 0)
    return d.select(
        "asset_id", F.date_format("day", "yyyy-MM-dd").alias("report_date"),
        F.max("mx").over(w).alias(out),
    )


def sensor_snapshot(sensors: DataFrame, snapshot: dt.date | str, pressure_days: int = 30,
                    vibration_days: int = 7, decimals: int | None = 6) -> DataFrame:
    """Both features at one snapshot day: a filter plus one grouped pass."""
    snap = F.to_date(F.lit(str(snapshot)))
    day = F.to_date("reading_ts")
    in_p = (F.col("sensor") == "pressure") & (day > F.date_sub(snap, pressure_days)) & (day <= snap)
    in_v = (F.col("sensor") == "vibration") & (day > F.date_sub(snap, vibration_days)) & (day <= snap)
    lo = F.date_sub(snap, max(pressure_days, vibration_days))
    s = sensors.where((day > lo) & (day <= snap))
    v = finite("value")
    u = to_units(v)  # sum and count are of the same rows, as in the window form
    agg = s.groupBy("asset_id").agg(
        F.sum(F.when(in_p, u)).alias("p_u"),
        F.count(F.when(in_p, u)).alias("p_n"),
        F.max(F.when(in_v, v)).alias("max_vibration_7d"),
    )
    mean = (F.try_divide(units_to_volume(F.col("p_u")), F.col("p_n").cast("double")) if decimals is None
            else exact_ratio(F.col("p_u"), F.col("p_n"), decimals, -DEFAULT_SCALE))
    return agg.select("asset_id", mean.alias("avg_pressure_30d"), "max_vibration_7d")


def asset_feature_snapshot(dim: DataFrame, log: DataFrame, sensors: DataFrame,
                           snapshot: dt.date | str, decimals: int | None = 6) -> DataFrame:
    """The documented feature table (all ten columns) at one snapshot date.

    dim, the per-asset log summary (one read of the log) and the sensor
    snapshot all carry one row per asset and are joined on asset_id. Only log
    rows up to the date count, and only assets installed by then; a last
    maintenance that the master knows counts unless it is later than the date.
    """
    snap = F.to_date(F.lit(str(snapshot)))
    summary = maintenance_summary(known_by(log, snapshot)).select("asset_id", "failure_event", "material", "log_last_maintenance_date")
    installed, mastered = F.col("install_date").try_cast("date"), F.col("last_maintenance_date").try_cast("date")
    assets = dim.where(installed.isNull() | (installed <= snap)).join(summary, "asset_id", "left")
    last = F.greatest(F.when(mastered <= snap, mastered), F.col("log_last_maintenance_date").cast("date"))
    return snapshot_of(assets.withColumn("last_maintenance_date", last), sensors, snapshot, decimals)


def snapshot_of(assets: DataFrame, sensors: DataFrame, snapshot: dt.date | str, decimals: int | None = 6) -> DataFrame:
    """X5 for assets that carry their failure_event and material."""
    snap = sensor_snapshot(sensors, snapshot, decimals=decimals)
    return assets.join(snap, "asset_id", "left").select(
        "asset_id",
        F.lit(str(snapshot)).alias("snapshot_date"),
        "asset_type",
        F.date_format("install_date", "yyyy-MM-dd").alias("install_date"),
        "material",
        asset_age_days("install_date", snapshot).alias("asset_age_days"),
        "avg_pressure_30d",
        "max_vibration_7d",
        days_since_maintenance("last_maintenance_date", snapshot).alias("days_since_last_maintenance"),
        F.coalesce(F.col("failure_event"), F.lit(0)).cast("int").alias("failure_event"),
    )
