"""Point-in-time features: what was known of each asset at several past dates, and what came after.

An as-of join here is a union of events and dates and one ordered window over
both, never a range join: a date takes the last event at or before it. Nothing
after a date enters its features; the label looks only at what comes after it.

The features of several dates need no window: dates cut time into spans, and
all that a date asks of the log are greatest, least and summed values over the
spans before and after it. The log is reduced per (asset, material, span),
combined map-side, then brought to its assets, a row each. Rows are repeated
per date only after that, so no shuffle or sort holds them, and an asset has at
most a row per material and span, however many log rows it has.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.measures import DEFAULT_SCALE, exact_ratio, finite, to_units


#: What ``sensor_history`` adds.
SENSED = ["avg_pressure_30d", "max_vibration_7d"]


def as_of_join(left: DataFrame, right: DataFrame, by: list[str], left_at: str, right_at: str, values: list[str]) -> DataFrame:
    """Each left row with ``values`` of the last right row of its key at or before its time (NULL: none).

    Right rows at the same time: the one with the greatest values counts. Rows
    without a key or time match nothing. Values keep their names, so they must
    not be columns of ``left``. One shuffle of each side.
    """
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    keys = [F.col(b).alias(f"_k{i}") for i, b in enumerate(by)]
    known = F.lit(True)
    for b in [*by, right_at]:
        known = known & F.col(b).isNotNull()
    value = F.struct(*values)
    events = right.where(known).select(*keys, F.col(right_at).alias("_at"), F.lit(0).alias("_kind"), value.alias("_v"))
    asked = left.select(*keys, F.col(left_at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*left.columns).alias("_row"))
    order = Window.partitionBy(*[f"_k{i}" for i in range(len(by))]).orderBy("_at", "_kind", "_v")
    last = F.last("_v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    both = events.unionByName(asked, allowMissingColumns=True).withColumn("_last", last).where("_kind = 1")
    return both.select("_row.*", *[F.when(F.col("_at").isNotNull(), F.col(f"_last.{v}")).alias(v) for v in values])


def _dates(snapshots: list[dt.date | str]) -> Column:
    return F.array(*[F.to_date(F.lit(str(s))) for s in sorted({str(s) for s in snapshots})])


def sensor_history(sensors: DataFrame, snapshots: list[dt.date | str], pressure_days: int = 30, vibration_days: int = 7,
                   decimals: int = 6) -> DataFrame:
    """avg_pressure_30d and max_vibration_7d per asset at every date that has readings in its windows, from one pass.

    Readings are summed per (asset, day) map-side; only such days are then
    given to the dates whose windows they lie in.
    """
    day, v = F.to_date("reading_ts"), finite("value")
    u = to_units(v)
    p, x = F.col("sensor") == "pressure", F.col("sensor") == "vibration"
    widest = max(pressure_days, vibration_days)
    daily = sensors.groupBy("asset_id", day.alias("day")).agg(
        F.sum(F.when(p, u)).alias("u"), F.count(F.when(p, u)).alias("n"), F.max(F.when(x, v)).alias("mx"))
    seen = F.filter(_dates(snapshots), lambda s: (F.col("day") <= s) & (F.col("day") > F.date_sub(s, widest)))
    age = F.datediff("snapshot_date", "day")
    out = daily.select("asset_id", "day", "u", "n", "mx", F.explode(seen).alias("snapshot_date")).groupBy("asset_id", "snapshot_date").agg(
        F.sum(F.when(age < pressure_days, F.col("u"))).alias("u"), F.sum(F.when(age < pressure_days, F.col("n"))).alias("n"),
        F.max(F.when(age < vibration_days, F.col("mx"))).alias("max_vibration_7d"))
    return out.select("asset_id", "snapshot_date", exact_ratio(F.col("u"), F.col("n"), decimals, -DEFAULT_SCALE).alias("avg_pressure_30d"),
                      "max_vibration_7d")


def feature_history(dim: DataFrame, log: DataFrame, snapshots: list[dt.date | str], horizon_days: int = 90,
                    observed_until: dt.date | str | None = None, sensors: DataFrame | None = None) -> DataFrame:
    """A row for every snapshot date and asset installed by then: features up to the date, label after it.

    ``failure_within_horizon`` is 1 if the log has a failure in the
    ``horizon_days`` days after the date, 0 if it is known to have none, and
    NULL while the horizon reaches beyond ``observed_until`` (by default the
    log's last date). ``material`` is the last one named (on one day: the
    greatest). Log rows without a date are left out: they belong to no side of
    a date. Assets without an install date are in every snapshot.
    """
    if not snapshots:
        raise ValueError("give at least one snapshot date")
    day = F.col("last_maintenance_date").cast("date")
    if observed_until is None:
        observed_until = log.agg(F.max(day)).first()[0]
    until = F.lit(None if observed_until is None else str(observed_until)).cast("date")
    dates = sorted({str(d) for d in snapshots})
    # An event is known at the dates from the number of its span on.
    span = sum(((day > F.to_date(F.lit(d))).cast("int") for d in dates), F.lit(0))
    failure_day = F.when(F.col("failure_event") > 0, day)
    events = log.where(day.isNotNull()).groupBy("asset_id", "material", span.alias("span")).agg(
        F.max(day).alias("last"), F.max(failure_day).alias("failed"), F.min(failure_day).alias("next"),
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("failure_event").cast("long")), F.lit(0)).alias("f"))
    installed = F.col("install_date").try_cast("date")
    both = events.select("asset_id", F.struct("span", "material", "last", "failed", "next", "n", "f").alias("event")).unionByName(
        dim.select("asset_id", F.struct("asset_type", "manufacturer", installed.alias("installed")).alias("asset")), allowMissingColumns=True)
    found = both.groupBy("asset_id").agg(F.collect_list("event").alias("events"), F.collect_list("asset").alias("assets"))
    if sensors is not None:
        seen = sensor_history(sensors, snapshots).where("asset_id is not null").groupBy("asset_id").agg(
            F.collect_list(F.struct("snapshot_date", *SENSED)).alias("seen"))
        found = found.join(seen, "asset_id", "left")
    carry = ["asset_id", "events", *(["seen"] if sensors is not None else [])]
    asked = found.select(*carry, F.explode("assets").alias("a")).select(
        *carry, "a.*", F.posexplode(F.array(*[F.to_date(F.lit(d)) for d in dates])).alias("at", "day")).where("installed is null or installed <= day")
    asked = asked.select("*", F.filter("events", lambda e: e["span"] <= F.col("at")).alias("past"),
                         F.filter("events", lambda e: e["span"] > F.col("at")).alias("future"))

    def total(name: str) -> Column:
        return F.aggregate(F.col("past")[name], F.lit(0).cast("long"), lambda s, x: s + x)

    named = F.transform(F.filter("past", lambda e: e["material"].isNotNull()), lambda e: F.struct(e["last"], e["material"]))
    end = F.date_add("day", horizon_days)
    label = F.when(F.array_min(F.col("future")["next"]) <= end, 1).when(end <= until, 0)
    out = asked.select(
        "asset_id", F.col("day").alias("snapshot_date"), "asset_type", "manufacturer", F.array_max(named)["material"].alias("material"),
        F.datediff("day", "installed").alias("asset_age_days"), F.datediff("day", F.array_max(F.col("past")["last"])).alias("days_since_last_maintenance"),
        total("n").alias("maintenance_events"), total("f").alias("failures_to_date"),
        F.datediff("day", F.array_max(F.col("past")["failed"])).alias("days_since_last_failure"),
        label.cast("int").alias("failure_within_horizon"), *carry[2:])
    if sensors is None:
        return out
    here = F.get(F.filter("seen", lambda x: x["snapshot_date"] == F.col("snapshot_date")), F.lit(0))
    return out.withColumn("_here", here).select(*[c for c in out.columns if c != "seen"], *[F.col("_here")[c].alias(c) for c in SENSED])
