"""Demand forecast by least squares on a trend and harmonics of the week and the day.

Readings become one row per (district, hour) first, combined map-side, so all
that follows depends on districts and hours and not on the number of readings.
The normal equations of all districts come from one aggregate of outer
products; each district's small system is solved by elimination on arrays in
the JVM. Nothing is gathered on the driver and no grouped Python runs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.measures import exact_sum_units, units_to_volume
from meterflow.functions.rules import district_of

HOURS_A_WEEK = 168

#: Harmonics of the day and of the week. The seventh of the week would be the first of the day.
DAILY, WEEKLY = 3, 2

#: A term whose share not explained by the terms before it is below this has no coefficient of its own.
TOLERANCE = 1e-9


def frequencies(daily: int = DAILY, weekly: int = WEEKLY) -> list[int]:
    """Cycles a week of the harmonics, in the order of their coefficients."""
    if not (0 <= weekly <= 6 and 0 <= daily <= 11):
        raise ValueError("weekly must be 0 to 6 and daily 0 to 11: others repeat a term")
    return [7 * k for k in range(1, daily + 1)] + list(range(1, weekly + 1))


def demand_series(readings: DataFrame) -> DataFrame:
    """district, at (hours since 1970), demand_kl: the volume of every hour of a district that has a reading.

    Readings without a time or a meter, and volumes that can't be summed (see
    ``rejected_readings``), belong to no hour; an hour with no others is absent.
    """
    at = F.unix_date(F.to_date("reading_ts")).cast("long") * 24 + F.hour("reading_ts")
    return readings.where("reading_ts is not null and meter_id is not null").groupBy(
        district_of("meter_id").alias("district"), at.alias("at")).agg(exact_sum_units("consumption_kl").alias("units")).where(
        "units is not null").select("district", "at", units_to_volume("units").alias("demand_kl"))


def terms(at: Column, first: Column, daily: int = DAILY, weekly: int = WEEKLY) -> list[Column]:
    """Constant, trend (weeks since ``first``), then cosine and sine of every harmonic."""
    found = [F.lit(1.0), (at - first) / float(HOURS_A_WEEK)]
    for f in frequencies(daily, weekly):
        angle = F.pmod(at, F.lit(HOURS_A_WEEK)) * (2 * math.pi * f / HOURS_A_WEEK)
        found += [F.cos(angle), F.sin(angle)]
    return found


def solved(system: Column, size: int) -> Column:
    """The solution of symmetric positive semi-definite equations, by elimination on arrays.

    ``system`` is an array of ``size`` rows, each of the row's coefficients and
    its right side. A term that depends on the terms before it gets 0.
    """
    own = F.transform(system, lambda row, i: F.element_at(row, i + 1))

    def step(rows: Column, k: Column) -> Column:
        at, top = k + 1, F.element_at(rows, k + 1)
        pivot = F.element_at(top, at)
        cleared = F.transform(rows, lambda row, i: F.when(i == k, F.transform(top, lambda v: v / pivot)).otherwise(
            F.zip_with(row, top, lambda v, t: v - t * (F.element_at(row, at) / pivot))))
        return F.when(pivot > F.element_at(own, at) * TOLERANCE, cleared).otherwise(rows)

    done = F.aggregate(F.array(*[F.lit(k) for k in range(size)]), system, step)
    # The diagonal is 1 where a term was used and next to 0 elsewhere.
    return F.transform(done, lambda row, i: F.when(F.element_at(row, i + 1) > 0.5, F.element_at(row, F.lit(size + 1))).otherwise(0.0))


def harmonic_fit(series: DataFrame, daily: int = DAILY, weekly: int = WEEKLY) -> DataFrame:
    """district, first, last (hours), hours and coefficients (array, in the order of ``terms``) of every district.

    A district with fewer hours than terms gets coefficients for the first
    terms that its hours tell apart, and 0 for the others.
    """
    ends = series.groupBy("district").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    x = terms(F.col("at"), F.col("first"), daily, weekly)
    size = len(x)
    rows = series.join(ends, "district").select("district", "first", "last", "demand_kl", *[c.alias(f"x{i}") for i, c in enumerate(x)])
    # As text: a column object for each of the many products takes longer to build than the job runs.
    sums = [F.expr(f"sum(x{i} * x{j}) AS a{i}_{j}") for i in range(size) for j in range(i, size)]
    sums += [F.expr(f"sum(x{i} * demand_kl) AS b{i}") for i in range(size)]
    normal = rows.groupBy("district", "first", "last").agg(F.count(F.lit(1)).alias("hours"), *sums)
    entries = [", ".join([f"a{min(i, j)}_{max(i, j)}" for j in range(size)] + [f"b{i}"]) for i in range(size)]
    system = F.expr("array(" + ", ".join(f"array({e})" for e in entries) + ")")
    return normal.select("district", "first", "last", "hours", system.alias("system")).select(
        "district", "first", "last", "hours", solved(F.col("system"), size).alias("coefficients"))


def predicted(at: Column, daily: int = DAILY, weekly: int = WEEKLY) -> Column:
    """Demand at an hour from the columns ``first`` and ``coefficients``; never below 0."""
    x = terms(at, F.col("first"), daily, weekly)
    total = F.lit(0.0)
    for i, c in enumerate(x):
        total = total + c * F.get("coefficients", F.lit(i))
    return F.greatest(total, F.lit(0.0))


def hour_start(at: Column) -> Column:
    """Hours since 1970 -> TIMESTAMP_NTZ."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=at.cast("int"))


def demand_forecast_harmonic(readings: DataFrame, horizon_hours: int = HOURS_A_WEEK, daily: int = DAILY, weekly: int = WEEKLY,
                             decimals: int | None = None) -> DataFrame:
    """District, forecast_ts, forecast_kl for the hours after each district's last one.

    An empty table gives no rows; a district with a single hour forecasts it.
    """
    fit = harmonic_fit(demand_series(readings), daily, weekly)
    hours = fit.select("*", F.explode(F.sequence(F.col("last") + 1, F.col("last") + horizon_hours)).alias("at"))
    value = predicted(F.col("at"), daily, weekly)
    return hours.select("district", hour_start(F.col("at")).alias("forecast_ts"),
                        (value if decimals is None else F.round(value, decimals)).alias("forecast_kl"))


def forecast_backtest(readings: DataFrame, test_weeks: int = 1, daily: int = DAILY, weekly: int = WEEKLY,
                      decimals: int | None = None) -> DataFrame:
    """The fit of all but the last ``test_weeks`` weeks of a district against those weeks, beside the naive forecast.

    One row a district: hours_fitted, hours_tested, then mean absolute and root
    mean squared error of both. The naive forecast is the mean demand of the
    same hour of the week; hours for which it has none are left out for both.
    Errors are NULL for a district without hours in both parts.
    """
    series = demand_series(readings)
    ends = series.groupBy("district").agg((F.max("at") - test_weeks * HOURS_A_WEEK).alias("until"))
    split = series.join(ends, "district").withColumn("slot", F.pmod("at", F.lit(HOURS_A_WEEK)))
    before, after = split.where("at <= until"), split.where("at > until")
    fit = harmonic_fit(before.select("district", "at", "demand_kl"), daily, weekly).select("district", "first", "hours", "coefficients")
    naive = before.groupBy("district", "slot").agg(F.avg("demand_kl").alias("naive"))
    off = predicted(F.col("at"), daily, weekly) - F.col("demand_kl")
    tested = after.join(naive, ["district", "slot"]).join(fit, "district").select(
        "district", off.alias("off"), (F.col("naive") - F.col("demand_kl")).alias("naive_off"))

    def shown(c: Column) -> Column:
        return c if decimals is None else F.round(c, decimals)

    errors = tested.groupBy("district").agg(
        F.count(F.lit(1)).alias("tested"),
        shown(F.avg(F.abs("off"))).alias("mae_kl"), shown(F.avg(F.abs("naive_off"))).alias("naive_mae_kl"),
        shown(F.sqrt(F.avg(F.col("off") * F.col("off")))).alias("rmse_kl"),
        shown(F.sqrt(F.avg(F.col("naive_off") * F.col("naive_off")))).alias("naive_rmse_kl"))
    none = F.lit(0).cast("long")
    return ends.select("district").join(fit.select("district", "hours"), "district", "left").join(errors, "district", "left").select(
        "district", F.coalesce("hours", none).alias("hours_fitted"), F.coalesce("tested", none).alias("hours_tested"),
        "mae_kl", "naive_mae_kl", "rmse_kl", "naive_rmse_kl")
