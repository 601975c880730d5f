"""Non-revenue water: the daily water balance per district and the reports
built on it (P4-P8, A1, X1-X4, O4, J2).

A1 is one hash aggregation with a map-side partial step: the shuffle carries
at most (days x districts) rows per map task, however skewed the meters are.
Volumes are summed as exact integers (see functions.measures).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.measures import (
    DEFAULT_SCALE,
    exact_mean,
    exact_ratio,
    exact_sum_units,
    half_up_quotient,
    pct,
    to_units,
    units_to_volume,
    volume_fault,
)
from meterflow.functions.rules import billed_by_hash, district_of
from meterflow.functions.time import report_date
from meterflow.operators.joins import broadcast_if_small
from meterflow.params import LossSplit

SUMMARY_COLUMNS = [
    "report_date", "district", "total_supplied_kl", "total_billed_kl", "nrw_kl", "nrw_percent",
]


def with_nrw_keys(readings: DataFrame, billing_rule: Column | None = None) -> DataFrame:
    """is_billed, district and report_date on each reading."""
    rule = billing_rule if billing_rule is not None else billed_by_hash("meter_id", "reading_ts")
    return readings.select(
        "*",
        F.when(rule, True).otherwise(False).alias("is_billed"),
        district_of(F.col("meter_id")).alias("district"),
        report_date(F.col("reading_ts")).alias("report_date"),
    )


def nrw_daily_summary(
    readings: DataFrame,
    billing_rule: Column | None = None,
    decimals: int | None = None,
    scale: int = DEFAULT_SCALE,
) -> DataFrame:
    """A1 + P7 + P8: gold ``nrw_daily_summary``.

    supplied = sum(consumption); billed = sum(consumption of billed readings,
    0 otherwise); nrw = supplied - billed; nrw_percent = 100 * nrw / supplied
    (NULL when supplied is 0 or NULL). report_date is a DATE. Volumes that no
    sum can take (``volume_fault``) are counted by ``rejected_readings``.
    """
    rule = billing_rule if billing_rule is not None else billed_by_hash("meter_id", "reading_ts")
    # Group on a DATE (4 bytes in the shuffle) and keep it one.
    agg = readings.groupBy(
        F.to_date("reading_ts").alias("day"), district_of(F.col("meter_id")).alias("district")
    ).agg(
        exact_sum_units("consumption_kl", scale).alias("supplied_u"),
        exact_sum_units("consumption_kl", scale, rule).alias("billed_u"),
    )
    supplied = units_to_volume(F.col("supplied_u"), scale)
    billed = units_to_volume(F.col("billed_u"), scale)
    nrw_u = F.col("supplied_u") - F.col("billed_u")
    # Rounded percentages are computed exactly from the integer sums.
    percent = (pct(nrw_u, F.col("supplied_u")) if decimals is None
               else exact_ratio(nrw_u, F.col("supplied_u"), decimals, 2))
    return agg.select(
        F.col("day").alias("report_date"),
        "district",
        supplied.alias("total_supplied_kl"),
        billed.alias("total_billed_kl"),
        units_to_volume(nrw_u, scale).alias("nrw_kl"),
        percent.alias("nrw_percent"),
    )


def rejected_readings(readings: DataFrame, scale: int = DEFAULT_SCALE) -> DataFrame:
    """Readings whose volume the daily summary leaves out or rounds, counted by day, district and fault."""
    return readings.select(
        F.to_date("reading_ts").alias("report_date"), district_of(F.col("meter_id")).alias("district"),
        volume_fault("consumption_kl", scale).alias("fault"),
    ).where("fault is not null").groupBy("report_date", "district", "fault").agg(F.count(F.lit(1)).alias("readings"))


def nrw_timeseries(summary: DataFrame) -> DataFrame:
    """A10: daily series in (report_date, district) order."""
    return summary.select("report_date", "district", "nrw_percent").orderBy(
        "report_date", "district"
    )


def with_district_name(summary: DataFrame, districts: DataFrame, max_dim_rows: int = 100_000) -> DataFrame:
    """Add district_id / district_name / region_name from a dimension.

    The dimension is broadcast only after its row count is checked.
    """
    dim = broadcast_if_small(
        districts.select("district_id", "district_name", "region_name"), max_dim_rows
    )
    return summary.join(dim, summary.district == dim.district_id, "left").select(
        "report_date",
        F.col("district").alias("district_id"),
        "district_name",
        "region_name",
        "total_supplied_kl",
        "total_billed_kl",
        "nrw_kl",
        "nrw_percent",
    )


def nrw_vs_target(
    summary: DataFrame,
    target_percent: float = 10.0,
    targets: DataFrame | None = None,
    decimals: int | None = None,
) -> DataFrame:
    """Variance of each district-day against its NRW target.

    ``targets`` (district, target_percent) overrides the single default.
    """
    if targets is not None:
        t = broadcast_if_small(targets.select("district", "target_percent"), 100_000)
        s = summary.join(t, "district", "left").withColumn(
            "target_percent", F.coalesce(F.col("target_percent"), F.lit(float(target_percent)))
        )
    else:
        s = summary.withColumn("target_percent", F.lit(float(target_percent)))
    var = F.col("nrw_percent") - F.col("target_percent")
    if decimals is not None:
        var = F.round(var, decimals)
    return s.select(
        "report_date", "district", "nrw_percent", "target_percent",
        var.alias("variance_pct"),
        (F.col("nrw_percent") > F.col("target_percent")).alias("above_target"),
    )


def loss_columns(nrw_kl: Column, split: LossSplit = LossSplit(),
                 scale: int = DEFAULT_SCALE) -> tuple[Column, Column]:
    """(apparent_loss_kl, real_loss_kl) for an NRW volume column.

    apparent = share x nrw, rounded half-up to 10^-scale kL in integer
    units; real = nrw - apparent, so the two always add up to nrw.
    """
    bp = int(round(split.apparent_share * 10_000))
    nrw_u = to_units(nrw_kl, scale)
    # Exact decimal arithmetic (no double rounding for large volumes).
    apparent_u = half_up_quotient(nrw_u.cast("decimal(38,0)") * F.lit(bp), F.lit(10_000)).cast("long")
    return (units_to_volume(apparent_u, scale).alias("apparent_loss_kl"),
            units_to_volume(nrw_u - apparent_u, scale).alias("real_loss_kl"))


def loss_split(summary: DataFrame, split: LossSplit = LossSplit(), scale: int = DEFAULT_SCALE) -> DataFrame:
    """Apparent / real loss per district-day."""
    apparent, real = loss_columns(F.col("nrw_kl"), split, scale)
    return summary.select("report_date", "district", "nrw_kl", apparent, real)


def loss_trend(split_df: DataFrame, scale: int = DEFAULT_SCALE) -> DataFrame:
    """Monthly apparent vs real loss per district."""
    month = F.date_format(F.trunc(F.col("report_date").cast("date"), "MM"), "yyyy-MM-dd")
    return split_df.groupBy(month.alias("month"), "district").agg(
        units_to_volume(F.sum(to_units("apparent_loss_kl", scale)), scale).alias("apparent_loss_kl"),
        units_to_volume(F.sum(to_units("real_loss_kl", scale)), scale).alias("real_loss_kl"),
    )


def nrw_before_after(
    summary: DataFrame, intervention: dt.date | str, decimals: int | None = None
) -> DataFrame:
    """Mean daily NRW % per district before vs on/after an intervention date."""
    d = F.to_date(F.lit(str(intervention)))
    day = F.col("report_date").cast("date")
    before = exact_mean(F.when(day < d, F.col("nrw_percent")), decimals)
    after = exact_mean(F.when(day >= d, F.col("nrw_percent")), decimals)
    out = summary.groupBy("district").agg(
        before.alias("nrw_pct_before"),
        after.alias("nrw_pct_after"),
        F.count_if(day < d).alias("days_before"),
        F.count_if(day >= d).alias("days_after"),
    )
    change = F.col("nrw_pct_after") - F.col("nrw_pct_before")
    if decimals is not None:
        change = F.round(change, decimals)
    return out.withColumn("change_pct", change)


def top_loss_districts(summary: DataFrame, k: int = 5, decimals: int | None = None,
                       scale: int = DEFAULT_SCALE) -> DataFrame:
    """The k districts with the largest NRW volume over the period.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own top k, so no global sort of the (district) aggregate is needed.
    """
    per = summary.groupBy("district").agg(
        F.sum(to_units("nrw_kl", scale)).alias("nrw_u"),
        F.sum(to_units("total_supplied_kl", scale)).alias("supplied_u"),
    )
    percent = (pct("nrw_u", "supplied_u") if decimals is None
               else exact_ratio(F.col("nrw_u"), F.col("supplied_u"), decimals, 2))
    return (
        per.select(
            "district",
            units_to_volume(F.col("nrw_u"), scale).alias("nrw_kl"),
            units_to_volume(F.col("supplied_u"), scale).alias("total_supplied_kl"),
            percent.alias("nrw_percent"),
        )
        .orderBy(F.desc("nrw_kl"), F.asc("district"))
        .limit(k)
    )


__all__ = [
    "SUMMARY_COLUMNS", "with_nrw_keys", "nrw_daily_summary", "rejected_readings", "nrw_timeseries",
    "with_district_name", "nrw_vs_target", "loss_split", "loss_trend",
    "nrw_before_after", "top_loss_districts",
]


def documented_summary(summary: DataFrame, districts: DataFrame, split: LossSplit = LossSplit(),
                       scale: int = DEFAULT_SCALE) -> DataFrame:
    """The daily summary with every documented column: report_date,
    district_id, district_name, supplied / billed / NRW volumes, NRW % and
    the apparent / real loss split (J2 + X2 in one projection)."""
    apparent, real = loss_columns(F.col("nrw_kl"), split, scale)
    return with_district_name(summary, districts).select(
        "report_date", "district_id", "district_name", "total_supplied_kl", "total_billed_kl",
        "nrw_kl", "nrw_percent", apparent, real)
