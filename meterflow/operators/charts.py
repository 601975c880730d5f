"""Report datasets.

The original computed these in pandas after collecting whole tables to the
driver. Here each is a Spark aggregation whose result is small (bounded by
the number of groups, bins, months or weekday-hours) and is the only thing a
caller ever needs to collect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.measures import exact_mean, exact_ratio, ratio
from meterflow.functions.time import hour_of_day, month_start, weekday_name
from meterflow.params import AgeBins

HOURS = list(range(24))


def sorted_small(df: DataFrame, *cols) -> DataFrame:
    """Sort a result whose size is bounded by construction (weekday-hours,
    bins, months, asset types): the aggregated rows are gathered into one
    partition and sorted there. This skips the sampling job a global
    ``orderBy`` (range partitioning) would run; the upstream aggregation
    keeps its parallelism. Not for results that grow with the data.
    """
    return df.repartition(1).sortWithinPartitions(*cols)


def failures_by_type(features: DataFrame) -> DataFrame:
    """A2: number of failed assets per asset type."""
    return (
        features.where(F.col("failure_event") == 1)
        .groupBy("asset_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .transform(lambda d: sorted_small(d, "asset_type"))
    )


def monthly_nrw(summary: DataFrame, decimals: int | None = None) -> DataFrame:
    """Unweighted mean of daily-district NRW % per calendar month."""
    return (
        summary.groupBy(F.date_format(month_start("report_date"), "yyyy-MM-dd").alias("month"))
        .agg(exact_mean("nrw_percent", decimals).alias("nrw_percent"))
        .transform(lambda d: sorted_small(d, "month"))
    )


def nrw_by_weekday(summary: DataFrame, decimals: int | None = None) -> DataFrame:
    """Mean NRW % by weekday name (rows in alphabetical order, as pandas sorts)."""
    return (
        summary.groupBy(weekday_name(F.col("report_date").cast("date")).alias("day_of_week"))
        .agg(exact_mean("nrw_percent", decimals).alias("nrw_percent"))
        .transform(lambda d: sorted_small(d, "day_of_week"))
    )


def hourly_cells(readings: DataFrame, decimals: int | None = None) -> DataFrame:
    """Mean consumption per (weekday, hour of day), unsorted (at most 168 rows)."""
    return readings.groupBy(
        weekday_name("reading_ts").alias("day_of_week"), hour_of_day("reading_ts").alias("hour")
    ).agg(exact_mean("consumption_kl", decimals, scale=4).alias("consumption_kl"))


def hourly_profile(readings: DataFrame, decimals: int | None = None) -> DataFrame:
    """Mean consumption per (weekday, hour of day), sorted."""
    return sorted_small(hourly_cells(readings, decimals), "day_of_week", "hour")


def hourly_heatmap(readings: DataFrame, decimals: int | None = None) -> DataFrame:
    """A5: weekday x hour matrix, columns h00..h23; a missing cell is NULL.

    The heavy step is the (weekday, hour) aggregation; the pivot then runs
    over at most 168 rows. The explicit hour list avoids a distinct pass and
    always yields 24 columns.
    """
    prof = hourly_cells(readings, decimals)
    wide = prof.groupBy("day_of_week").pivot("hour", HOURS).agg(F.first("consumption_kl"))
    out = wide.select("day_of_week", *[F.col(str(h)).alias(f"h{h:02d}") for h in HOURS])
    return sorted_small(out, "day_of_week")


def age_group(age: str = "asset_age_days", bins: AgeBins = AgeBins()):
    """Label of the half-open bin [lo, hi) holding ``age``; NULL outside all bins."""
    c = F.col(age)
    expr = None
    for lo, hi, label in bins.ranges():
        cond = (c >= lo) & (c < hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def with_age_group(features: DataFrame, bins: AgeBins = AgeBins()) -> DataFrame:
    return features.withColumn("age_group", age_group("asset_age_days", bins))


def failure_rate_by_age(features: DataFrame, bins: AgeBins = AgeBins(),
                        decimals: int | None = None) -> DataFrame:
    """Per age bin: total assets, failures, rate; empty bins kept (rate NULL).

    The bins are a small fixed list, so one global aggregate computes a
    conditional count and sum per bin: each task combines its rows into one
    partial row, and no data is hash-shuffled. ``inline`` then turns the
    single result row into one row per bin, in bin order in one partition.
    Empty bins come out with 0 assets. Counts follow pandas:
    ``total_assets`` counts non-NULL labels.
    """
    age = F.col("asset_age_days")
    fe = F.col("failure_event").cast("int")
    aggs = []
    for i, (lo, hi, _) in enumerate(bins.ranges()):
        in_bin = (age >= lo) & (age < hi)
        aggs += [F.count(F.when(in_bin, fe)).alias(f"n{i}"), F.sum(F.when(in_bin, fe)).alias(f"s{i}")]
    per_bin = features.agg(*aggs).select(F.inline(F.array(*[
        F.struct(
            F.lit(i).alias("bin_order"),
            F.lit(label).alias("age_group"),
            F.col(f"n{i}").alias("total_assets"),
            F.coalesce(F.col(f"s{i}"), F.lit(0)).cast("long").alias("failures"),
        )
        for i, label in enumerate(bins.labels)
    ])))
    rate = (ratio("failures", "total_assets") if decimals is None
            else exact_ratio(F.col("failures"), F.col("total_assets"), decimals))
    return per_bin.withColumn("failure_rate", rate)


def histogram(df: DataFrame, col: str, width: float, by: list[str] | None = None) -> DataFrame:
    """Equal-width histogram: bin_start, bin_end, count (NULL / NaN skipped)."""
    x = F.col(col).cast("double")
    b = F.floor(x / F.lit(float(width))).cast("long")
    keys = list(by or [])
    binned = df.where(x.isNotNull() & ~F.isnan(x)).select(*keys, b.alias("bin"))
    out = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("count"))
    return out.select(
        *keys,
        (F.col("bin") * F.lit(float(width))).alias("bin_start"),
        ((F.col("bin") + 1) * F.lit(float(width))).alias("bin_end"),
        "count",
    ).orderBy(*keys, "bin_start")  # bin count depends on the data range: global sort


def asset_age_histogram(features: DataFrame, width_days: int = 365) -> DataFrame:
    """Age histogram faceted by failure_event."""
    return histogram(features, "asset_age_days", width_days, by=["failure_event"])


def consumption_histogram(readings: DataFrame, width_kl: float = 10.0) -> DataFrame:
    """Distribution of reading volumes."""
    return histogram(readings, "consumption_kl", width_kl)
