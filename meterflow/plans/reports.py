"""The documented SQL access to the gold tables.

The statements are the user guide's, with ``CURRENT_DATE`` replaced by an
as-of parameter (default: today) and an upper bound so an as-of date in the
past gives the 30 days ending on it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

LAST_30_DAYS = """
SELECT report_date, district_name, nrw_percent
FROM {nrw}
WHERE report_date >= DATE_SUB(coalesce(:as_of, CURRENT_DATE()), :days)
  AND report_date <= coalesce(:as_of, CURRENT_DATE())
ORDER BY report_date DESC, district_name
"""

MAINTENANCE_ATTENTION = """
SELECT asset_id, asset_type, days_since_last_maintenance
FROM {features}
WHERE days_since_last_maintenance > :min_days
ORDER BY days_since_last_maintenance DESC, asset_id
"""


def _as_of(as_of: dt.date | str | None) -> dt.date | None:
    if as_of is None or isinstance(as_of, dt.date):
        return as_of
    return dt.date.fromisoformat(str(as_of))


def last_30_days(named_summary: DataFrame, as_of: dt.date | str | None = None, days: int = 30) -> DataFrame:
    """P20 + O1: daily NRW % per district over the last ``days`` days, newest first."""
    spark = named_summary.sparkSession
    return spark.sql(LAST_30_DAYS, args={"as_of": _as_of(as_of), "days": int(days)}, nrw=named_summary)


def maintenance_attention(features: DataFrame, min_days: int = 365) -> DataFrame:
    """P21 + O2: assets not maintained for more than ``min_days`` days, most overdue first."""
    spark = features.sparkSession
    return spark.sql(MAINTENANCE_ATTENTION, args={"min_days": int(min_days)}, features=features)


def chart_datasets(summary: DataFrame, features: DataFrame, readings: DataFrame,
                   decimals: int | None = 6) -> dict[str, DataFrame]:
    """The eight report datasets (A2-A10), each a small aggregated DataFrame.

    Only these results may be collected for plotting: each is bounded by
    days x districts, months, weekdays, weekday-hours, bins or asset types.
    """
    from meterflow.operators import charts as C
    from meterflow.operators.nrw import nrw_timeseries

    return {
        "nrw_timeseries": nrw_timeseries(summary),
        "asset_age_histogram": C.asset_age_histogram(features),
        "failures_by_asset_type": C.failures_by_type(features),
        "monthly_nrw_trend": C.monthly_nrw(summary, decimals),
        "hourly_consumption_heatmap": C.hourly_heatmap(readings, decimals),
        "consumption_distribution": C.consumption_histogram(readings),
        "nrw_by_day_of_week": C.nrw_by_weekday(summary, decimals),
        "failure_rate_by_age": C.failure_rate_by_age(features, decimals=decimals),
    }


def write_chart_datasets(datasets: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """Persist each chart dataset, in as many files as its result has partitions (small ones: one)."""
    paths = {}
    for name, df in datasets.items():
        p = f"{out_dir.rstrip('/')}/{name}"
        df.write.format(fmt).mode("overwrite").save(p)
        paths[name] = p
    return paths


class ResultTooLarge(RuntimeError):
    pass


def to_pandas_bounded(df: DataFrame, max_rows: int = 100_000):
    """Bring a chart dataset to the driver, refusing anything unbounded.

    Reads at most ``max_rows + 1`` rows; raises ResultTooLarge beyond the
    bound instead of pulling a whole table into driver memory.
    """
    pdf = df.limit(max_rows + 1).toPandas()
    if len(pdf) > max_rows:
        raise ResultTooLarge(f"result has more than {max_rows} rows; aggregate it first")
    return pdf
