"""Registered queries: one per operator of the inventory, each with the
DuckDB SQL that must give the same rows (see ``oracle_sql``).

Conventions for comparable output: timestamps are rendered as
``yyyy-MM-dd HH:mm:ss.SSSSSS`` text and dates as ``yyyy-MM-dd`` text; means
and ratios are rounded to 6 decimals; volumes are exact (integer sums).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from meterflow.operators import assets as A
from meterflow.operators import charts as C
from meterflow.operators import failure_model as FM
from meterflow.operators import forecast as FC
from meterflow.operators import history as H
from meterflow.operators import repair as P
from meterflow.operators import conform as K
from meterflow.operators import lineage as L
from meterflow.operators import ml as M
from meterflow.operators import sensors as S
from meterflow.operators import nrw as N
from meterflow.operators import quality as Q
from meterflow.operators import ranking as RK
from meterflow.functions.rules import meter_suffix
from meterflow.functions.time import hour_of_day, weekday_name
from meterflow.params import ASSET_AS_OF
from meterflow.plans import inputs as I
from meterflow.plans import oracle_sql as O
from meterflow.plans import reports as R
from meterflow.plans.gold import run_silver_to_gold
from meterflow.plans.refresh import refresh_new_files
from meterflow.plans.silver import BronzePaths, run_bronze_to_silver
from meterflow.session import scratch_path
from meterflow.sources import bronze, schemas, tables
from meterflow.sources import fixtures as fx
from meterflow.streaming import jobs as ST
from meterflow.streaming import monitor as SM

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_SQL = "%Y-%m-%d %H:%M:%S.%f"


def _dates_as_text(df: DataFrame) -> DataFrame:
    """DATE columns as yyyy-MM-dd text: the operators keep dates, only the comparison wants text."""
    if not any(isinstance(f.dataType, DateType) for f in df.schema.fields):
        return df
    return df.select(*[F.date_format(f.name, "yyyy-MM-dd").alias(f.name) if isinstance(f.dataType, DateType) else f.name
                       for f in df.schema.fields])


def register(name: str, sql: str | None = None):
    """Record a query and its SQL twin.

    Queries do not change the caller's session settings: every operator
    gives the same rows under any session time zone (tests/test_zones.py),
    and write modes are passed per write.
    """
    def deco(fn: Query) -> Query:
        @wraps(fn)
        def query(spark: SparkSession, d: str) -> DataFrame:
            return _dates_as_text(fn(spark, d))

        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def ts_text(c: str) -> F.Column:
    return F.date_format(F.col(c), TS_TEXT)


def date_text(c: str) -> F.Column:
    return F.date_format(F.col(c), "yyyy-MM-dd")


# ---------------------------------------------------------------- flagship A1
@register("nrw_daily_summary", f"SELECT * FROM ({O.S_EVENTS}) s")
def q_nrw_daily_summary(spark, d):
    """A1 + P7 + P8: daily water balance per district (events feeds)."""
    return I.event_summary(spark, d)


# ------------------------------------------------------------ silver conform
@register("fct_meter_readings", f"""
  SELECT CASE WHEN coalesce(event_type IN ('click','view','purchase'), false) THEN 'SEN-' ELSE 'ITR-' END
         || CAST(user_id AS VARCHAR) AS meter_id,
         CASE WHEN coalesce(event_type IN ('click','view','purchase'), false)
              THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END
         AS reading_timestamp,
         strftime(ts, '{TS_SQL}') AS reading_ts,
         value AS consumption_kl
  FROM events""")
def q_fct_meter_readings(spark, d):
    """U1 (+P1, P2, P14): silver fact = union of both conformed feeds."""
    r = I.event_readings(spark, d)
    return r.select("meter_id", "reading_timestamp", ts_text("reading_ts").alias("reading_ts"), "consumption_kl")


@register("conform_sensus", """
  SELECT 'SEN-' || CAST(user_id AS VARCHAR) AS meter_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS reading_timestamp, value AS consumption_kl
  FROM events WHERE coalesce(event_type IN ('click','view','purchase'), false)""")
def q_conform_sensus(spark, d):
    """Un-nest the nested feed."""
    return K.conform_sensus(fx.sensus_from_events(fx.table(spark, d, "events")))


@register("conform_itron", """
  SELECT 'ITR-' || CAST(user_id AS VARCHAR) AS meter_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS reading_timestamp, value AS consumption_kl
  FROM events WHERE NOT coalesce(event_type IN ('click','view','purchase'), false)""")
def q_conform_itron(spark, d):
    """Rename the flat feed (m3 -> kL at 1:1)."""
    return K.conform_itron(fx.itron_from_events(fx.table(spark, d, "events")))


@register("reading_timestamp_utc", f"""
  SELECT meter_id, strftime(reading_ts, '{TS_SQL}') AS reading_ts_utc,
         CAST(hour(reading_ts) AS INTEGER) AS hour FROM ({O.R_EVENTS}) r""")
def q_reading_timestamp_utc(spark, d):
    """Mixed 'Z' / zoneless ISO text parsed as UTC instants."""
    r = I.event_readings(spark, d)
    return r.select("meter_id", ts_text("reading_ts").alias("reading_ts_utc"),
                    F.hour("reading_ts").alias("hour"))


@register("reading_hour_dow", f"""
  SELECT meter_id, strftime(reading_ts, '{TS_SQL}') AS reading_ts, CAST(hour(reading_ts) AS INTEGER) AS hour,
         dayname(reading_ts) AS day_of_week FROM ({O.R_EVENTS}) r""")
def q_reading_hour_dow(spark, d):
    """Hour of day and English weekday name of each reading (UTC)."""
    r = I.event_readings(spark, d)
    return r.select("meter_id", ts_text("reading_ts").alias("reading_ts"),
                    hour_of_day("reading_ts").alias("hour"), weekday_name("reading_ts").alias("day_of_week"))


@register("billed_flag", f"""
  SELECT meter_id, strftime(reading_ts, '{TS_SQL}') AS reading_ts, {O.BILLED} AS is_billed
  FROM ({O.R_EVENTS}) r""")
def q_billed_flag(spark, d):
    """Deterministic billed flag per reading."""
    k = N.with_nrw_keys(I.event_readings(spark, d), I.billing_rule())
    return k.select("meter_id", ts_text("reading_ts").alias("reading_ts"), "is_billed")


@register("meter_district", f"""
  SELECT meter_id, substr(meter_id, 1, 3) AS district FROM ({O.R_EVENTS}) r""")
def q_meter_district(spark, d):
    """P5: district = first three characters of meter_id."""
    k = N.with_nrw_keys(I.event_readings(spark, d), I.billing_rule())
    return k.select("meter_id", "district")


@register("reading_report_date", f"""
  SELECT meter_id, strftime(reading_ts, '%Y-%m-%d') AS report_date FROM ({O.R_EVENTS}) r""")
def q_reading_report_date(spark, d):
    """Report date (UTC) of each reading."""
    k = N.with_nrw_keys(I.event_readings(spark, d), I.billing_rule())
    return k.select("meter_id", "report_date")


@register("chart_nrw_timeseries", f"""
  SELECT report_date, district, nrw_percent FROM ({O.S_EVENTS}) s ORDER BY report_date, district""")
def q_chart_nrw_timeseries(spark, d):
    """A10: daily NRW % series ordered by (report_date, district)."""
    return N.nrw_timeseries(I.event_summary(spark, d))


# --------------------------------------------------------------- asset side
@register("dim_asset", f"""
  SELECT asset_id, asset_type, strftime(install_date, '%Y-%m-%d') AS install_date,
         strftime(last_maintenance_date, '%Y-%m-%d') AS last_maintenance_date,
         manufacturer, model_number, latitude, longitude
  FROM ({O.DIM_ASSET}) d""")
def q_dim_asset(spark, d):
    """Flattened asset dimension."""
    a = I.assets(spark, d)
    return a.select("asset_id", "asset_type", date_text("install_date").alias("install_date"),
                    date_text("last_maintenance_date").alias("last_maintenance_date"),
                    "manufacturer", "model_number", "latitude", "longitude")


@register("asset_age_days", f"""
  SELECT asset_id, CAST(DATE '2001-12-31' - install_date AS INTEGER) AS asset_age_days
  FROM ({O.DIM_ASSET}) d""")
def q_asset_age_days(spark, d):
    """Asset age in days at the as-of date."""
    a = I.assets(spark, d)
    return a.select("asset_id", A.asset_age_days("install_date", ASSET_AS_OF).alias("asset_age_days"))


@register("days_since_maintenance", f"""
  SELECT asset_id, CAST(DATE '2001-12-31' - last_maintenance_date AS INTEGER) AS days_since_last_maintenance
  FROM ({O.DIM_ASSET}) d""")
def q_days_since_maintenance(spark, d):
    """P10: days since last maintenance (NULL when never maintained)."""
    a = I.assets(spark, d)
    return a.select("asset_id", A.days_since_maintenance("last_maintenance_date", ASSET_AS_OF)
                    .alias("days_since_last_maintenance"))


@register("failure_label", f"SELECT asset_id, failure_event FROM ({O.FEATURES}) f")
def q_failure_label(spark, d):
    """Failure label from the maintenance log (left join, 0 when absent)."""
    return A.with_failure_label(I.assets(spark, d), I.maintenance_log(spark, d)).select(
        "asset_id", "failure_event")


@register("asset_failure_features", f"SELECT * FROM ({O.FEATURES}) f")
def q_asset_failure_features(spark, d):
    """Gold asset_failure_features."""
    return I.features(spark, d)


@register("asset_failure_features_from_log", f"SELECT * FROM ({O.FEATURES}) f")
def q_asset_failure_features_from_log(spark, d):
    """P12 from the separate asset dimension and maintenance log, as the gold job runs it."""
    return A.asset_failure_features(I.assets(spark, d), I.maintenance_log(spark, d), ASSET_AS_OF)


@register("asset_material", f"""
  SELECT d.asset_id, d.asset_type, s.material
  FROM ({O.DIM_ASSET}) d LEFT JOIN ({O.MAINT_SUMMARY}) s ON d.asset_id = s.asset_id""")
def q_asset_material(spark, d):
    """Material from the latest maintenance entry."""
    return A.asset_material(I.assets(spark, d), I.maintenance_log(spark, d))


@register("failed_assets", f"SELECT * FROM ({O.FEATURES}) f WHERE failure_event = 1")
def q_failed_assets(spark, d):
    """Assets with a failure."""
    return A.failed_assets(I.features(spark, d))


AGE_GROUP_SQL = " ".join(
    f"WHEN asset_age_days >= {lo} AND asset_age_days < {hi} THEN '{lo}-{hi}'"
    for lo, hi in zip(range(0, 1000, 100), range(100, 1001, 100))
)


@register("asset_age_group", f"""
  SELECT asset_id, asset_age_days, CASE {AGE_GROUP_SQL} END AS age_group FROM ({O.FEATURES}) f""")
def q_asset_age_group(spark, d):
    """Half-open age bins [lo, hi); NULL outside every bin."""
    return C.with_age_group(I.features(spark, d)).select("asset_id", "asset_age_days", "age_group")


# ------------------------------------------------------------------- charts
@register("chart_failures_by_type", f"""
  SELECT asset_type, count(*) AS count FROM ({O.FEATURES}) f WHERE failure_event = 1
  GROUP BY asset_type ORDER BY asset_type""")
def q_chart_failures_by_type(spark, d):
    """A2: failures per asset type."""
    return C.failures_by_type(I.features(spark, d))


def _exact_mean_sql(x: str, scale: int = 6) -> str:
    return O.exact_mean_sql(x, scale)


@register("chart_monthly_nrw", f"""
  SELECT strftime(date_trunc('month', CAST(report_date AS DATE)), '%Y-%m-%d') AS month,
         {_exact_mean_sql('nrw_percent')} AS nrw_percent
  FROM ({O.S_LINEITEM}) s GROUP BY 1 ORDER BY 1""")
def q_chart_monthly_nrw(spark, d):
    """Unweighted monthly mean of daily NRW % (long-range feed)."""
    return C.monthly_nrw(I.lineitem_summary(spark, d), decimals=6)


@register("chart_nrw_by_weekday", f"""
  SELECT dayname(CAST(report_date AS DATE)) AS day_of_week, {_exact_mean_sql('nrw_percent')} AS nrw_percent
  FROM ({O.S_LINEITEM}) s GROUP BY 1 ORDER BY 1""")
def q_chart_nrw_by_weekday(spark, d):
    """Mean NRW % by weekday name."""
    return C.nrw_by_weekday(I.lineitem_summary(spark, d), decimals=6)


HOURLY_PROFILE_SQL = f"""
  SELECT dayname(reading_ts) AS day_of_week, CAST(hour(reading_ts) AS INTEGER) AS hour,
         {_exact_mean_sql('consumption_kl', 4)} AS consumption_kl
  FROM ({O.R_EVENTS}) r GROUP BY 1, 2"""


@register("chart_hourly_profile", HOURLY_PROFILE_SQL + " ORDER BY 1, 2")
def q_chart_hourly_profile(spark, d):
    """Mean consumption per weekday and hour."""
    return C.hourly_profile(I.event_readings(spark, d), decimals=6)


@register("chart_hourly_heatmap", "SELECT day_of_week, " + ", ".join(
    f"max(CASE WHEN hour = {h} THEN consumption_kl END) AS h{h:02d}" for h in range(24)
) + f" FROM ({HOURLY_PROFILE_SQL}) p GROUP BY day_of_week ORDER BY day_of_week")
def q_chart_hourly_heatmap(spark, d):
    """A5: weekday x hour pivot (24 hour columns)."""
    return C.hourly_heatmap(I.event_readings(spark, d), decimals=6)


AGE_BINS_SQL = "VALUES " + ", ".join(
    f"({i}, '{lo}-{lo + 100}')" for i, lo in enumerate(range(0, 1000, 100)))


@register("chart_failure_rate_by_age", f"""
  WITH f AS (SELECT CASE {AGE_GROUP_SQL} END AS age_group, failure_event FROM ({O.FEATURES}) f0),
       a AS (SELECT age_group, count(failure_event) AS total_assets, sum(failure_event) AS failures
             FROM f WHERE age_group IS NOT NULL GROUP BY 1),
       b(bin_order, age_group) AS ({AGE_BINS_SQL})
  SELECT b.bin_order, b.age_group, coalesce(a.total_assets, 0) AS total_assets,
         CAST(coalesce(a.failures, 0) AS BIGINT) AS failures,
         {O.exact_ratio_sql('a.failures', 'a.total_assets', 6)} AS failure_rate
  FROM b LEFT JOIN a ON a.age_group = b.age_group ORDER BY b.bin_order""")
def q_chart_failure_rate_by_age(spark, d):
    """Failure rate per age bin, empty bins kept."""
    return C.failure_rate_by_age(I.features(spark, d), decimals=6)


@register("chart_asset_age_histogram", f"""
  SELECT failure_event, CAST(b AS DOUBLE) * 365 AS bin_start, CAST(b + 1 AS DOUBLE) * 365 AS bin_end,
         count(*) AS count
  FROM (SELECT failure_event, CAST(floor(CAST(asset_age_days AS DOUBLE) / 365) AS BIGINT) AS b
        FROM ({O.FEATURES}) f WHERE asset_age_days IS NOT NULL) x
  GROUP BY 1, b ORDER BY 1, 2""")
def q_chart_asset_age_histogram(spark, d):
    """Asset-age histogram (365-day bins) per failure status."""
    return C.asset_age_histogram(I.features(spark, d), 365)


@register("chart_consumption_histogram", f"""
  SELECT CAST(b AS DOUBLE) * 10 AS bin_start, CAST(b + 1 AS DOUBLE) * 10 AS bin_end, count(*) AS count
  FROM (SELECT CAST(floor(consumption_kl / 10) AS BIGINT) AS b FROM ({O.R_EVENTS}) r
        WHERE consumption_kl IS NOT NULL AND NOT isnan(consumption_kl)) x
  GROUP BY b ORDER BY 1""")
def q_chart_consumption_histogram(spark, d):
    """Reading-volume histogram (10 kL bins)."""
    return C.consumption_histogram(I.event_readings(spark, d), 10.0)


# ------------------------------------------------------- sources and sinks
def _events(spark, d):
    return fx.table(spark, d, "events")


@register("bronze_sensus", """
  SELECT 'SEN-' || CAST(user_id AS VARCHAR) AS meter_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp_utc, value AS flow_kl
  FROM events WHERE coalesce(event_type IN ('click','view','purchase'), false)""")
def q_bronze_sensus(spark, d):
    """Land the nested feed as JSON Lines, read it back with the schema."""
    path = fx.land_json(fx.sensus_from_events(_events(spark, d)), scratch_path(spark, "bronze-sensus"))
    b = bronze.read_sensus(spark, path)
    return b.select("meter_id", "timestamp_utc", F.col("reading_data.flow_kl").alias("flow_kl"))


@register("bronze_itron", """
  SELECT 'ITR-' || CAST(user_id AS VARCHAR) AS itron_device_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS read_datetime, value AS consumption_m3
  FROM events WHERE NOT coalesce(event_type IN ('click','view','purchase'), false)""")
def q_bronze_itron(spark, d):
    """Flat feed through JSON Lines."""
    path = fx.land_json(fx.itron_from_events(_events(spark, d)), scratch_path(spark, "bronze-itron"))
    return bronze.read_itron(spark, path)


@register("bronze_asset_master", f"""
  SELECT asset_id, asset_type, strftime(install_date, '%Y-%m-%d') AS install_date,
         strftime(last_maintenance_date, '%Y-%m-%d') AS last_maintenance_date,
         manufacturer, model_number, latitude, longitude
  FROM ({O.DIM_ASSET}) d""")
def q_bronze_asset_master(spark, d):
    """S3: nested asset master through JSON Lines (location struct kept nested on disk)."""
    master = fx.asset_master_from_orders(fx.table(spark, d, "orders"), fx.table(spark, d, "lineitem"))
    path = fx.land_json(master, scratch_path(spark, "bronze-asset-master"))
    b = bronze.read_asset_master(spark, path)
    return b.select("asset_id", "asset_type", "install_date", "last_maintenance_date", "manufacturer",
                    "model_number", F.col("location.latitude").alias("latitude"),
                    F.col("location.longitude").alias("longitude"))


@register("bronze_maintenance_log", f"""
  SELECT asset_id, strftime(install_date, '%Y-%m-%d') AS install_date, asset_type, material,
         strftime(last_maintenance_date, '%Y-%m-%d') AS last_maintenance_date, failure_event
  FROM ({O.MAINT_LOG}) m""")
def q_bronze_maintenance_log(spark, d):
    """Maintenance log through header CSV, read with an explicit schema."""
    path = fx.land_csv(I.maintenance_log(spark, d, full=True), scratch_path(spark, "bronze-maintenance"))
    b = bronze.read_maintenance_log(spark, path)
    return b.select("asset_id", date_text("install_date").alias("install_date"), "asset_type", "material",
                    date_text("last_maintenance_date").alias("last_maintenance_date"), "failure_event")


@register("roundtrip_overwrite", f"SELECT * FROM ({O.S_EVENTS}) s")
def q_roundtrip_overwrite(spark, d):
    """S5 + S6: publish the gold summary twice (checked overwrite), read it back."""
    path = scratch_path(spark, "gold-nrw")
    summary = I.event_summary(spark, d)
    tables.write_table(summary, path)
    tables.write_table(tables.read_table(spark, path), path)  # same schema: allowed, reads its own target
    return tables.read_table(spark, path)


@register("roundtrip_overwrite_schema", f"""
  SELECT asset_id, asset_type, strftime(install_date, '%Y-%m-%d') AS install_date,
         strftime(last_maintenance_date, '%Y-%m-%d') AS last_maintenance_date,
         manufacturer, model_number, latitude, longitude
  FROM ({O.DIM_ASSET}) d""")
def q_roundtrip_overwrite_schema(spark, d):
    """Replace a stored table that has another schema (overwrite_schema=True)."""
    path = scratch_path(spark, "silver-dim-asset")
    dim = I.assets(spark, d)
    tables.write_table(dim.select("asset_id", "asset_type"), path)
    tables.write_table(dim, path, overwrite_schema=True)
    t = tables.read_table(spark, path)
    return t.select("asset_id", "asset_type", date_text("install_date").alias("install_date"),
                    date_text("last_maintenance_date").alias("last_maintenance_date"),
                    "manufacturer", "model_number", "latitude", "longitude")


@register("export_csv_roundtrip", f"SELECT * FROM ({O.FEATURES}) f")
def q_export_csv_roundtrip(spark, d):
    """Export the feature table as header CSV and read the export back."""
    feats = I.features(spark, d)
    path = tables.export_csv(feats, scratch_path(spark, "export-features"))
    return tables.read_csv_export(spark, path, feats.schema)


REFRESH_FIRST_BEFORE = "2024-01-23 12:00:00"
REFRESH_FROM_DAY = "2024-01-23"


@register("incremental_refresh", f"SELECT * FROM ({O.S_EVENTS}) s")
def q_incremental_refresh(spark, d):
    """Initial load, then a refresh that rewrites only the touched days.

    The first load sees readings up to midday of one day (that day is
    partial); the refresh recomputes that day and every later one from all
    their readings. Only those partitions are replaced.
    """
    path = scratch_path(spark, "gold-nrw-partitioned")
    readings = I.event_readings(spark, d)
    rule = I.billing_rule()
    first = readings.where(F.col("reading_ts") < F.lit(REFRESH_FIRST_BEFORE).cast("timestamp_ntz"))
    day = F.to_date("reading_ts")
    later = readings.where(day.isNull() | (day >= F.lit(REFRESH_FROM_DAY).cast("date")))
    for part in (first, later):
        day_files = N.nrw_daily_summary(part, rule, decimals=6).repartition("report_date")
        tables.refresh_partitions(day_files, path, "report_date")
    schema = N.nrw_daily_summary(readings, rule, decimals=6).schema
    return tables.read_table(spark, path, schema=schema).select(*N.SUMMARY_COLUMNS)


# ------------------------------------------------------------ data quality
RANGE_MAX_KL = 250.0
READINGS_RANGE = f"(consumption_kl < 0 OR consumption_kl > {RANGE_MAX_KL} OR isnan(consumption_kl))"


def _report_sql(rows: list[str]) -> str:
    body = " UNION ALL ".join(rows)
    return (f"SELECT rule, \"column\", CAST(checked AS BIGINT) AS checked, CAST(failed AS BIGINT) AS failed, "
            f"failed = 0 AS success FROM ({body}) q")


@register("dq_not_null", _report_sql([f"""
  SELECT 'meter_id_not_null' AS rule, 'meter_id' AS "column", count(*) AS checked,
         count_if(meter_id IS NULL) AS failed FROM ({O.R_EVENTS}) r"""]))
def q_dq_not_null(spark, d):
    """Null meter ids."""
    return Q.evaluate(I.event_readings(spark, d), [Q.not_null("meter_id", name="meter_id_not_null")])


@register("dq_range", _report_sql([f"""
  SELECT 'consumption_in_range' AS rule, 'consumption_kl' AS "column", count(*) AS checked,
         count_if(coalesce({READINGS_RANGE}, false)) AS failed FROM ({O.R_EVENTS}) r"""]))
def q_dq_range(spark, d):
    """Reading volume within [0, 250] kL."""
    return Q.evaluate(I.event_readings(spark, d),
                      [Q.in_range("consumption_kl", 0.0, RANGE_MAX_KL, name="consumption_in_range")])


@register("dq_column_exists", _report_sql([f"""
  SELECT 'silver_columns' AS rule, 'meter_id,reading_timestamp,consumption_kl' AS "column",
         count(*) AS checked, CAST(0 AS BIGINT) AS failed FROM ({O.R_EVENTS}) r""", f"""
  SELECT 'reading_value_column' AS rule, 'reading_value' AS "column",
         count(*) AS checked, count(*) AS failed FROM ({O.R_EVENTS}) r"""]))
def q_dq_column_exists(spark, d):
    """D3: the silver columns exist; 'reading_value' (named by the original stub) does not."""
    return Q.evaluate(I.event_readings(spark, d), [
        Q.column_exists("meter_id", "reading_timestamp", "consumption_kl", name="silver_columns"),
        Q.column_exists("reading_value", name="reading_value_column"),
    ])


@register("dq_unique", _report_sql(["""
  SELECT 'lineitem_key_unique' AS rule, 'l_orderkey,l_linenumber' AS "column",
         CAST(sum(n) AS BIGINT) AS checked, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS failed
  FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) g"""]))
def q_dq_unique(spark, d):
    """(l_orderkey, l_linenumber) must be unique; rows in repeated keys fail."""
    return Q.evaluate(fx.table(spark, d, "lineitem"),
                      [Q.unique("l_orderkey", "l_linenumber", name="lineitem_key_unique")])


@register("dq_report", _report_sql([f"""
  SELECT 'column_exists(meter_id,reading_timestamp,consumption_kl)' AS rule,
         'meter_id,reading_timestamp,consumption_kl' AS "column", count(*) AS checked,
         CAST(0 AS BIGINT) AS failed FROM ({O.R_EVENTS}) r""", f"""
  SELECT 'meter_id_not_null', 'meter_id', count(*), count_if(meter_id IS NULL) FROM ({O.R_EVENTS}) r""", f"""
  SELECT 'consumption_not_null', 'consumption_kl', count(*), count_if(consumption_kl IS NULL) FROM ({O.R_EVENTS}) r""", f"""
  SELECT 'timestamp_parses', 'reading_timestamp', count(*), count_if(reading_ts IS NULL) FROM ({O.R_EVENTS}) r""", f"""
  SELECT 'consumption_in_range', 'consumption_kl', count(*), count_if(coalesce({READINGS_RANGE}, false))
  FROM ({O.R_EVENTS}) r""", f"""
  SELECT 'reading_unique', 'meter_id,reading_timestamp', CAST(sum(n) AS BIGINT),
         CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT)
  FROM (SELECT count(*) AS n FROM ({O.R_EVENTS}) r GROUP BY meter_id, reading_ts) g"""]))
def q_dq_report(spark, d):
    """The full report the silver gate checks (one row per rule)."""
    rules = Q.reading_rules(0.0, RANGE_MAX_KL) + [
        Q.unique("meter_id", "reading_timestamp", name="reading_unique")]
    return Q.evaluate(I.event_readings(spark, d), rules)


@register("dq_date_order", _report_sql([f"""
  SELECT 'maintenance_after_install' AS rule, 'install_date,last_maintenance_date' AS "column",
         count(*) AS checked,
         count_if(NOT coalesce(last_maintenance_date >= install_date, false)) AS failed
  FROM ({O.DIM_ASSET}) d"""]))
def q_dq_date_order(spark, d):
    """D-rule on the asset dimension: last maintenance must not precede install."""
    return Q.evaluate(I.assets(spark, d), [Q.holds(
        "last_maintenance_date >= install_date", ("install_date", "last_maintenance_date"),
        name="maintenance_after_install")])


@register("dq_clean", f"""
  SELECT meter_id, strftime(reading_ts, '{TS_SQL}') AS reading_ts, consumption_kl FROM ({O.R_EVENTS}) r
  WHERE meter_id IS NOT NULL AND reading_ts IS NOT NULL AND consumption_kl IS NOT NULL AND NOT coalesce({READINGS_RANGE}, false)""")
def q_dq_clean(spark, d):
    """Rows passing every row-level rule."""
    ok, _ = Q.split_clean(I.event_readings(spark, d), Q.reading_rules(0.0, RANGE_MAX_KL))
    return ok.select("meter_id", ts_text("reading_ts").alias("reading_ts"), "consumption_kl")


@register("dq_quarantine", f"""
  SELECT meter_id, strftime(reading_ts, '{TS_SQL}') AS reading_ts, consumption_kl,
         concat_ws(',', CASE WHEN meter_id IS NULL THEN 'meter_id_not_null' END,
                        CASE WHEN consumption_kl IS NULL THEN 'consumption_not_null' END,
                        CASE WHEN reading_ts IS NULL THEN 'timestamp_parses' END,
                        CASE WHEN coalesce({READINGS_RANGE}, false) THEN 'consumption_in_range' END) AS failed_rules
  FROM ({O.R_EVENTS}) r
  WHERE meter_id IS NULL OR reading_ts IS NULL OR consumption_kl IS NULL OR coalesce({READINGS_RANGE}, false)""")
def q_dq_quarantine(spark, d):
    """Rejected rows with the names of the rules they broke."""
    _, bad = Q.split_clean(I.event_readings(spark, d), Q.reading_rules(0.0, RANGE_MAX_KL))
    return bad.select("meter_id", ts_text("reading_ts").alias("reading_ts"), "consumption_kl",
                      F.array_join("failed_rules", ",").alias("failed_rules"))


# ------------------------------------------------------------------ lineage
def _lineage_sql() -> str:
    counts = f"""
      SELECT 'bronze.smart-meter.sensus_readings' AS dataset, count(*) AS n FROM events
        WHERE coalesce(event_type IN ('click','view','purchase'), false)
      UNION ALL SELECT 'bronze.smart-meter.itron_readings', count(*) FROM events
        WHERE NOT coalesce(event_type IN ('click','view','purchase'), false)
      UNION ALL SELECT 'bronze.asset.asset_master_data', count(*) FROM orders
      UNION ALL SELECT 'silver.fct_meter_readings', count(*) FROM events
      UNION ALL SELECT 'silver.dim_asset', count(*) FROM orders
      UNION ALL SELECT 'gold.nrw_daily_summary', count(*) FROM ({O.S_EVENTS}) s
      UNION ALL SELECT 'gold.asset_failure_features', count(*) FROM orders"""
    edges = " UNION ALL ".join(
        f"SELECT '{u}' AS upstream, '{w}' AS downstream, '{j}' AS job"
        for u, w, j in L.BRONZE_TO_SILVER + L.SILVER_TO_GOLD)
    return f"""
  WITH c AS ({counts}), e AS ({edges})
  SELECT e.upstream, e.downstream, e.job, cu.n AS upstream_rows, cd.n AS downstream_rows
  FROM e LEFT JOIN c cu ON cu.dataset = e.upstream LEFT JOIN c cd ON cd.dataset = e.downstream"""


@register("lineage_edges", _lineage_sql())
def q_lineage_edges(spark, d):
    """L1 / L2: lineage edges of both jobs with the row counts seen in this run."""
    ev = _events(spark, d)
    datasets = {
        "bronze.smart-meter.sensus_readings": fx.sensus_from_events(ev),
        "bronze.smart-meter.itron_readings": fx.itron_from_events(ev),
        "bronze.asset.asset_master_data": fx.asset_master_from_orders(
            fx.table(spark, d, "orders"), fx.table(spark, d, "lineitem")),
        "silver.fct_meter_readings": I.event_readings(spark, d),
        "silver.dim_asset": I.assets(spark, d),
        "gold.nrw_daily_summary": I.event_summary(spark, d),
        "gold.asset_failure_features": I.features(spark, d),
    }
    e = L.lineage_edges(spark, L.BRONZE_TO_SILVER + L.SILVER_TO_GOLD, datasets)
    return e.drop("run_ts")


# ------------------------------------------------------------ documented tier
NATION_AS_OF = "2001-06-30"
S_NAMED = f"""
  SELECT s.report_date, s.district AS district_id, d.district_name, d.region_name,
         s.total_supplied_kl, s.total_billed_kl, s.nrw_kl, s.nrw_percent
  FROM ({O.S_LINEITEM_NATION}) s LEFT JOIN ({O.DISTRICTS}) d ON s.district = d.district_id"""


def _named_summary(spark, d):
    return N.with_district_name(I.lineitem_summary(spark, d, "nation"), I.districts(spark, d))


@register("nrw_with_district_name", f"SELECT * FROM ({S_NAMED}) n")
def q_nrw_with_district_name(spark, d):
    """Daily summary with district and region names (broadcast dimension)."""
    return _named_summary(spark, d)


@register("nrw_daily_summary_documented", f"""
  SELECT n.report_date, n.district_id, n.district_name, n.total_supplied_kl, n.total_billed_kl, n.nrw_kl,
         n.nrw_percent, CAST(a_u AS DOUBLE) / 10000 AS apparent_loss_kl,
         CAST(nrw_u - a_u AS DOUBLE) / 10000 AS real_loss_kl
  FROM (SELECT *, (nrw_u * 3000 + 5000) // 10000 AS a_u
        FROM (SELECT *, CAST(round(nrw_kl * 10000) AS BIGINT) AS nrw_u FROM ({S_NAMED}) x) y) n""")
def q_nrw_daily_summary_documented(spark, d):
    """Gold NRW summary with all documented columns (district name, loss split)."""
    return N.documented_summary(I.lineitem_summary(spark, d, "nation"), I.districts(spark, d))


@register("sql_last_30_days", f"""
  SELECT report_date, district_name, nrw_percent FROM ({S_NAMED}) n
  WHERE CAST(report_date AS DATE) >= DATE '{NATION_AS_OF}' - 30
    AND CAST(report_date AS DATE) <= DATE '{NATION_AS_OF}'
  ORDER BY report_date DESC""")
def q_sql_last_30_days(spark, d):
    """P20 + O1: the documented last-30-days query, as of a fixed date."""
    return R.last_30_days(_named_summary(spark, d), NATION_AS_OF)


@register("sql_maintenance_attention", f"""
  SELECT asset_id, asset_type, days_since_last_maintenance FROM ({O.FEATURES}) f
  WHERE days_since_last_maintenance > 365 ORDER BY days_since_last_maintenance DESC""")
def q_sql_maintenance_attention(spark, d):
    """P21 + O2: the documented maintenance-attention query."""
    return R.maintenance_attention(I.features(spark, d), 365)


def _rolling_sql(sensor: str, days: int, value_expr: str, out: str) -> str:
    return f"""
  WITH d AS (
    SELECT asset_id, CAST(reading_ts AS DATE) AS day,
           sum(CAST(round(value * 10000) AS BIGINT)) AS su, count(value) AS n, max(value) AS mx
    FROM ({O.SENSORS}) s WHERE sensor = '{sensor}' GROUP BY 1, 2)
  SELECT asset_id, strftime(day, '%Y-%m-%d') AS report_date, {value_expr} AS {out}
  FROM d WINDOW w AS (PARTITION BY asset_id ORDER BY datediff('day', DATE '1970-01-01', day)
                      RANGE BETWEEN {days - 1} PRECEDING AND CURRENT ROW)"""


@register("avg_pressure_30d", _rolling_sql(
    "pressure", 30, O.exact_ratio_sql("sum(su) OVER w", "sum(n) OVER w", 6, -4),
    "avg_pressure_30d"))
def q_avg_pressure_30d(spark, d):
    """Trailing 30-day mean pressure per asset and day."""
    return S.rolling_mean(I.sensors(spark, d), "pressure", 30, decimals=6)


@register("max_vibration_7d", _rolling_sql("vibration", 7, "max(mx) OVER w", "max_vibration_7d"))
def q_max_vibration_7d(spark, d):
    """Trailing 7-day max vibration per asset and day."""
    return S.rolling_max(I.sensors(spark, d), "vibration", 7)


@register("nrw_vs_target", f"""
  SELECT report_date, district, nrw_percent, 10.0::DOUBLE AS target_percent,
         round(nrw_percent - 10.0::DOUBLE, 6) AS variance_pct, nrw_percent > 10.0::DOUBLE AS above_target
  FROM ({O.S_EVENTS}) s""")
def q_nrw_vs_target(spark, d):
    """Daily NRW against a 10 % target."""
    return N.nrw_vs_target(I.event_summary(spark, d), 10.0, decimals=6)


LOSS_SPLIT_SQL = f"""
  SELECT report_date, district, nrw_kl,
         CAST(a_u AS DOUBLE) / 10000 AS apparent_loss_kl, CAST(nrw_u - a_u AS DOUBLE) / 10000 AS real_loss_kl
  FROM (SELECT *, (nrw_u * 3000 + 5000) // 10000 AS a_u
        FROM (SELECT *, CAST(round(nrw_kl * 10000) AS BIGINT) AS nrw_u FROM ({O.S_EVENTS}) s) x) y"""


@register("loss_split", LOSS_SPLIT_SQL)
def q_loss_split(spark, d):
    """Apparent (30 %) vs real loss per district-day."""
    return N.loss_split(I.event_summary(spark, d))


@register("loss_trend", f"""
  SELECT strftime(date_trunc('month', CAST(report_date AS DATE)), '%Y-%m-%d') AS month, district,
         CAST(sum(CAST(round(apparent_loss_kl * 10000) AS BIGINT)) AS DOUBLE) / 10000 AS apparent_loss_kl,
         CAST(sum(CAST(round(real_loss_kl * 10000) AS BIGINT)) AS DOUBLE) / 10000 AS real_loss_kl
  FROM ({LOSS_SPLIT_SQL}) l GROUP BY 1, 2""")
def q_loss_trend(spark, d):
    """Monthly apparent vs real loss."""
    return N.loss_trend(N.loss_split(I.event_summary(spark, d)))


INTERVENTION = "2024-01-16"


@register("nrw_before_after", f"""
  SELECT district, nrw_pct_before, nrw_pct_after, days_before, days_after,
         round(nrw_pct_after - nrw_pct_before, 6) AS change_pct
  FROM (SELECT district,
          {_exact_mean_sql(f"CASE WHEN CAST(report_date AS DATE) < DATE '{INTERVENTION}' THEN nrw_percent END")}
            AS nrw_pct_before,
          {_exact_mean_sql(f"CASE WHEN CAST(report_date AS DATE) >= DATE '{INTERVENTION}' THEN nrw_percent END")}
            AS nrw_pct_after,
          CAST(count_if(CAST(report_date AS DATE) < DATE '{INTERVENTION}') AS BIGINT) AS days_before,
          CAST(count_if(CAST(report_date AS DATE) >= DATE '{INTERVENTION}') AS BIGINT) AS days_after
        FROM ({O.S_EVENTS}) s GROUP BY district) x""")
def q_nrw_before_after(spark, d):
    """Leak-programme effect: mean NRW % before vs after an intervention date."""
    return N.nrw_before_after(I.event_summary(spark, d), INTERVENTION, decimals=6)


@register("top_loss_districts", f"""
  SELECT district, CAST(nrw_u AS DOUBLE) / 10000 AS nrw_kl, CAST(sup_u AS DOUBLE) / 10000 AS total_supplied_kl,
         {O.exact_ratio_sql('nrw_u', 'sup_u', 6, 2)} AS nrw_percent
  FROM (SELECT district,
               sum(CAST(round(nrw_kl * 10000) AS BIGINT)) AS nrw_u,
               sum(CAST(round(total_supplied_kl * 10000) AS BIGINT)) AS sup_u
        FROM ({O.S_LINEITEM_NATION}) s GROUP BY district) x
  ORDER BY nrw_kl DESC, district LIMIT 5""")
def q_top_loss_districts(spark, d):
    """The five districts with the most NRW volume."""
    return N.top_loss_districts(I.lineitem_summary(spark, d, "nation"), 5, decimals=6)


SNAPSHOT = "2024-01-30"


@register("asset_feature_snapshot", f"""
  WITH sn AS (
    SELECT asset_id,
           sum(CASE WHEN sensor = 'pressure' AND CAST(reading_ts AS DATE) > DATE '{SNAPSHOT}' - 30
                    THEN CAST(round(value * 10000) AS BIGINT) END) AS p_u,
           count(CASE WHEN sensor = 'pressure' AND CAST(reading_ts AS DATE) > DATE '{SNAPSHOT}' - 30
                      THEN value END) AS p_n,
           max(CASE WHEN sensor = 'vibration' AND CAST(reading_ts AS DATE) > DATE '{SNAPSHOT}' - 7
                    THEN value END) AS max_vibration_7d
    FROM ({O.SENSORS}) s
    WHERE CAST(reading_ts AS DATE) > DATE '{SNAPSHOT}' - 30 AND CAST(reading_ts AS DATE) <= DATE '{SNAPSHOT}'
    GROUP BY asset_id)
  SELECT d.asset_id, '{SNAPSHOT}' AS snapshot_date, d.asset_type,
         strftime(d.install_date, '%Y-%m-%d') AS install_date, m.material,
         CAST(DATE '{SNAPSHOT}' - d.install_date AS INTEGER) AS asset_age_days,
         {O.exact_ratio_sql('sn.p_u', 'sn.p_n', 6, -4)} AS avg_pressure_30d,
         sn.max_vibration_7d,
         CAST(DATE '{SNAPSHOT}' - d.last_maintenance_date AS INTEGER) AS days_since_last_maintenance,
         CAST(coalesce(m.failure_event, 0) AS INTEGER) AS failure_event
  FROM ({O.DIM_ASSET}) d LEFT JOIN ({O.MAINT_SUMMARY}) m ON d.asset_id = m.asset_id
  LEFT JOIN sn ON d.asset_id = sn.asset_id""")
def q_asset_feature_snapshot(spark, d):
    """All ten documented feature columns at one snapshot date."""
    return S.snapshot_of(I.assets_with_history(spark, d), I.sensors(spark, d), SNAPSHOT, decimals=6)


@register("asset_feature_snapshot_from_log", ORACLES["asset_feature_snapshot"])
def q_asset_feature_snapshot_from_log(spark, d):
    """X5 from the separate asset dimension and maintenance log, as the snapshot job runs it."""
    return S.asset_feature_snapshot(I.assets(spark, d), I.maintenance_log(spark, d), I.sensors(spark, d), SNAPSHOT, decimals=6)


@register("maintenance_priority", f"""
  SELECT asset_id, asset_type, failure_event, days_since_last_maintenance, asset_age_days
  FROM ({O.FEATURES}) f
  ORDER BY failure_event DESC, coalesce(days_since_last_maintenance, 2147483647) DESC,
           asset_age_days DESC, asset_id LIMIT 100""")
def q_maintenance_priority(spark, d):
    """Top 100 assets by maintenance risk."""
    return A.maintenance_priority(I.features(spark, d), 100)


@register("failure_by_condition", f"""
  SELECT asset_type, CAST(floor(CAST(asset_age_days AS DOUBLE) / 1000) AS BIGINT) * 1000 AS age_band_start,
         coalesce(days_since_last_maintenance > 365, true) AS overdue,
         count(*) AS total_assets, CAST(sum(failure_event) AS BIGINT) AS failures,
         {O.exact_ratio_sql('sum(failure_event)', 'count(*)', 6)} AS failure_rate
  FROM ({O.FEATURES}) f GROUP BY 1, 2, 3""")
def q_failure_by_condition(spark, d):
    """Failure rate by type, 1000-day age band and overdue flag."""
    return A.failure_by_condition(I.features(spark, d), 1000, 365, decimals=6)


@register("failure_model_scores", f"""
  SELECT asset_id, failure_event, asset_age_days IS NOT NULL AS scored, asset_age_days IS NOT NULL AS is_probability
  FROM ({O.FEATURES}) f""")
def q_failure_model_scores(spark, d):
    """Every asset with its label, whether the model scored it, and whether the score is a probability."""
    p = F.col("failure_probability")
    return M.failure_model_scores(I.features(spark, d)).select(
        "asset_id", "failure_event", p.isNotNull().alias("scored"), F.coalesce(p.between(0, 1), F.lit(False)).alias("is_probability"))


@register("failure_model_calibration", f"""
  SELECT CAST(count(*) AS BIGINT) AS assets, round(avg(failure_event), 3) AS base_rate, round(avg(failure_event), 3) AS mean_probability
  FROM ({O.FEATURES}) f WHERE asset_age_days IS NOT NULL""")
def q_failure_model_calibration(spark, d):
    """At convergence, the mean probability is the base rate (the intercept is not penalised)."""
    s = M.failure_model_scores(I.features(spark, d)).where("failure_probability is not null")
    return s.agg(F.count(F.lit(1)).alias("assets"), F.round(F.avg("failure_event"), 3).alias("base_rate"),
                 F.round(F.avg("failure_probability"), 3).alias("mean_probability"))


@register("demand_forecast_naive", f"""
  WITH p AS ({HOURLY_PROFILE_SQL}),
       h AS (SELECT unnest(generate_series(date_trunc('hour', max(reading_ts)) + INTERVAL 1 HOUR,
                                           date_trunc('hour', max(reading_ts)) + INTERVAL 168 HOUR,
                                           INTERVAL 1 HOUR)) AS ts FROM ({O.R_EVENTS}) r)
  SELECT strftime(h.ts, '%Y-%m-%d %H:%M:%S') AS forecast_ts, dayname(h.ts) AS day_of_week,
         CAST(hour(h.ts) AS INTEGER) AS hour, p.consumption_kl AS forecast_kl
  FROM h LEFT JOIN p ON p.day_of_week = dayname(h.ts) AND p.hour = hour(h.ts)""")
def q_demand_forecast_naive(spark, d):
    """Seasonal-naive hourly demand forecast for the next 7 days."""
    return M.demand_forecast_naive(I.event_readings(spark, d), 168, decimals=6)


@register("demand_forecast_harmonic", O.forecast_harmonic_sql(O.R_EVENTS))
def q_demand_forecast_harmonic(spark, d):
    """Least squares on trend, daily and weekly harmonics; the next 7 days of every district."""
    f = FC.demand_forecast_harmonic(I.event_readings(spark, d), decimals=3)
    return f.withColumn("forecast_ts", F.date_format("forecast_ts", "yyyy-MM-dd HH:mm:ss"))


@register("demand_forecast_backtest", O.forecast_backtest_sql(O.R_EVENTS))
def q_demand_forecast_backtest(spark, d):
    """Errors of the harmonic and the naive forecast over the last week of every district."""
    return FC.forecast_backtest(I.event_readings(spark, d), decimals=3)


@register("readings_with_asset", f"""
  SELECT r.meter_id, strftime(r.reading_ts, '{TS_SQL}') AS reading_ts, r.consumption_kl, a.asset_id,
         a.asset_type, a.manufacturer, a.latitude, a.longitude
  FROM (SELECT *, 'MTR-' || split_part(meter_id, '-', 2) AS asset_id FROM ({O.R_EVENTS}) r0) r
  LEFT JOIN ({O.DIM_ASSET}) a ON r.asset_id = a.asset_id""")
def q_readings_with_asset(spark, d):
    """Readings enriched with their asset's columns."""
    j = A.readings_with_asset(I.event_readings(spark, d), I.assets(spark, d))
    return j.select("meter_id", ts_text("reading_ts").alias("reading_ts"), "consumption_kl", "asset_id",
                    "asset_type", "manufacturer", "latitude", "longitude")


# ---------------------------------------------------------------- streaming
def _land_event_feeds(spark, d):
    ev = _events(spark, d)
    sensus_dir = fx.land_json(fx.sensus_from_events(ev), scratch_path(spark, "land-sensus"))
    itron_dir = fx.land_json(fx.itron_from_events(ev), scratch_path(spark, "land-itron"))
    return sensus_dir, itron_dir


@register("stream_conform", ORACLES["fct_meter_readings"])
def q_stream_conform(spark, d):
    """Streaming conform of landed feeds into the silver fact (file sink)."""
    sensus_dir, itron_dir = _land_event_feeds(spark, d)
    out, ckpt = scratch_path(spark, "stream-silver"), scratch_path(spark, "stream-silver-ckpt")
    q = ST.start_conform(spark, sensus_dir, itron_dir, out, ckpt)
    q.awaitTermination()
    r = spark.read.schema(schemas.SILVER_READINGS_BY_DATE).parquet(out)
    return r.select("meter_id", "reading_timestamp", ts_text("reading_ts").alias("reading_ts"), "consumption_kl")


STREAM_WATERMARK = "1 hour"


@register("stream_daily_nrw", f"""
  SELECT * FROM ({O.S_EVENTS}) s
  WHERE CAST(CAST(report_date AS DATE) + 1 AS TIMESTAMP) <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_stream_daily_nrw(spark, d):
    """Watermarked daily NRW stream; closed days only (append mode)."""
    sensus_dir, itron_dir = _land_event_feeds(spark, d)
    out, ckpt = scratch_path(spark, "stream-nrw"), scratch_path(spark, "stream-nrw-ckpt")
    q = ST.start_daily_nrw(spark, sensus_dir, itron_dir, out, ckpt, I.billing_rule(), STREAM_WATERMARK,
                           decimals=6)
    q.awaitTermination()
    return spark.read.parquet(out).select(*N.SUMMARY_COLUMNS)


# ------------------------------------------------- volumes that are not plain
#: Readings whose meter number has this remainder modulo 50 get a volume that sums must not lose silently.
ODD_VOLUMES = {0: "'NaN'::DOUBLE", 1: "'Infinity'::DOUBLE", 2: "4e9 + consumption_kl", 3: "consumption_kl + 0.00004", 4: "NULL"}
R_ODD = f"""
  SELECT meter_id, reading_ts, CASE CAST(split_part(meter_id, '-', 2) AS BIGINT) % 50
         {" ".join(f"WHEN {k} THEN {v}" for k, v in ODD_VOLUMES.items())} ELSE consumption_kl END AS consumption_kl
  FROM ({O.R_EVENTS}) r0"""


def _odd_readings(spark, d):
    c, k = F.col("consumption_kl"), F.pmod(meter_suffix("meter_id"), F.lit(50))
    odd = (F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(float("inf"))).when(k == 2, F.lit(4e9) + c)
           .when(k == 3, c + F.lit(0.00004)).when(k == 4, F.lit(None).cast("double")).otherwise(c))
    return I.event_readings(spark, d).withColumn("consumption_kl", odd)


@register("nrw_rejected_readings", f"""
  SELECT strftime(reading_ts, '%Y-%m-%d') AS report_date, substr(meter_id, 1, 3) AS district, fault, count(*) AS readings
  FROM (SELECT *, CASE WHEN consumption_kl IS NULL THEN 'missing'
                       WHEN isnan(consumption_kl) OR isinf(consumption_kl) THEN 'not_finite'
                       WHEN abs(consumption_kl) < 1e9 AND abs(consumption_kl * 10000 - round(consumption_kl * 10000))
                            > abs(consumption_kl * 10000) * 1e-12 + 1e-9 THEN 'rounded' END AS fault
        FROM ({R_ODD}) r) f
  WHERE fault IS NOT NULL GROUP BY 1, 2, 3""")
def q_nrw_rejected_readings(spark, d):
    """A1: every reading that the daily summary leaves out or rounds is counted."""
    return N.rejected_readings(_odd_readings(spark, d))


@register("nrw_daily_summary_odd_volumes", f"""
  SELECT * FROM ({O.summary_sql(f"SELECT meter_id, reading_ts, CASE WHEN isfinite(consumption_kl) THEN consumption_kl END AS consumption_kl FROM ({R_ODD}) o")}) s""")
def q_nrw_daily_summary_odd_volumes(spark, d):
    """A1 over the same readings: large volumes are summed exactly."""
    return N.nrw_daily_summary(_odd_readings(spark, d), I.billing_rule(), decimals=6)


@register("sensor_snapshot_nan", f"""
  WITH s AS (
    SELECT asset_id, reading_ts, sensor, CASE minute(reading_ts) % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE value END AS value
    FROM ({O.SENSORS}) x WHERE CAST(reading_ts AS DATE) <= DATE '2024-01-30' AND CAST(reading_ts AS DATE) > DATE '2024-01-30' - 30)
  SELECT asset_id,
         {O.exact_mean_sql("CASE WHEN sensor = 'pressure' THEN value END", 4)} AS avg_pressure_30d,
         max(CASE WHEN sensor = 'vibration' AND CAST(reading_ts AS DATE) > DATE '2024-01-30' - 7 THEN value END) AS max_vibration_7d
  FROM s GROUP BY asset_id""")
def q_sensor_snapshot_nan(spark, d):
    """NaN and infinite values are left out of the mean and the maximum alike."""
    k = F.minute("reading_ts") % 5
    odd = F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(float("inf"))).otherwise(F.col("value"))
    return S.sensor_snapshot(I.sensors(spark, d).withColumn("value", odd), "2024-01-30")


# ----------------------------------------------------------- the jobs as they ship
@register("gold_rebuild_twice", f"""
  SELECT report_date, district, total_supplied_kl, total_billed_kl, nrw_kl FROM ({O.S_EVENTS}) s""")
def q_gold_rebuild_twice(spark, d):
    """Both jobs in full, the gold job twice; the second rebuild replaces the first."""
    silver, gold = scratch_path(spark, "job-silver"), scratch_path(spark, "job-gold")
    ev = _events(spark, d)
    master = fx.asset_master_from_orders(fx.table(spark, d, "orders"), fx.table(spark, d, "lineitem"))
    run_bronze_to_silver(spark, BronzePaths(
        fx.land_json(fx.sensus_from_events(ev), scratch_path(spark, "job-sensus")),
        fx.land_json(fx.itron_from_events(ev), scratch_path(spark, "job-itron")),
        fx.land_json(master, scratch_path(spark, "job-master"))), silver)
    log = fx.land_csv(I.maintenance_log(spark, d, full=True), scratch_path(spark, "job-log"))
    for _ in range(2):
        run_silver_to_gold(spark, silver, gold, log, ASSET_AS_OF, I.billing_rule())
    return tables.read_table(spark, f"{gold}/nrw_daily_summary").select(*N.SUMMARY_COLUMNS[:5])


@register("silver_quarantine", f"""
  SELECT meter_id, strftime(reading_ts, '{TS_SQL}') AS reading_ts, consumption_kl,
         CASE WHEN consumption_kl IS NULL THEN 'consumption_not_null'
              WHEN consumption_kl < 0 OR consumption_kl > 10000 THEN 'consumption_in_range' ELSE '' END AS failed_rules
  FROM (SELECT meter_id, reading_ts, CASE CAST(split_part(meter_id, '-', 2) AS BIGINT) % 50
               WHEN 4 THEN NULL WHEN 5 THEN -consumption_kl - 1 ELSE consumption_kl END AS consumption_kl
        FROM ({O.R_EVENTS}) r0) r""")
def q_silver_quarantine(spark, d):
    """The silver job with a quarantine; accepted and rejected rows together are the input."""
    k, v = F.pmod(F.col("user_id"), F.lit(50)), F.col("value")
    ev = _events(spark, d).withColumn("value", F.when(k == 4, F.lit(None)).when(k == 5, -v - 1).otherwise(v))
    silver, out = scratch_path(spark, "quarantine-silver"), scratch_path(spark, "quarantine")
    run_bronze_to_silver(spark, BronzePaths(
        fx.land_json(fx.sensus_from_events(ev), scratch_path(spark, "quarantine-sensus")),
        fx.land_json(fx.itron_from_events(ev), scratch_path(spark, "quarantine-itron")), None), silver, quarantine_path=out)
    cols = ["meter_id", ts_text("reading_ts").alias("reading_ts"), "consumption_kl"]
    good = tables.read_table(spark, f"{silver}/fct_meter_readings").select(*cols, F.lit("").alias("failed_rules"))
    bad = tables.read_table(spark, out).select(*cols, F.array_join("failed_rules", ",").alias("failed_rules"))
    return good.unionByName(bad)


@register("bronze_sensus_multiline", ORACLES["bronze_sensus"])
def q_bronze_sensus_multiline(spark, d):
    """The landing form of the original jobs, one JSON array a file."""
    rows = fx.sensus_from_events(_events(spark, d)).select(F.to_json(F.struct("*")).alias("value"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(8)))
    # Each part becomes one array: its first row opens it, the others follow a comma, the last closes it.
    w = Window.partitionBy("part").orderBy("value")
    numbered = rows.select("part", "value", F.row_number().over(w).alias("i"), F.lead("value").over(w).isNull().alias("last"))
    lines = numbered.select("part", F.concat(F.when(F.col("i") == 1, "[").otherwise(","), "value", F.when(F.col("last"), "]").otherwise("")).alias("value"))
    path = scratch_path(spark, "bronze-sensus-array")
    lines.write.partitionBy("part").text(path)
    return bronze.read_sensus(spark, path, multiline=True).select(
        "meter_id", "timestamp_utc", F.col("reading_data.flow_kl").alias("flow_kl"))


# ------------------------------------------------------- features as they were known
#: The log runs from 1995 to late 2001, the sensors through January 2024.
PAST_SNAPSHOT = "1998-06-30"
SNAPSHOTS = [f"2000-{m:02d}-01" for m in range(3, 13)] + ["2001-10-01", SNAPSHOT]
HORIZON_DAYS = 90

_EVENTS_SQL = """
    SELECT 'MTR-' || CAST(l_orderkey AS VARCHAR) AS asset_id, CAST(l_shipdate AS DATE) AS day, l_linestatus AS material,
           CASE WHEN l_returnflag = 'R' AND l_quantity >= 48 THEN 1 ELSE 0 END AS f FROM lineitem WHERE l_shipdate IS NOT NULL"""


def _sensor_sql(snapshots: str) -> str:
    return f"""
    SELECT asset_id, snap, {O.exact_ratio_sql("sum(CASE WHEN sensor = 'pressure' AND day > snap - 30 THEN CAST(round(value * 10000) AS BIGINT) END)",
                                              "count(CASE WHEN sensor = 'pressure' AND day > snap - 30 THEN value END)", 6, -4)} AS avg_pressure_30d,
           max(CASE WHEN sensor = 'vibration' AND day > snap - 7 THEN value END) AS max_vibration_7d
    FROM (SELECT *, CAST(reading_ts AS DATE) AS day FROM ({O.SENSORS}) s) r JOIN ({snapshots}) n ON day <= snap AND day > snap - 30 GROUP BY 1, 2"""


@register("asset_feature_snapshot_past", f"""
  WITH n AS (SELECT DATE '{PAST_SNAPSHOT}' AS snap), e AS ({_EVENTS_SQL}),
  m AS (SELECT asset_id, max(f) AS failure_event, arg_max(material, (day, material)) AS material, max(day) AS last_day
        FROM e, n WHERE day <= snap GROUP BY 1)
  SELECT d.asset_id, '{PAST_SNAPSHOT}' AS snapshot_date, d.asset_type, strftime(d.install_date, '%Y-%m-%d') AS install_date, m.material,
         CAST(snap - d.install_date AS INTEGER) AS asset_age_days, CAST(NULL AS DOUBLE) AS avg_pressure_30d, CAST(NULL AS DOUBLE) AS max_vibration_7d,
         CAST(snap - m.last_day AS INTEGER) AS days_since_last_maintenance, CAST(coalesce(m.failure_event, 0) AS INTEGER) AS failure_event
  FROM ({O.DIM_ASSET}) d CROSS JOIN n LEFT JOIN m ON d.asset_id = m.asset_id WHERE d.install_date IS NULL OR d.install_date <= snap""")
def q_asset_feature_snapshot_past(spark, d):
    """X5 / P11 at a date inside the log's years: nothing later is used."""
    return S.asset_feature_snapshot(I.assets(spark, d), I.maintenance_log(spark, d), I.sensors(spark, d), PAST_SNAPSHOT)


@register("asset_feature_history", f"""
  WITH n AS (SELECT CAST(unnest({SNAPSHOTS}) AS DATE) AS snap), e AS ({_EVENTS_SQL}),
  days AS (SELECT asset_id, day, max(material) AS material, count(*) AS k, sum(f) AS f FROM e GROUP BY 1, 2),
  c AS (SELECT asset_id, day, material, CAST(sum(k) OVER w AS BIGINT) AS events, CAST(sum(f) OVER w AS BIGINT) AS failures
        FROM days WINDOW w AS (PARTITION BY asset_id ORDER BY day)),
  failed AS (SELECT asset_id, day FROM days WHERE f > 0),
  s AS (SELECT d.*, snap FROM ({O.DIM_ASSET}) d, n WHERE d.install_date IS NULL OR d.install_date <= snap),
  x AS ({_sensor_sql("SELECT * FROM n")})
  SELECT s.asset_id, strftime(s.snap, '%Y-%m-%d') AS snapshot_date, s.asset_type, s.manufacturer, c.material,
         CAST(s.snap - s.install_date AS INTEGER) AS asset_age_days, CAST(s.snap - c.day AS INTEGER) AS days_since_last_maintenance,
         coalesce(c.events, 0) AS maintenance_events, coalesce(c.failures, 0) AS failures_to_date,
         CAST(s.snap - before.day AS INTEGER) AS days_since_last_failure,
         CAST(CASE WHEN next.day <= s.snap + {HORIZON_DAYS} THEN 1
                   WHEN s.snap + {HORIZON_DAYS} <= (SELECT max(day) FROM e) THEN 0 END AS INTEGER) AS failure_within_horizon,
         x.avg_pressure_30d, x.max_vibration_7d
  FROM s ASOF LEFT JOIN c ON s.asset_id = c.asset_id AND s.snap >= c.day
  ASOF LEFT JOIN failed before ON s.asset_id = before.asset_id AND s.snap >= before.day
  ASOF LEFT JOIN failed next ON s.asset_id = next.asset_id AND s.snap < next.day
  LEFT JOIN x ON s.asset_id = x.asset_id AND s.snap = x.snap""")
def q_asset_feature_history(spark, d):
    """Twelve snapshots in one pass, the label from the 90 days after each."""
    return H.feature_history(I.assets(spark, d), I.maintenance_log(spark, d), SNAPSHOTS, HORIZON_DAYS, sensors=I.sensors(spark, d))


@register("asset_risk_rank", f"""
  SELECT asset_id, asset_type, days_since_last_maintenance,
         CASE WHEN days_since_last_maintenance IS NOT NULL THEN {O.exact_ratio_sql(
             "rank() OVER (PARTITION BY days_since_last_maintenance IS NULL ORDER BY days_since_last_maintenance) - 1",
             "nullif(count(*) OVER (PARTITION BY days_since_last_maintenance IS NULL) - 1, 0)", 6)} END AS risk_rank
  FROM ({O.FEATURES}) f""")
def q_asset_risk_rank(spark, d):
    """Share of all assets that were maintained more recently."""
    f = I.features(spark, d).select("asset_id", "asset_type", "days_since_last_maintenance")
    return RK.percent_rank(f, "days_since_last_maintenance", name="risk_rank")


_RISK_SQL = f"""
  SELECT *, CAST(sum(n) OVER w - n AS BIGINT) AS below, CAST(sum(pos) OVER w - pos AS BIGINT) AS pos_below,
         CAST(sum(n) OVER (PARTITION BY snapshot_date) AS BIGINT) AS total
  FROM (SELECT snapshot_date, days_since_last_maintenance AS score, count(*) AS n, CAST(sum(failure_within_horizon) AS BIGINT) AS pos
        FROM ({ORACLES["asset_feature_history"]}) h WHERE days_since_last_maintenance IS NOT NULL AND failure_within_horizon IS NOT NULL GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY snapshot_date ORDER BY score)"""


@register("risk_auc_by_snapshot", f"""
  SELECT snapshot_date, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(pos) AS BIGINT) AS positives,
         {O.exact_ratio_sql("sum(pos * (2 * (below - pos_below) + n - pos))", "nullif(2 * sum(pos) * (sum(n) - sum(pos)), 0)", 6)} AS auc
  FROM ({_RISK_SQL}) r GROUP BY 1""")
def q_risk_auc_by_snapshot(spark, d):
    """How well the days since maintenance tell which assets fail in the 90 days after each snapshot."""
    h = H.feature_history(I.assets(spark, d), I.maintenance_log(spark, d), SNAPSHOTS, HORIZON_DAYS)
    return RK.auc(h, "days_since_last_maintenance", "failure_within_horizon", ["snapshot_date"])


@register("risk_deciles_by_snapshot", f"""
  SELECT snapshot_date, CAST(below * 10 // total AS INTEGER) AS bin, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(pos) AS BIGINT) AS positives,
         round(CAST(sum(score * n) AS DOUBLE) / CAST(sum(n) AS DOUBLE), 3) AS mean_score, {O.exact_ratio_sql("sum(pos)", "sum(n)", 6)} AS positive_rate
  FROM ({_RISK_SQL}) r GROUP BY 1, 2""")
def q_risk_deciles_by_snapshot(spark, d):
    """Failures in the 90 days after each snapshot by decile of the days since maintenance."""
    h = H.feature_history(I.assets(spark, d), I.maintenance_log(spark, d), SNAPSHOTS, HORIZON_DAYS)
    return RK.calibration(h, "days_since_last_maintenance", "failure_within_horizon", ["snapshot_date"], decimals=6).withColumn(
        "mean_score", F.round("mean_score", 3))


@register("failure_model_backtest")
def q_failure_model_backtest(spark, d):
    """The model of what was known at the seventh snapshot, stored, then its AUC on that snapshot and the later ones."""
    h = H.feature_history(I.assets(spark, d), I.maintenance_log(spark, d), SNAPSHOTS, HORIZON_DAYS)
    path, split = scratch_path(spark, "failure-model"), str(sorted(SNAPSHOTS)[6])
    # Stored once: the fit learns from its past, the scores are those of what follows.
    stored, later = scratch_path(spark, "feature-history"), F.col("snapshot_date") >= F.to_date(F.lit(split))
    h.where(later | FM.known_at(split, HORIZON_DAYS)).write.parquet(stored)
    h = spark.read.schema(h.schema).parquet(stored)
    FM.fit_failure_model(h, split, path, HORIZON_DAYS)
    later = FM.scored(h.where(later), path)
    return RK.auc(later, "failure_probability", FM.LABEL, ["snapshot_date"])


@register("reading_asset_state", f"""
  WITH e AS ({_EVENTS_SQL}), days AS (SELECT asset_id, day, max((material, f)) AS v FROM e GROUP BY 1, 2)
  SELECT 'MTR-' || CAST(o_orderkey AS VARCHAR) AS asset_id, strftime(CAST(o_orderdate AS DATE) + 1000, '%Y-%m-%d') AS inspected,
         v[1] AS material, CAST(v[2] AS INTEGER) AS failure_event
  FROM (SELECT *, 'MTR-' || CAST(o_orderkey AS VARCHAR) AS aid, CAST(o_orderdate AS DATE) + 1000 AS at FROM orders) o
  ASOF LEFT JOIN days ON o.aid = days.asset_id AND o.at >= days.day""")
def q_reading_asset_state(spark, d):
    """J1 as an as-of join: each asset's latest log entry at an inspection 1000 days after its installation."""
    visits = I.assets(spark, d).select("asset_id", F.date_add(F.col("install_date").cast("date"), 1000).alias("inspected"))
    return H.as_of_join(visits, I.maintenance_log(spark, d), ["asset_id"], "inspected", "last_maintenance_date", ["material", "failure_event"])


# ------------------------------------------------------------------ repaired series
def _repair_sql(readings: str, step: str, epoch: str, max_gap: int, stuck: int, factor: int) -> str:
    """``epoch``: the whole steps since 1970 of a timestamp r."""
    num = "prev_u * (h - i) + u * (i - prev_h)"
    return f"""
  WITH a AS (SELECT meter_id, {epoch} AS h, CAST(sum({O.UNITS}) AS BIGINT) AS u FROM ({readings}) q WHERE reading_ts IS NOT NULL GROUP BY 1, 2),
  b AS (SELECT *, lag(h) OVER w AS prev_h, lag(u) OVER w AS prev_u FROM a WINDOW w AS (PARTITION BY meter_id ORDER BY h)),
  c AS (SELECT *, sum(CASE WHEN prev_h = h - 1 AND prev_u = u THEN 0 ELSE 1 END) OVER (PARTITION BY meter_id ORDER BY h) AS run FROM b),
  r AS (SELECT *, count(*) OVER (PARTITION BY meter_id, run) AS length FROM c),
  t AS (SELECT meter_id, h, u, concat_ws(',', CASE WHEN length >= {stuck} AND u > 0 THEN 'stuck' END,
               CASE WHEN u * {factor} < prev_u THEN 'reset' END, CASE WHEN h - prev_h - 1 > {max_gap} THEN 'after_gap' END) AS reason,
               coalesce(h - prev_h - 1, 0) AS missing FROM r
        UNION ALL
        SELECT meter_id, i, CAST((2 * ({num}) + (h - prev_h)) // (2 * (h - prev_h)) AS BIGINT), 'filled', 0
        FROM (SELECT *, unnest(generate_series(prev_h + 1, h - 1)) AS i FROM b WHERE h - prev_h - 1 BETWEEN 1 AND {max_gap}) f)
  SELECT meter_id, strftime(TIMESTAMP '1970-01-01' + CAST(h AS INTEGER) * INTERVAL 1 {step}, '%Y-%m-%d %H:%M:%S') AS step_ts,
         CAST(u AS DOUBLE) / 10000 AS consumption_kl, reason, CAST(missing AS BIGINT) AS missing_before FROM t"""


@register("readings_repaired", _repair_sql(O.R_EVENTS, "HOUR", "CAST(epoch(date_trunc('hour', reading_ts)) AS BIGINT) // 3600", 24, 3, 10))
def q_readings_repaired(spark, d):
    """Hourly series of every meter, missing hours interpolated, stuck and reset registers marked."""
    r = P.repaired(I.event_readings(spark, d), "hour", max_gap=24, stuck_steps=3, reset_factor=10)
    return r.withColumn("step_ts", F.date_format("step_ts", "yyyy-MM-dd HH:mm:ss"))


@register("readings_repaired_daily", _repair_sql(O.R_LINEITEM, "DAY", "datediff('day', DATE '1970-01-01', CAST(reading_ts AS DATE))", 30, 2, 10))
def q_readings_repaired_daily(spark, d):
    """The same by day over seven years of readings, where runs of equal values occur."""
    r = P.repaired(I.lineitem_readings(spark, d), "day", max_gap=30, stuck_steps=2, reset_factor=10)
    return r.withColumn("step_ts", F.date_format("step_ts", "yyyy-MM-dd HH:mm:ss"))


# ------------------------------------------------------- stream: open days, late rows
LATE_SPLIT = "2024-01-20 00:00:00"
#: Landed first: nine tenths of what happened before the split; then all the rest, old readings among it.
_FIRST = f"(event_id % 10 <> 0 AND ts < TIMESTAMP '{LATE_SPLIT}')"
_MONITORED = f"""
  SELECT r.meter_id, r.reading_ts, r.consumption_kl,
         CASE WHEN r.event_id % 97 = 0 THEN 'untimed'
              WHEN NOT {_FIRST.replace('event_id', 'r.event_id').replace('ts <', 'r.reading_ts <')}
                   AND date_trunc('day', r.reading_ts) + INTERVAL 1 DAY <= (
                     SELECT max(ts) - INTERVAL 1 HOUR FROM events WHERE {_FIRST} AND event_id % 97 <> 0) THEN 'late' ELSE 'accepted' END AS status
  FROM (SELECT event_id, CASE WHEN coalesce(event_type IN ('click','view','purchase'), false) THEN 'SEN-' ELSE 'ITR-' END
               || CAST(user_id AS VARCHAR) AS meter_id, ts AS reading_ts, value AS consumption_kl FROM events) r"""


def _monitored(spark, d) -> str:
    """Both feeds landed in two deliveries, with the monitor stopped and started again between them."""
    ev = _events(spark, d)
    first = F.coalesce(F.expr(_FIRST.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")), F.lit(False))
    bad = F.pmod("event_id", F.lit(97)) == 0
    land, out, ckpt = (scratch_path(spark, f"monitor-{n}") for n in ("land", "out", "ckpt"))
    for i, part in enumerate((ev.where(first), ev.where(~first))):
        for name, feed, at in (("sensus", fx.sensus_from_events, "timestamp_utc"), ("itron", fx.itron_from_events, "read_datetime")):
            rows = feed(part.where(~bad)).unionByName(feed(part.where(bad)).withColumn(at, F.lit("no time")))
            fx.land_json(rows, f"{land}/{name}/{i}")
        SM.start_monitor(spark, f"{land}/sensus/*", f"{land}/itron/*", out, ckpt, I.billing_rule(), dt.timedelta(hours=1)).awaitTermination()
    return out


@register("stream_current_days", f"""
  SELECT s.*, CAST(CAST(report_date AS DATE) + 1 AS TIMESTAMP) <= (
           SELECT max(reading_ts) - INTERVAL 1 HOUR FROM ({_MONITORED}) m WHERE status <> 'untimed') AS closed
  FROM ({O.summary_sql(f"SELECT * FROM ({_MONITORED}) a WHERE status = 'accepted'")}) s""")
def q_stream_current_days(spark, d):
    """Open and closed days as of the last batch, after a restart."""
    return SM.current_days(spark, _monitored(spark, d), decimals=6)


@register("stream_row_counts", f"""
  SELECT status, count(*) AS readings FROM ({_MONITORED}) m GROUP BY 1""")
def q_stream_row_counts(spark, d):
    """Accepted, late and untimed rows; together they are the input."""
    return SM.row_counts(spark, _monitored(spark, d))


# ----------------------------------------------- refresh by new files, repeated deliveries
def _land_part(ev, land, name):
    fx.land_json(fx.sensus_from_events(ev), f"{land}/sensus/{name}")
    fx.land_json(fx.itron_from_events(ev), f"{land}/itron/{name}")


@register("refresh_new_files", f"SELECT * FROM ({O.S_EVENTS}) s")
def q_refresh_new_files(spark, d):
    """Three deliveries, the last one late for old days; each refresh finds its own days, and all equal a full rebuild."""
    ev, land = _events(spark, d), scratch_path(spark, "files-land")
    silver, gold, manifest = (scratch_path(spark, f"files-{n}") for n in ("silver", "gold", "manifest"))
    old, fifth = F.col("ts") < F.expr("timestamp_ntz '2024-01-15 00:00:00'"), F.pmod("event_id", F.lit(5)) == 0
    for i, part in enumerate((ev.where(old & ~fifth), ev.where(~old | F.col("ts").isNull()), ev.where(old & fifth))):
        _land_part(part, land, i)
        refresh_new_files(spark, {"sensus": f"{land}/sensus", "itron": f"{land}/itron"}, silver, gold, manifest, I.billing_rule(), decimals=6)
    return spark.read.parquet(gold).withColumn("report_date", F.col("report_date").cast("date")).select(*N.SUMMARY_COLUMNS)


_ONCE_SQL = f"SELECT DISTINCT * FROM ({ORACLES['fct_meter_readings']}) f"


def _delivered_twice(spark, d, start):
    """Both feeds landed and conformed, then landed again in full with the stream restarted."""
    land, out, ckpt = (scratch_path(spark, f"twice-{n}") for n in ("land", "out", "ckpt"))
    for i in range(2):
        _land_part(_events(spark, d), land, i)
        start(f"{land}/sensus/*", f"{land}/itron/*", out, ckpt).awaitTermination()
    r = spark.read.schema(schemas.SILVER_READINGS_BY_DATE).parquet(out)
    return r.select("meter_id", "reading_timestamp", ts_text("reading_ts").alias("reading_ts"), "consumption_kl")


@register("stream_conform_redelivered", _ONCE_SQL)
def q_stream_conform_redelivered(spark, d):
    """The same deliveries landed twice change nothing, by state within a watermark."""
    return _delivered_twice(spark, d, lambda s, i, out, ckpt: ST.start_conform(spark, s, i, out, ckpt, once="40 days"))


@register("append_new_readings", _ONCE_SQL)
def q_append_new_readings(spark, d):
    """The same by an insert-only anti-join against the days of the silver fact that a delivery touches."""
    return _delivered_twice(spark, d, lambda s, i, out, ckpt: ST.start_conform_once(spark, s, i, out, ckpt))
