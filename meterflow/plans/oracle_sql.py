"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each statement recomputes a query from the raw driver tables with the same
fixture mapping (FIXTURES.md) and the same deterministic rules, so Spark's
result can be compared row for row.
"""

# Silver fact from events: nested feed = click/view/purchase, flat = the rest.
R_EVENTS = """
  SELECT CASE WHEN coalesce(event_type IN ('click','view','purchase'), false) THEN 'SEN-' ELSE 'ITR-' END
         || CAST(user_id AS VARCHAR) AS meter_id,
         ts AS reading_ts, value AS consumption_kl
  FROM events"""

R_LINEITEM = """
  SELECT 'D' || l_returnflag || l_linestatus || '-' || CAST(l_suppkey AS VARCHAR) AS meter_id,
         l_shipdate AS reading_ts, l_quantity AS consumption_kl
  FROM lineitem"""

R_LINEITEM_NATION = """
  SELECT 'N' || lpad(CAST(l_suppkey % 25 AS VARCHAR), 2, '0') || '-' || CAST(l_orderkey AS VARCHAR) AS meter_id,
         l_shipdate AS reading_ts, l_quantity AS consumption_kl
  FROM lineitem"""

def exact_ratio_sql(num: str, den: str, decimals: int, pow10: int = 0) -> str:
    """round(num * 10^pow10 / den, decimals), halves away from zero, in exact
    128-bit integer arithmetic; the twin of functions.measures.exact_ratio."""
    k = decimals + pow10
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    if k >= 0:
        n = f"({n} * {10**k})"
    else:
        d = f"({d} * {10**(-k)})"
    q = f"((2 * abs({n}) + {d}) // (2 * {d}))"
    return (f"(CASE WHEN {d} = 0 OR {d} IS NULL THEN NULL "
            f"ELSE CAST(CASE WHEN {n} < 0 THEN -{q} ELSE {q} END AS DOUBLE) / {10**decimals} END)")


def exact_mean_sql(x: str, scale: int = 6) -> str:
    """Twin of functions.measures.exact_mean(x, 6, scale)."""
    return exact_ratio_sql(f"sum(CAST(round(({x}) * {10**scale}) AS BIGINT))", f"count({x})", 6, -scale)


BILLED = "coalesce(TRY_CAST(split_part(meter_id, '-', 2) AS BIGINT) % 10 <> 0, false)"
UNITS = "CAST(round(consumption_kl * 10000) AS BIGINT)"


def summary_sql(readings: str) -> str:
    """nrw_daily_summary over a readings CTE body, rounded like the Spark key."""
    return f"""
  SELECT report_date, district,
         CAST(supplied_u AS DOUBLE) / 10000 AS total_supplied_kl,
         CAST(billed_u AS DOUBLE) / 10000 AS total_billed_kl,
         CAST(supplied_u - billed_u AS DOUBLE) / 10000 AS nrw_kl,
         {exact_ratio_sql('supplied_u - billed_u', 'supplied_u', 6, 2)} AS nrw_percent
  FROM (
    SELECT strftime(reading_ts, '%Y-%m-%d') AS report_date, substr(meter_id, 1, 3) AS district,
           sum({UNITS}) AS supplied_u,
           sum(CASE WHEN {BILLED} THEN {UNITS} ELSE 0 END) AS billed_u
    FROM ({readings}) r
    GROUP BY 1, 2
  ) a"""


S_EVENTS = summary_sql(R_EVENTS)
S_LINEITEM = summary_sql(R_LINEITEM)
S_LINEITEM_NATION = summary_sql(R_LINEITEM_NATION)

def initcap(x: str) -> str:
    """Spark's initcap: each space-separated word upper-cased first, rest lower."""
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


DISTRICTS = f"""
  SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS district_id,
         {initcap('n_name')} AS district_name,
         {initcap('r_name')} AS region_name
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""

DIM_ASSET = """
  SELECT 'MTR-' || CAST(o_orderkey AS VARCHAR) AS asset_id,
         o_orderpriority AS asset_type,
         CAST(o_orderdate AS DATE) AS install_date,
         CAST(ls.last_ship AS DATE) AS last_maintenance_date,
         o_orderstatus AS manufacturer,
         'M-' || CAST(o_custkey AS VARCHAR) AS model_number,
         CAST(o_custkey % 1800 AS DOUBLE) / 10 - 90 AS latitude,
         CAST(o_custkey % 3600 AS DOUBLE) / 10 - 180 AS longitude
  FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) ls
    ON o_orderkey = ls.l_orderkey"""

MAINT_LOG = """
  SELECT 'MTR-' || CAST(l_orderkey AS VARCHAR) AS asset_id,
         CAST(o_orderdate AS DATE) AS install_date,
         o_orderpriority AS asset_type,
         l_linestatus AS material,
         CAST(l_shipdate AS DATE) AS last_maintenance_date,
         CAST(CASE WHEN l_returnflag = 'R' AND l_quantity >= 48 THEN 1 ELSE 0 END AS INTEGER) AS failure_event
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""

MAINT_SUMMARY = f"""
  SELECT asset_id, max(failure_event) AS failure_event,
         arg_max(material, (last_maintenance_date, material)) AS material,
         max(last_maintenance_date) AS log_last_maintenance_date,
         count(*) AS maintenance_events
  FROM ({MAINT_LOG}) m GROUP BY asset_id"""


def features_sql(as_of: str) -> str:
    return f"""
  SELECT d.asset_id, d.asset_type, d.manufacturer,
         CAST(DATE '{as_of}' - d.install_date AS INTEGER) AS asset_age_days,
         CAST(DATE '{as_of}' - d.last_maintenance_date AS INTEGER) AS days_since_last_maintenance,
         CAST(coalesce(s.failure_event, 0) AS INTEGER) AS failure_event
  FROM ({DIM_ASSET}) d LEFT JOIN ({MAINT_SUMMARY}) s ON d.asset_id = s.asset_id"""


FEATURES = features_sql("2001-12-31")

SENSORS = """
  SELECT 'MTR-' || CAST(user_id AS VARCHAR) AS asset_id, ts AS reading_ts,
         CASE WHEN coalesce(event_type IN ('click','view','purchase'), false) THEN 'pressure' ELSE 'vibration' END AS sensor,
         value
  FROM events"""


def demand_series_sql(readings: str) -> str:
    """Twin of operators.forecast.demand_series: volume per (district, hour since 1970)."""
    return f"""
  SELECT substr(meter_id, 1, 3) AS district, date_diff('hour', TIMESTAMP '1970-01-01', date_trunc('hour', reading_ts)) AS hr,
         CAST(sum(CAST(round(consumption_kl * 10000) AS HUGEINT)) AS DOUBLE) / 10000 AS demand_kl
  FROM ({readings}) WHERE reading_ts IS NOT NULL AND meter_id IS NOT NULL AND isfinite(consumption_kl) GROUP BY 1, 2"""


def terms_sql(at: str, first: str) -> str:
    """Twin of operators.forecast.terms, as a list: three harmonics of the day, two of the week."""
    waves = [f"{w}(({at}) % 168 * (2 * pi() * {f} / 168))" for f in (7, 14, 21, 1, 2) for w in ("cos", "sin")]
    return f"[CAST(1 AS DOUBLE), (({at}) - ({first})) / CAST(168 AS DOUBLE), {', '.join(waves)}]"


def harmonic_fit_sql(series: str, name: str) -> str:
    """Recursive CTEs; ``name`` has district, first, last, hours and coefficients (Gauss-Jordan, a term a round)."""
    return f"""
  {name}_ends AS (SELECT district, min(hr) AS first, max(hr) AS last, count(*) AS hours FROM {series} GROUP BY 1),
  {name}_rows AS (SELECT s.district, s.hr, s.demand_kl AS y, {terms_sql('s.hr', 'e.first')} AS x FROM {series} s JOIN {name}_ends e USING (district)),
  {name}_terms AS (SELECT district, hr, unnest(range(12)) AS i, unnest(x) AS x, y FROM {name}_rows),
  {name}_system AS (
    SELECT a.district, a.i, b.i AS j, sum(a.x * b.x) AS v FROM {name}_terms a JOIN {name}_terms b ON a.district = b.district AND a.hr = b.hr GROUP BY 1, 2, 3
    UNION ALL SELECT district, i, 12, sum(x * y) FROM {name}_terms GROUP BY 1, 2),
  {name}_steps AS (
    SELECT district, CAST(0 AS BIGINT) AS k, i, j, v, v AS own FROM {name}_system
    UNION ALL
    SELECT district, k + 1, i, j, CASE WHEN piv <= start * 1e-9 THEN v WHEN i = k THEN v / piv ELSE v - top * (side / piv) END, own
    FROM (SELECT *, max(CASE WHEN i = k AND j = k THEN v END) OVER (PARTITION BY district) AS piv,
                 max(CASE WHEN i = k AND j = k THEN own END) OVER (PARTITION BY district) AS start,
                 max(CASE WHEN i = k THEN v END) OVER (PARTITION BY district, j) AS top,
                 max(CASE WHEN j = k THEN v END) OVER (PARTITION BY district, i) AS side
          FROM {name}_steps WHERE k < 12)),
  {name}_found AS (
    SELECT district, i, CASE WHEN max(CASE WHEN i = j THEN v END) > 0.5 THEN max(CASE WHEN j = 12 THEN v END) ELSE 0 END AS c
    FROM {name}_steps WHERE k = 12 GROUP BY 1, 2),
  {name} AS (SELECT e.*, c.coefficients FROM {name}_ends e JOIN (SELECT district, list(c ORDER BY i) AS coefficients FROM {name}_found GROUP BY 1) c USING (district))"""


def predicted_sql(at: str, fit: str) -> str:
    return f"greatest(list_sum(list_transform(list_zip({terms_sql(at, fit + '.first')}, {fit}.coefficients), lambda p: p[1] * p[2])), 0)"


def forecast_harmonic_sql(readings: str, hours: int = 168) -> str:
    return f"""
  WITH RECURSIVE s AS ({demand_series_sql(readings)}), {harmonic_fit_sql('s', 'fit')}
  SELECT district, strftime(TIMESTAMP '1970-01-01' + to_hours(hr), '%Y-%m-%d %H:%M:%S') AS forecast_ts, round({predicted_sql('hr', 'h')}, 3) AS forecast_kl
  FROM (SELECT *, unnest(generate_series(last + 1, last + {hours})) AS hr FROM fit) h"""


def forecast_backtest_sql(readings: str, weeks: int = 1) -> str:
    return f"""
  WITH RECURSIVE s AS ({demand_series_sql(readings)}),
  e AS (SELECT district, max(hr) - {weeks * 168} AS until FROM s GROUP BY 1),
  b AS (SELECT s.* FROM s JOIN e USING (district) WHERE hr <= until), {harmonic_fit_sql('b', 'fit')},
  naive AS (SELECT district, hr % 168 AS slot, avg(demand_kl) AS naive FROM b GROUP BY 1, 2),
  t AS (SELECT s.district, {predicted_sql('s.hr', 'fit')} - demand_kl AS off, naive - demand_kl AS naive_off
        FROM s JOIN e USING (district) JOIN naive ON naive.district = s.district AND slot = s.hr % 168 JOIN fit ON fit.district = s.district WHERE s.hr > until),
  r AS (SELECT district, count(*) AS n, round(avg(abs(off)), 3) AS mae_kl, round(avg(abs(naive_off)), 3) AS naive_mae_kl,
               round(sqrt(avg(off * off)), 3) AS rmse_kl, round(sqrt(avg(naive_off * naive_off)), 3) AS naive_rmse_kl FROM t GROUP BY 1)
  SELECT e.district, coalesce(fit.hours, 0) AS hours_fitted, coalesce(r.n, 0) AS hours_tested, mae_kl, naive_mae_kl, rmse_kl, naive_rmse_kl
  FROM e LEFT JOIN fit ON fit.district = e.district LEFT JOIN r ON r.district = e.district"""
