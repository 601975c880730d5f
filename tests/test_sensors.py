"""Rolling features against a brute-force evaluation on a small fixture."""

import datetime as dt
from collections import defaultdict

from meterflow.operators.sensors import asset_feature_snapshot, rolling_max, rolling_mean, sensor_snapshot
from meterflow.plans import inputs as I
from tests.conftest import SF_SMALL


def _brute(rows, sensor, days, fn):
    by = defaultdict(list)
    for a, ts, s, v in rows:
        if s == sensor and v is not None:
            by[a].append((ts.date(), v))
    out = {}
    for a, xs in by.items():
        for d in {x[0] for x in xs}:
            vals = [v for (dd, v) in xs if d - dt.timedelta(days=days - 1) <= dd <= d]
            out[(a, d.isoformat())] = fn(vals)
    return out


def test_rolling_mean_and_max_match_brute_force(spark):
    s = I.sensors(spark, SF_SMALL)
    rows = [tuple(r) for r in s.collect()]
    want_mean = _brute(rows, "pressure", 30, lambda v: round(sum(v) / len(v), 6))
    got_mean = {(r.asset_id, r.report_date): r.avg_pressure_30d for r in rolling_mean(s).collect()}
    assert got_mean.keys() == want_mean.keys()
    assert all(abs(got_mean[k] - want_mean[k]) < 1e-6 for k in want_mean)
    want_max = _brute(rows, "vibration", 7, max)
    got_max = {(r.asset_id, r.report_date): r.max_vibration_7d for r in rolling_max(s).collect()}
    assert got_max == want_max


def test_window_sorts_daily_aggregates_not_raw_rows(spark):
    plan = rolling_mean(I.sensors(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    # The window's input is the (asset, day) aggregate: partial aggregation happens first.
    assert "partial_sum" in plan and "Window" in plan


def test_snapshot_equals_rolling_value_on_that_day(spark):
    s = I.sensors(spark, SF_SMALL)
    snap = {r.asset_id: r for r in sensor_snapshot(s, "2024-01-20").collect()}
    roll = {r.asset_id: r.avg_pressure_30d for r in rolling_mean(s).collect() if r.report_date == "2024-01-20"}
    for a, v in roll.items():
        assert snap[a].avg_pressure_30d == v


def test_feature_snapshot_has_documented_columns(spark):
    df = asset_feature_snapshot(I.assets(spark, SF_SMALL), I.maintenance_log(spark, SF_SMALL),
                                I.sensors(spark, SF_SMALL), "2024-01-30")
    assert df.columns == ["asset_id", "snapshot_date", "asset_type", "install_date", "material", "asset_age_days",
                          "avg_pressure_30d", "max_vibration_7d", "days_since_last_maintenance", "failure_event"]
    assert df.count() == I.assets(spark, SF_SMALL).count()


def test_all_null_asset_day_is_kept_with_null_mean(spark):
    import datetime as dt
    s = spark.createDataFrame([("A", dt.datetime(2024, 1, 1), "pressure", None),
                               ("A", dt.datetime(2024, 1, 2), "pressure", 4.0)],
                              "asset_id string, reading_ts timestamp_ntz, sensor string, value double")
    got = {r.report_date: r.avg_pressure_30d for r in rolling_mean(s).collect()}
    assert got == {"2024-01-01": None, "2024-01-02": 4.0}


def test_snapshot_joins_reuse_the_asset_partitioning(spark):
    """Without broadcasts (as at scale) each input is shuffled once and the
    chained joins on asset_id reuse that partitioning: 6 exchanges, none
    between the joins."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = asset_feature_snapshot(I.assets(spark, SF_SMALL), I.maintenance_log(spark, SF_SMALL),
                                    I.sensors(spark, SF_SMALL), "2024-01-30")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("SortMergeJoin") == 3
    assert plan.count("Exchange hashpartitioning") == 6
