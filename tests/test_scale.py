"""Hot keys and shared-storage behaviour."""

import datetime as dt

from pyspark.sql import functions as F

from meterflow import api
from meterflow.functions.rules import billed_by_suffix
from meterflow.operators.nrw import nrw_daily_summary
from meterflow.operators.sensors import rolling_mean
from meterflow.session import checkpoint_dir, ensure_checkpoint_dir, scratch_path
from tests.conftest import SF_SMALL


def _hot_readings(spark, n=30_000):
    # One meter holds a third of all readings.
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("SEN-1")).otherwise(F.concat(F.lit("ITR-"), (F.col("id") % 97).cast("string")))
        .alias("meter_id"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id") % 2880))
        .alias("reading_ts"),
        ((F.col("id") % 100) / 10.0).alias("consumption_kl"),
    )
    return base


def test_hot_meter_is_combined_map_side(spark):
    df = _hot_readings(spark)
    s = nrw_daily_summary(df, billed_by_suffix())
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and plan.count("Exchange hashpartitioning") == 1
    total = s.agg(F.sum("total_supplied_kl")).first()[0]
    assert abs(total - df.agg(F.sum("consumption_kl")).first()[0]) < 1e-6


def test_hot_asset_window_sees_one_row_per_day(spark):
    df = _hot_readings(spark).select(
        F.col("meter_id").alias("asset_id"), "reading_ts", F.lit("pressure").alias("sensor"),
        F.col("consumption_kl").alias("value"))
    r = rolling_mean(df)
    # The window input is the (asset, day) aggregate: the hot asset has 2 days here.
    assert r.where(F.col("asset_id") == "SEN-1").count() == 2


def test_checkpoint_dir_from_session_is_used(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and checkpoint_dir(spark) == d
    p = scratch_path(spark, "x")
    assert p.startswith(d.rstrip("/") + "/meterflow/x-")


def test_api_stages(spark):
    import pytest

    from meterflow.plans.gold import failure_rule_by_hash

    s = spark.createDataFrame([("SEN-1", "2024-01-01T00:00:00Z", (1.5,))],
                              "meter_id string, timestamp_utc string, reading_data struct<flow_kl: double>")
    i = spark.createDataFrame([("ITR-1", "2024-01-01T01:00:00", 2.5)],
                              "itron_device_id string, read_datetime string, consumption_m3 double")
    fact = api.conform_meter_data(s, i)
    v = api.validate_readings(fact)
    assert v["success"] and len(v["results"]) == 5
    assert api.nrw_summary(fact).count() == 2
    m = spark.createDataFrame([("MTR-1", "Pump", "2020-01-01", "2023-01-01", "M", "X-1", (1.0, 2.0))],
                              "asset_id string, asset_type string, install_date string, last_maintenance_date string, "
                              "manufacturer string, model_number string, location struct<latitude: double, longitude: double>")
    with pytest.raises(ValueError):
        api.asset_features(api.asset_dimension(m), as_of="2024-01-01")  # labels are never made up silently
    f = api.asset_features(api.asset_dimension(m), as_of="2024-01-01", failure_rule=failure_rule_by_hash()).first()
    assert f["asset_age_days"] == 1461 and f["failure_event"] in (0, 1)


def test_cluster_without_checkpoint_dir_refuses_local_folder(monkeypatch, spark):
    import pytest

    from meterflow import session as S

    class FakeSC:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class FakeConf:
        def get(self, k, default=None):
            return default

    class Fake:
        sparkContext = FakeSC()
        conf = FakeConf()

    with pytest.raises(S.CheckpointDirMissing):
        S.ensure_checkpoint_dir(Fake())


def test_hot_meter_join_is_split_by_aqe_skew_join(spark):
    """readings_with_asset when the dimension is too big to broadcast: a
    meter holding a third of the readings is split across tasks by AQE's
    skew join instead of landing in one task."""
    from meterflow.operators.assets import readings_with_asset

    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        r = _hot_readings(spark, 30_000).withColumn("meter_id", F.regexp_replace("meter_id", "ITR-", "SEN-"))
        dim = spark.range(0, 200).select(
            F.concat(F.lit("MTR-"), F.col("id").cast("string")).alias("asset_id"), F.lit("Pump").alias("asset_type"),
            F.lit("M").alias("manufacturer"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"))
        j = readings_with_asset(r, dim, max_broadcast_rows=10)
        assert len(j.collect()) == 30_000  # executes j itself: its final adaptive plan is then visible
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_and_feed_filters_reach_the_scan(spark):
    from meterflow.plans.registry import QUERIES
    p = _plan(QUERIES["sql_last_30_days"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p
    assert "In(event_type, [click,purchase,view]" in _plan(QUERIES["conform_sensus"](spark, SF_SMALL))
    assert "Or(Not(In(event_type" in _plan(QUERIES["conform_itron"](spark, SF_SMALL))


def test_line_items_are_read_and_shuffled_once_for_the_assets(spark):
    from meterflow.plans.registry import QUERIES
    for key in ("asset_feature_snapshot", "asset_failure_features"):
        # A frame of its own: the input plans are shared, and one that ran shows its final plan too.
        p = _plan(QUERIES[key](spark, SF_SMALL).select("*"))
        assert p.count("lineitem.parquet") == 1 and p.count("SortAggregate") == 0


def test_size_check_sends_one_row_a_task(spark):
    from pyspark.sql import functions as F

    from meterflow.operators.joins import measured_size
    df = spark.range(0, 1000, 1, 7).withColumn("s", F.col("id").cast("string"))
    assert measured_size(df)[0] == 1000
    assert "Limit" not in _plan(df.agg(F.count(F.lit(1))))
