import os

import pytest

from meterflow.operators import quality as Q
from meterflow.plans.gold import run_silver_to_gold
from meterflow.plans.silver import BronzePaths, run_bronze_to_silver
from meterflow.sources import fixtures as fx
from meterflow.sources.tables import path_exists, read_table
from tests.conftest import SF_SMALL


def _land(spark, tmp_dir):
    ev = fx.table(spark, SF_SMALL, "events")
    o, li = fx.table(spark, SF_SMALL, "orders"), fx.table(spark, SF_SMALL, "lineitem")
    return BronzePaths(
        fx.land_json(fx.sensus_from_events(ev), os.path.join(tmp_dir, "b/sensus")),
        fx.land_json(fx.itron_from_events(ev), os.path.join(tmp_dir, "b/itron")),
        fx.land_json(fx.asset_master_from_orders(o, li), os.path.join(tmp_dir, "b/asset")),
    ), fx.land_csv(fx.maintenance_log_from_lineitem(li, o), os.path.join(tmp_dir, "b/log"))


def test_bronze_to_gold_end_to_end(spark, tmp_dir):
    src, log = _land(spark, tmp_dir)
    silver, gold, lin = (os.path.join(tmp_dir, x) for x in ("silver", "gold", "lineage"))
    rep = run_bronze_to_silver(spark, src, silver, lineage_path=lin)
    assert all(r.success for r in rep.collect())
    run_silver_to_gold(spark, silver, gold, maintenance_log=log, as_of="2001-12-31", lineage_path=lin)
    n = read_table(spark, gold + "/nrw_daily_summary")
    assert n.count() > 0 and "report_date" in n.columns
    assert read_table(spark, gold + "/asset_failure_features").count() == fx.table(spark, SF_SMALL, "orders").count()
    edges = read_table(spark, lin).collect()
    assert len(edges) == 5 and all(e.downstream_rows is not None for e in edges)
    # daily refresh of a range of days leaves other days untouched
    before = {r.report_date: r for r in n.collect()}
    run_silver_to_gold(spark, silver, gold, maintenance_log=log, as_of="2001-12-31",
                       refresh_days=("2024-01-10", "2024-01-12"), lineage_path=lin)
    after = {r.report_date: r for r in read_table(spark, gold + "/nrw_daily_summary").collect()}
    assert before.keys() == after.keys()


def test_failing_gate_publishes_nothing(spark, tmp_dir):
    src, _ = _land(spark, tmp_dir)
    silver = os.path.join(tmp_dir, "silver")
    with pytest.raises(Q.DataQualityError):
        run_bronze_to_silver(spark, src, silver, rules=[Q.in_range("consumption_kl", 0, 1)])
    assert not path_exists(spark, silver + "/fct_meter_readings")


def test_multiline_json_feed(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ml.json")
    with open(p, "w") as fh:
        fh.write('[\n {"meter_id": "SEN-1", "timestamp_utc": "2024-01-01T00:00:00Z",\n'
                 '  "reading_data": {"flow_kl": 1.5}},\n'
                 ' {"meter_id": "SEN-2", "timestamp_utc": "2024-01-01T01:00:00Z", "reading_data": {"flow_kl": 2}}\n]')
    from meterflow.sources.bronze import read_sensus
    rows = read_sensus(spark, p, multiline=True).collect()
    assert [(r.meter_id, r.reading_data.flow_kl) for r in rows] == [("SEN-1", 1.5), ("SEN-2", 2.0)]


def test_refresh_prunes_silver_partitions(spark, tmp_dir):
    src, log = _land(spark, tmp_dir)
    silver = os.path.join(tmp_dir, "silver")
    run_bronze_to_silver(spark, src, silver)
    fact = read_table(spark, silver + "/fct_meter_readings")
    assert "reading_date" in fact.columns
    from pyspark.sql import functions as F
    q = fact.where((F.col("reading_date") >= F.lit("2024-01-10").cast("date")))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reading_date" in plan


def test_unmatched_meter_keeps_reading_with_null_asset(spark):
    import datetime as dt
    from meterflow.operators.assets import readings_with_asset
    r = spark.createDataFrame([("SEN-1", dt.datetime(2024, 1, 1), 1.0), ("SEN-999", dt.datetime(2024, 1, 1), 2.0)],
                              "meter_id string, reading_ts timestamp_ntz, consumption_kl double")
    dim = spark.createDataFrame([("MTR-1", "Pump", "M", 1.0, 2.0)],
                                "asset_id string, asset_type string, manufacturer string, latitude double, longitude double")
    got = {x.meter_id: x.asset_type for x in readings_with_asset(r, dim).collect()}
    assert got == {"SEN-1": "Pump", "SEN-999": None}


def test_csv_feeds_conform_like_json(spark, tmp_dir):
    from pyspark.sql import functions as F

    from meterflow.operators.conform import fct_meter_readings
    from meterflow.sources.bronze import read_feed
    ev = fx.table(spark, SF_SMALL, "events")
    s, i = fx.sensus_from_events(ev), fx.itron_from_events(ev)
    s_csv = os.path.join(tmp_dir, "s_csv")
    s.select("meter_id", "timestamp_utc", F.col("reading_data.flow_kl").alias("flow_kl")) \
        .write.option("header", "true").csv(s_csv)
    i_csv = os.path.join(tmp_dir, "i_csv")
    i.write.option("header", "true").csv(i_csv)
    a = fct_meter_readings(read_feed(spark, s_csv, "sensus", "csv"), read_feed(spark, i_csv, "itron", "csv"))
    b = fct_meter_readings(s, i)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    silver = os.path.join(tmp_dir, "silver")
    rep = run_bronze_to_silver(spark, BronzePaths(s_csv, i_csv, None, feed_format="csv"), silver)
    assert all(r.success for r in rep.collect())


def test_gold_summary_is_one_file_per_day(spark, tmp_dir):
    import glob
    src, log = _land(spark, tmp_dir)
    silver, gold = os.path.join(tmp_dir, "silver"), os.path.join(tmp_dir, "gold")
    run_bronze_to_silver(spark, src, silver)
    run_silver_to_gold(spark, silver, gold, maintenance_log=log, as_of="2001-12-31")
    days = glob.glob(gold + "/nrw_daily_summary/report_date=*")
    assert days and all(len(glob.glob(d + "/*.parquet")) == 1 for d in days)


def test_silver_rerun_is_idempotent_and_gold_documented_form(spark, tmp_dir):
    src, log = _land(spark, tmp_dir)
    silver, gold = os.path.join(tmp_dir, "silver"), os.path.join(tmp_dir, "gold")
    run_bronze_to_silver(spark, src, silver)
    first = sorted(map(tuple, read_table(spark, silver + "/fct_meter_readings").collect()))
    run_bronze_to_silver(spark, src, silver)
    assert sorted(map(tuple, read_table(spark, silver + "/fct_meter_readings").collect())) == first
    districts = spark.createDataFrame([("SEN", "Sensus district", "North"), ("ITR", "Itron district", "South")],
                                      "district_id string, district_name string, region_name string")
    run_silver_to_gold(spark, silver, gold, maintenance_log=log, as_of="2001-12-31", districts=districts)
    g = read_table(spark, gold + "/nrw_daily_summary")
    assert {"district_id", "district_name", "apparent_loss_kl", "real_loss_kl"} <= set(g.columns)
    assert g.where("district_name IS NULL").count() == 0


def test_stream_silver_is_partitioned_by_day(spark, tmp_dir):
    from meterflow.streaming import jobs as ST
    src, _ = _land(spark, tmp_dir)
    out, ck = os.path.join(tmp_dir, "s_out"), os.path.join(tmp_dir, "s_ck")
    ST.start_conform(spark, src.sensus, src.itron, out, ck).awaitTermination()
    import glob
    assert glob.glob(out + "/reading_date=2024-01-*")


def test_cluster_days_writes_few_files_per_day(spark, tmp_dir):
    import glob
    src, _ = _land(spark, tmp_dir)
    silver = os.path.join(tmp_dir, "silver")
    run_bronze_to_silver(spark, src, silver, cluster_days=True)
    days = glob.glob(silver + "/fct_meter_readings/reading_date=*")
    assert days and sum(len(glob.glob(d + "/*.parquet")) for d in days) <= len(days) + 8
    assert read_table(spark, silver + "/fct_meter_readings").count() == fx.table(spark, SF_SMALL, "events").count()


def test_weekly_feature_snapshots_keep_history(spark, tmp_dir):
    from meterflow.plans.gold import run_feature_snapshot
    src, log = _land(spark, tmp_dir)
    silver, gold = os.path.join(tmp_dir, "silver"), os.path.join(tmp_dir, "gold")
    run_bronze_to_silver(spark, src, silver)
    sensors = fx.sensor_readings_from_events(fx.table(spark, SF_SMALL, "events"))
    for day in ("2024-01-16", "2024-01-23", "2024-01-23"):  # a re-run replaces its own date
        p = run_feature_snapshot(spark, silver, gold, log, sensors, day)
    t = spark.read.parquet(p)
    n_assets = fx.table(spark, SF_SMALL, "orders").count()
    assert t.count() == 2 * n_assets
    assert {str(r.snapshot_date) for r in t.select("snapshot_date").distinct().collect()} == {"2024-01-16", "2024-01-23"}
