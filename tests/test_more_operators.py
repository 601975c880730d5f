import datetime as dt

from meterflow import api
from meterflow.operators import nrw as N
from meterflow.plans import inputs as I
from tests.conftest import SF_SMALL


def test_validate_readings_reports_failure(spark):
    s = spark.createDataFrame([(None, "2024-01-01T00:00:00Z", (1.5,)), ("SEN-1", "bad", (2.0,))],
                              "meter_id string, timestamp_utc string, reading_data struct<flow_kl: double>")
    v = api.validate_readings(api.conform_meter_data(s, None))
    assert v["success"] is False
    failed = {r["rule"]: r["failed"] for r in v["results"]}
    assert failed["meter_id_not_null"] == 1 and failed["timestamp_parses"] == 1


def test_per_district_targets(spark):
    summary = spark.createDataFrame(
        [("2024-01-01", "SEN", 12.0), ("2024-01-01", "ITR", 8.0), ("2024-01-01", "DAB", 20.0)],
        "report_date string, district string, nrw_percent double")
    targets = spark.createDataFrame([("SEN", 15.0), ("ITR", 5.0)], "district string, target_percent double")
    got = {r.district: (r.target_percent, r.above_target) for r in
           N.nrw_vs_target(summary, 10.0, targets).collect()}
    assert got == {"SEN": (15.0, False), "ITR": (5.0, True), "DAB": (10.0, True)}


def test_district_names_join_is_broadcast(spark):
    df = N.with_district_name(I.lineitem_summary(spark, SF_SMALL, "nation"), I.districts(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert df.where("district_name IS NULL").count() == 0
