import datetime as dt
import os

from pyspark.sql import functions as F

from meterflow.plans import inputs as I
from meterflow.sources import fixtures as fx
from meterflow.streaming import jobs as ST
from tests.conftest import SF_SMALL


def test_stream_daily_nrw_equals_batch_on_closed_days(spark, tmp_dir):
    ev = fx.table(spark, SF_SMALL, "events")
    sd = fx.land_json(fx.sensus_from_events(ev), os.path.join(tmp_dir, "s"))
    idir = fx.land_json(fx.itron_from_events(ev), os.path.join(tmp_dir, "i"))
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    q = ST.start_daily_nrw(spark, sd, idir, out, ck, I.billing_rule(), "1 hour", decimals=6)
    q.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(out).select(
        "report_date", "district", "total_supplied_kl", "total_billed_kl", "nrw_kl", "nrw_percent").collect()))
    batch = I.event_summary(spark, SF_SMALL)
    last_day = batch.agg(F.max("report_date")).first()[0]
    want = sorted(map(tuple, batch.where(F.col("report_date") < last_day).collect()))
    assert got == want and len(got) > 0


def test_late_rows_are_dropped_after_the_watermark(spark, tmp_dir):
    land = os.path.join(tmp_dir, "land")
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")

    def batch(rows, name):
        df = spark.createDataFrame(rows, "itron_device_id string, read_datetime string, consumption_m3 double")
        df.coalesce(1).write.mode("overwrite").json(os.path.join(land, name))

    from meterflow.functions.rules import billed_by_suffix
    batch([("ITR-1", "2024-01-01T10:00:00", 1.0), ("ITR-1", "2024-01-03T10:00:00", 2.0)], "b1")
    q = ST.start_daily_nrw(spark, None, land + "/*", out, ck, billed_by_suffix(), "1 hour")
    q.awaitTermination()
    # A row for Jan 1 arrives after the watermark passed Jan 3 09:00: dropped.
    # A row for Jan 3 12:00 is on time.
    batch([("ITR-1", "2024-01-01T11:00:00", 100.0), ("ITR-1", "2024-01-03T12:00:00", 3.0),
           ("ITR-1", "2024-01-05T12:00:00", 1.0)], "b2")
    q = ST.start_daily_nrw(spark, None, land + "/*", out, ck, billed_by_suffix(), "1 hour")
    q.awaitTermination()
    got = {str(r.report_date): r.total_supplied_kl for r in spark.read.parquet(out).collect()}
    assert got == {"2024-01-01": 1.0, "2024-01-03": 5.0}


def test_stream_conform_restarts_from_checkpoint(spark, tmp_dir):
    land = os.path.join(tmp_dir, "land")
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    rows = [("ITR-1", f"2024-01-0{i}T00:00:00", float(i)) for i in range(1, 4)]
    df = spark.createDataFrame(rows, "itron_device_id string, read_datetime string, consumption_m3 double")
    df.write.mode("overwrite").json(os.path.join(land, "a"))
    ST.start_conform(spark, None, land + "/*", out, ck).awaitTermination()
    # Restart with no new files: nothing is written twice (file sink log + checkpoint).
    ST.start_conform(spark, None, land + "/*", out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    assert spark.read.parquet(out).where(F.col("reading_ts") == dt.datetime(2024, 1, 2)).count() == 1


def test_stream_days_do_not_depend_on_session_zone(spark, tmp_dir):
    from meterflow.functions.rules import billed_by_suffix
    land = os.path.join(tmp_dir, "land")
    rows = [("ITR-1", "2024-01-01T23:30:00", 1.0), ("ITR-1", "2024-01-02T00:30:00", 2.0),
            ("ITR-1", "2024-01-04T00:30:00", 4.0)]
    spark.createDataFrame(rows, "itron_device_id string, read_datetime string, consumption_m3 double") \
        .coalesce(1).write.mode("overwrite").json(land)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
        ST.start_daily_nrw(spark, None, land, out, ck, billed_by_suffix(), "1 hour").awaitTermination()
        got = {str(r.report_date): r.total_supplied_kl for r in spark.read.parquet(out).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {"2024-01-01": 1.0, "2024-01-02": 2.0}
