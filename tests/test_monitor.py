"""The monitored stream: open days, late and untimed rows, restarts and repeated batches."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from meterflow.functions.rules import billed_by_suffix
from meterflow.plans import inputs as I
from meterflow.sources import fixtures as fx
from meterflow.streaming import monitor as SM
from tests.conftest import SF_SMALL

FLAT = "itron_device_id string, read_datetime string, consumption_m3 double"
HOUR = dt.timedelta(hours=1)


def _land(spark, rows, path):
    spark.createDataFrame(rows, FLAT).coalesce(1).write.mode("overwrite").json(path)


def _days(spark, out):
    return {(str(r.report_date), r.closed): r.total_supplied_kl for r in SM.current_days(spark, out).collect()}


def _counts(spark, out):
    return {r.status: r.readings for r in SM.row_counts(spark, out).collect()}


def test_open_days_late_and_untimed_rows_across_a_restart(spark, tmp_dir):
    land, out, ck = (os.path.join(tmp_dir, n) for n in ("land", "out", "ck"))
    run = lambda: SM.start_monitor(spark, None, land + "/*", out, ck, billed_by_suffix(), HOUR).awaitTermination()
    _land(spark, [("ITR-1", "2024-01-01T10:00:00", 1.0), ("ITR-1", "2024-01-03T10:00:00", 2.0), ("ITR-1", "never", 9.0), ("ITR-1", None, 9.0)], land + "/1")
    run()
    assert _days(spark, out) == {("2024-01-01", True): 1.0, ("2024-01-03", False): 2.0}
    assert _counts(spark, out) == {"accepted": 2, "untimed": 2}
    _land(spark, [("ITR-1", "2024-01-01T11:00:00", 100.0), ("ITR-1", "2024-01-03T01:00:00", 4.0), ("ITR-1", "2024-01-04T00:30:00", 8.0)], land + "/2")
    run()
    # 3 January stays open for an hour after midnight.
    assert _days(spark, out) == {("2024-01-01", True): 1.0, ("2024-01-03", False): 6.0, ("2024-01-04", False): 8.0}
    assert _counts(spark, out) == {"accepted": 4, "late": 1, "untimed": 2}
    assert [r.consumption_kl for r in spark.read.parquet(out + "/late").collect()] == [100.0]
    run()  # nothing new
    assert sum(_counts(spark, out).values()) == 7


def test_a_batch_run_again_replaces_itself(spark, tmp_dir):
    """As after a crash between a batch's write and its commit, with a summary written in between."""
    kind = "meter_id string, reading_ts timestamp_ntz, consumption_kl double"
    at = lambda day, h=0: dt.datetime(2024, 1, day, h)
    batches = [[("ITR-1", at(1, 5), 1.0)], [("ITR-1", at(2, 3), 2.0), ("ITR-1", at(1, 7), 4.0)], [("ITR-1", at(1, 9), 8.0), ("ITR-1", None, 1.0)]]
    for order in ([0, 1, 2], [0, 0, 1, 1, 1, 2, 2]):
        out = os.path.join(tmp_dir, f"out{len(order)}")
        for i in order:
            SM.add_batch(spark.createDataFrame(batches[i], kind), i, out, HOUR, billed_by_suffix(), compact_every=2)
        assert _days(spark, out) == {("2024-01-01", True): 5.0, ("2024-01-02", False): 2.0}
        assert _counts(spark, out) == {"accepted": 3, "late": 1, "untimed": 1}
        assert SM._compacted(spark, out, None) == 1 and SM._compacted(spark, out, 1) == -1


@pytest.mark.parametrize("files", [1, None])
def test_equals_the_batch_summary_when_nothing_is_late(spark, tmp_dir, files):
    ev = fx.table(spark, SF_SMALL, "events")
    land, out, ck = (os.path.join(tmp_dir, n) for n in ("land", "out", "ck"))
    for half, cond in enumerate(("ts < timestamp_ntz '2024-01-15 12:00:00'", "ts >= timestamp_ntz '2024-01-15 12:00:00'")):
        fx.land_json(fx.sensus_from_events(ev.where(cond)).coalesce(1), f"{land}/s/{half}")
        fx.land_json(fx.itron_from_events(ev.where(cond)).coalesce(1), f"{land}/i/{half}")
        SM.start_monitor(spark, land + "/s/*", land + "/i/*", out, ck, I.billing_rule(), HOUR, max_files_per_trigger=files).awaitTermination()
    got = SM.current_days(spark, out, decimals=6)
    want = I.event_summary(spark, SF_SMALL)
    assert sorted(map(str, got.drop("closed").collect())) == sorted(map(str, want.select(*got.columns[:-1]).collect()))
    assert [str(r[0]) for r in got.where(~F.col("closed")).select("report_date").distinct().collect()] == ["2024-01-30"]
    assert _counts(spark, out) == {"accepted": ev.count()}


def test_nothing_landed_yet(spark, tmp_dir):
    out = os.path.join(tmp_dir, "none")
    assert SM.current_days(spark, out).collect() == [] and SM.row_counts(spark, out).collect() == [] and SM.watermark(spark, out, HOUR) is None
