"""Refreshes that find their own days; deliveries that are repeated."""

import os

import pytest

from meterflow.functions.rules import billed_by_suffix
from meterflow.plans import refresh as RF
from meterflow.sources import schemas
from meterflow.streaming import jobs as ST

FLAT = "itron_device_id string, read_datetime string, consumption_m3 double"


def _land(spark, rows, path):
    spark.createDataFrame(rows, FLAT).coalesce(1).write.mode("overwrite").json(path)


class Lake:
    def __init__(self, spark, base):
        self.spark, self.base = spark, base
        self.land, self.silver, self.gold, self.manifest = (os.path.join(base, n) for n in ("land", "silver", "gold", "manifest"))

    def refresh(self, **how):
        return RF.refresh_new_files(self.spark, {"itron": self.land}, self.silver, self.gold, self.manifest, billed_by_suffix(), **how)

    def days(self):
        return {str(r.report_date): r.total_supplied_kl for r in self.spark.read.parquet(self.gold).collect()}


@pytest.fixture()
def lake(spark, tmp_dir):
    return Lake(spark, tmp_dir)


def test_each_refresh_finds_its_own_days(spark, lake):
    _land(spark, [("ITR-1", "2024-01-01T10:00:00", 1.0), ("ITR-1", "2024-01-02T10:00:00", 2.0)], lake.land + "/a")
    assert lake.refresh() == ["2024-01-01", "2024-01-02"]
    _land(spark, [("ITR-1", "2024-01-03T10:00:00", 4.0), ("ITR-2", "no time", 16.0)], lake.land + "/b")
    assert lake.refresh() == ["2024-01-03", "None"]
    _land(spark, [("ITR-1", "2024-01-01T23:00:00", 8.0)], lake.land + "/c")  # late, for an old day
    untouched = {f: os.path.getmtime(os.path.join(lake.gold, "report_date=2024-01-02", f)) for f in os.listdir(lake.gold + "/report_date=2024-01-02")}
    assert lake.refresh() == ["2024-01-01"]
    assert lake.days() == {"2024-01-01": 9.0, "2024-01-02": 2.0, "2024-01-03": 4.0, "None": 16.0}
    assert untouched == {f: os.path.getmtime(os.path.join(lake.gold, "report_date=2024-01-02", f)) for f in untouched}
    assert lake.refresh() == [] and RF.committed_loads(spark, lake.manifest) == 3


def test_a_crash_before_the_commit_repeats_safely(spark, lake):
    class Died(Exception):
        pass

    def die():
        raise Died

    _land(spark, [("ITR-1", "2024-01-01T10:00:00", 1.0)], lake.land + "/a")
    lake.refresh()
    _land(spark, [("ITR-1", "2024-01-01T11:00:00", 2.0), ("ITR-1", "2024-01-05T11:00:00", 2.0)], lake.land + "/b")
    with pytest.raises(Died):
        lake.refresh(before_commit=die)
    assert lake.days()["2024-01-01"] == 3.0 and RF.committed_loads(spark, lake.manifest) == 1
    _land(spark, [("ITR-1", "2024-01-06T11:00:00", 4.0)], lake.land + "/c")
    assert lake.refresh() == ["2024-01-01", "2024-01-05", "2024-01-06"]
    assert lake.days() == {"2024-01-01": 3.0, "2024-01-05": 2.0, "2024-01-06": 4.0}
    assert spark.read.parquet(lake.silver).count() == 4


def test_a_taken_file_that_changes_is_reported(spark, lake):
    _land(spark, [("ITR-1", "2024-01-01T10:00:00", 1.0)], lake.land + "/a")
    lake.refresh()
    name, = [f for f in os.listdir(lake.land + "/a") if f.endswith(".json")]
    with open(os.path.join(lake.land, "a", name), "a") as f:
        f.write('{"itron_device_id": "ITR-9", "read_datetime": "2024-01-01T10:00:00", "consumption_m3": 5.0}\n')
    with pytest.raises(RF.LandedFileChanged):
        lake.refresh()


def test_append_new_is_exact_and_repeatable(spark, tmp_dir):
    from meterflow.operators.conform import fct_meter_readings
    path = tmp_dir + "/silver"
    no = spark.createDataFrame([], schemas.SENSUS)
    make = lambda rows: fct_meter_readings(no, spark.createDataFrame(rows, FLAT))
    first = [("ITR-1", "2024-01-01T10:00:00", 1.0), ("ITR-1", "2024-01-01T10:00:00", 1.0), ("ITR-1", None, 1.0), (None, "2024-01-02T10:00:00", None)]
    RF.append_new(make(first), path)
    RF.append_new(make(first), path)
    assert spark.read.parquet(path).count() == 3
    RF.append_new(make(first + [("ITR-1", "2024-01-01T10:00:00", 2.0), ("ITR-2", "bad", 1.0)]), path)
    assert sorted(str(r.consumption_kl) for r in spark.read.parquet(path).collect()) == ["1.0", "1.0", "1.0", "2.0", "None"]


@pytest.mark.parametrize("exact", [True, False])
def test_files_landed_twice_change_nothing_across_a_restart(spark, tmp_dir, exact):
    land, out, ck = (os.path.join(tmp_dir, n) for n in ("land", "out", "ck"))
    run = lambda: (ST.start_conform_once(spark, None, land + "/*", out, ck) if exact
                   else ST.start_conform(spark, None, land + "/*", out, ck, once="10 days")).awaitTermination()
    rows = [("ITR-1", f"2024-01-0{i}T00:00:00", float(i)) for i in range(1, 4)]
    _land(spark, rows, land + "/a")
    run()
    _land(spark, rows + [("ITR-1", "2024-01-02T05:00:00", 9.0)], land + "/b")  # sent again, with one that is late and new
    run()
    assert sorted(r.consumption_kl for r in spark.read.parquet(out).collect()) == [1.0, 2.0, 3.0, 9.0]
