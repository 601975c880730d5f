import os

import pytest

from meterflow.operators import quality as Q
from meterflow.operators.conform import fct_meter_readings
from meterflow.plans.silver import BronzePaths, run_bronze_to_silver
from meterflow.sources.bronze import read_itron, read_maintenance_log, read_sensus
from meterflow.sources.tables import path_exists


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_malformed_line_becomes_null_row_and_fails_the_gate(spark, tmp_dir):
    p = os.path.join(tmp_dir, "sensus", "part.json")
    _write(p, '{"meter_id": "SEN-1", "timestamp_utc": "2024-01-01T00:00:00Z", "reading_data": {"flow_kl": 1.0}}\n'
              '{"meter_id": "SEN-2", "timestamp_utc": "not a time", "reading_data": {"flow_kl": 2.0}}\n'
              'this is not json\n')
    df = read_sensus(spark, os.path.dirname(p))
    assert df.count() == 3
    fact = fct_meter_readings(df, None)
    rep = {r.rule: r.failed for r in Q.evaluate(fact, Q.reading_rules()).collect()}
    assert rep["meter_id_not_null"] == 1 and rep["timestamp_parses"] == 2
    with pytest.raises(Q.DataQualityError):
        run_bronze_to_silver(spark, BronzePaths(os.path.dirname(p), None, None), os.path.join(tmp_dir, "silver"))
    assert not path_exists(spark, os.path.join(tmp_dir, "silver", "fct_meter_readings"))


def test_explicit_schema_ignores_extra_fields_and_fills_missing(spark, tmp_dir):
    p = os.path.join(tmp_dir, "itron", "part.json")
    _write(p, '{"itron_device_id": "ITR-1", "read_datetime": "2024-01-01T00:00:00", "consumption_m3": 0.5, "x": 1}\n'
              '{"itron_device_id": "ITR-2"}\n')
    rows = read_itron(spark, os.path.dirname(p)).collect()
    assert rows[0].consumption_m3 == 0.5 and rows[1].read_datetime is None
    assert read_itron(spark, os.path.dirname(p)).columns == ["itron_device_id", "read_datetime", "consumption_m3"]


def test_maintenance_csv_types(spark, tmp_dir):
    p = os.path.join(tmp_dir, "log", "part.csv")
    _write(p, "asset_id,install_date,asset_type,material,last_maintenance_date,failure_event\n"
              "ASSET-1,2015-03-20,Pipe,PVC,2023-06-01,1\n"
              "ASSET-2,bad-date,Pump,Steel,,0\n")
    rows = read_maintenance_log(spark, os.path.dirname(p)).collect()
    assert str(rows[0].install_date) == "2015-03-20" and rows[0].failure_event == 1
    assert rows[1].install_date is None and rows[1].last_maintenance_date is None
