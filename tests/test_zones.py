"""Library operators give the same rows whatever the session time zone."""

import pytest

from meterflow.functions.rules import billed_by_suffix
from meterflow.operators import charts as C
from meterflow.operators.ml import demand_forecast_naive
from meterflow.operators.nrw import nrw_daily_summary
from meterflow.operators.sensors import rolling_mean, sensor_snapshot
from meterflow.sources import fixtures as fx
from meterflow.operators.conform import fct_meter_readings, dim_asset
from meterflow.operators.assets import asset_failure_features
from tests.conftest import SF_SMALL


def _all(spark):
    ev = fx.table(spark, SF_SMALL, "events")
    r = fct_meter_readings(fx.sensus_from_events(ev), fx.itron_from_events(ev))
    s = fx.sensor_readings_from_events(ev)
    o, li = fx.table(spark, SF_SMALL, "orders"), fx.table(spark, SF_SMALL, "lineitem")
    dim = dim_asset(fx.asset_master_from_orders(o, li))
    out = {
        "summary": nrw_daily_summary(r, billed_by_suffix(), decimals=6),
        "profile": C.hourly_profile(r, 6),
        "rolling": rolling_mean(s),
        "snapshot": sensor_snapshot(s, "2024-01-20"),
        "forecast": demand_forecast_naive(r, 48, 6),
        "features": asset_failure_features(dim, fx.maintenance_log_from_lineitem(li), "2001-12-31"),
    }
    return {k: sorted(map(tuple, v.collect()), key=repr) for k, v in out.items()}


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_operators_are_zone_independent(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        base = _all(spark)
        spark.conf.set("spark.sql.session.timeZone", zone)
        other = _all(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    for k in base:
        assert base[k] == other[k], k
