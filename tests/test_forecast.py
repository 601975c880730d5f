"""Harmonic forecast: coefficients against numpy, backtest against a loop."""

import datetime as dt
import math
import random

import numpy as np
import pytest

from meterflow.operators.forecast import (demand_forecast_harmonic, demand_series, forecast_backtest, frequencies,
                                          harmonic_fit)

T0 = dt.datetime(2024, 1, 1)
EPOCH = dt.datetime(1970, 1, 1)
KIND = "meter_id string, reading_ts timestamp_ntz, consumption_kl double"


def _demand(h, rng):
    return 20 + 0.01 * h + 6 * math.sin(2 * math.pi * h / 24) + 3 * math.cos(2 * math.pi * h / 168) + rng.gauss(0, 1)


def _rows(weeks=6, seed=4):
    rng, rows = random.Random(seed), []
    for d, scale in (("AAA", 1.0), ("BBB", 40.0)):
        for h in range(weeks * 168):
            if rng.random() < 0.9:
                v = round(_demand(h, rng) * scale, 4)
                part = round(v / 3, 4)
                rows += [(f"{d}-1", T0 + dt.timedelta(hours=h, minutes=5), part), (f"{d}-2", T0 + dt.timedelta(hours=h, minutes=50), round(v - part, 4))]
    return rows + [("AAA-1", None, 5.0), (None, T0, 5.0), ("BBB-1", T0, None), ("BBB-1", T0, float("nan"))]


def _series(rows):
    out = {}
    for m, t, v in rows:
        if m is not None and t is not None and v is not None and v == v:
            at = int((t - EPOCH).total_seconds() // 3600)
            out.setdefault(m[:3], {}).setdefault(at, []).append(round(v * 10_000))
    return {d: {at: sum(u) / 10_000 for at, u in hours.items()} for d, hours in out.items()}


def _x(at, first):
    row = [1.0, (at - first) / 168]
    for f in frequencies():
        row += [math.cos(2 * math.pi * f * (at % 168) / 168), math.sin(2 * math.pi * f * (at % 168) / 168)]
    return row


def _fit(hours):
    first = min(hours)
    x = np.array([_x(at, first) for at in sorted(hours)])
    return first, np.linalg.lstsq(x, np.array([hours[at] for at in sorted(hours)]), rcond=None)[0]


def test_coefficients_equal_numpy(spark):
    want = _series(_rows())
    got = {r.district: r for r in harmonic_fit(demand_series(spark.createDataFrame(_rows(), KIND))).collect()}
    assert set(got) == set(want) == {"AAA", "BBB"}
    for d, hours in want.items():
        assert (got[d]["first"], got[d]["last"], got[d].hours) == (min(hours), max(hours), len(hours))
        np.testing.assert_allclose(got[d].coefficients, _fit(hours)[1], rtol=1e-9, atol=1e-9)


def test_backtest_equals_a_loop_and_beats_naive(spark):
    rows = _rows()
    got = {r.district: r for r in forecast_backtest(spark.createDataFrame(rows, KIND), 2).collect()}
    for d, hours in _series(rows).items():
        until = max(hours) - 2 * 168
        train = {at: v for at, v in hours.items() if at <= until}
        first, c = _fit(train)
        off, naive = [], []
        for at, v in hours.items():
            same = [w for a, w in train.items() if a % 168 == at % 168]
            if at > until and same:
                off.append(max(float(np.dot(_x(at, first), c)), 0.0) - v)
                naive.append(sum(same) / len(same) - v)
        r = got[d]
        assert (r.hours_fitted, r.hours_tested) == (len(train), len(off))
        np.testing.assert_allclose([r.mae_kl, r.naive_mae_kl, r.rmse_kl, r.naive_rmse_kl],
                                   [np.mean(np.abs(off)), np.mean(np.abs(naive)), np.mean(np.square(off)) ** 0.5, np.mean(np.square(naive)) ** 0.5], rtol=1e-9)
        assert r.rmse_kl < r.naive_rmse_kl


def test_forecast_continues_each_district_from_its_own_last_hour(spark):
    rows = [r for r in _rows() if not (r[0] == "BBB-1" or r[0] == "BBB-2") or (r[1] and r[1] < T0 + dt.timedelta(weeks=5))]
    hours = _series(rows)
    got = demand_forecast_harmonic(spark.createDataFrame(rows, KIND), 48).collect()
    for d in hours:
        first, c = _fit(hours[d])
        mine = {int((r.forecast_ts - EPOCH).total_seconds() // 3600): r.forecast_kl for r in got if r.district == d}
        assert sorted(mine) == list(range(max(hours[d]) + 1, max(hours[d]) + 49))
        np.testing.assert_allclose([mine[at] for at in sorted(mine)], [np.dot(_x(at, first), c) for at in sorted(mine)], rtol=1e-9)


def test_too_few_hours(spark):
    one = [("ONE-1", T0, 7.5)]
    got = demand_forecast_harmonic(spark.createDataFrame(one, KIND), 3).collect()
    assert [(r.district, r.forecast_kl) for r in got] == [("ONE", 7.5)] * 3
    back = forecast_backtest(spark.createDataFrame(one, KIND)).collect()
    assert [tuple(r) for r in back] == [("ONE", 0, 0, None, None, None, None)]
    # A falling trend ends at nothing, not below.
    few = [("TWO-1", T0, 9.0), ("TWO-1", T0 + dt.timedelta(hours=1), 1.0)]
    assert [r.forecast_kl for r in demand_forecast_harmonic(spark.createDataFrame(few, KIND), 2).collect()] == [0.0, 0.0]
    assert demand_forecast_harmonic(spark.createDataFrame([], KIND)).collect() == []
    assert forecast_backtest(spark.createDataFrame([], KIND)).collect() == []


def test_terms_that_repeat_are_refused():
    for daily, weekly in ((12, 0), (0, 7), (-1, 0)):
        with pytest.raises(ValueError):
            frequencies(daily, weekly)


def test_one_shuffle_of_the_readings_and_no_python(spark):
    plan = demand_forecast_harmonic(spark.createDataFrame(_rows(), KIND))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan and "SinglePartition" not in plan
