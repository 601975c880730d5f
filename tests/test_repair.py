"""Repaired series against a loop, with ranges that cut gaps and runs anywhere."""

import datetime as dt
import random
from fractions import Fraction

import pytest

from meterflow.operators.repair import repaired

T0 = dt.datetime(2024, 1, 1)
KIND = "meter_id string, reading_ts timestamp_ntz, consumption_kl double"


def _brute(rows, max_gap, stuck, factor):
    sums = {}
    for m, t, v in rows:
        if m is not None and t is not None and v is not None:
            h = int((t - dt.datetime(1970, 1, 1)).total_seconds() // 3600)
            sums[m, h] = sums.get((m, h), 0) + round(v * 10_000)
    out = []
    for m in {k[0] for k in sums}:
        hours = sorted(h for k, h in sums if k == m)
        for i, h in enumerate(hours):
            u, prev = sums[m, h], hours[i - 1] if i else None
            lo = hi = h
            while sums.get((m, lo - 1)) == u:
                lo -= 1
            while sums.get((m, hi + 1)) == u:
                hi += 1
            missing = h - prev - 1 if i else 0
            reason = [w for w, ok in (("stuck", hi - lo + 1 >= stuck and u > 0), ("reset", i and u * factor < sums[m, prev]), ("after_gap", missing > max_gap)) if ok]
            out.append((m, h, u, ",".join(reason), missing))
            if 1 <= missing <= max_gap:
                for j in range(prev + 1, h):
                    exact = Fraction(sums[m, prev] * (h - j) + u * (j - prev), h - prev)
                    out.append((m, j, int(exact + Fraction(1, 2)), "filled", 0))
    return sorted(out)


def _got(df):
    return sorted((r.meter_id, int((r.step_ts - dt.datetime(1970, 1, 1)).total_seconds() // 3600), round(r.consumption_kl * 10_000), r.reason, r.missing_before)
                  for r in df.collect())


def _rows(seed=2):
    rng, rows = random.Random(seed), []
    for m in ("a", "b", "c"):
        h, v = 0, 5.0
        while h < 400:
            h += rng.choice([1, 1, 1, 1, 2, 3, 6, 30])
            v = rng.choice([v, v, v, 0.0, 0.3, 7.25, 9.1234])
            rows += [(m, T0 + dt.timedelta(hours=h, minutes=10), v / 2)] * 2
    rows += [("a", None, 1.0), (None, T0, 1.0), ("b", T0 + dt.timedelta(hours=500), None), ("one", T0, 3.0)]
    return rows


@pytest.mark.parametrize("range_steps", [1, 7, 720])
def test_matches_a_loop_wherever_ranges_are_cut(spark, range_steps):
    rows = _rows()
    want = _brute(rows, 5, 3, 10)
    assert {r[3] for r in want} >= {"filled", "stuck", "reset", "after_gap", ""}
    assert _got(repaired(spark.createDataFrame(rows, KIND), "hour", 5, 3, 10, range_steps)) == want


def test_accepted_volume_is_unchanged(spark):
    rows = [r for r in _rows(9) if None not in r]
    df = repaired(spark.createDataFrame(rows, KIND)).where("reason <> 'filled'")
    assert round(df.agg({"consumption_kl": "sum"}).first()[0], 4) == round(sum(r[2] for r in rows), 4)


def test_empty_and_no_task_holds_a_whole_series(spark):
    assert repaired(spark.createDataFrame([], KIND)).collect() == []
    plan = repaired(spark.createDataFrame(_rows(), KIND))._jdf.queryExecution().executedPlan().toString()
    # Every window over rows is partitioned by meter and range; those by meter alone are over the summaries.
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_range" in w.split("], [", 1)[1] or "_out_" in w for w in windows)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_days(spark):
    rows = [("m", T0, 1.0), ("m", T0 + dt.timedelta(days=3, hours=5), 2.5), ("m", T0 + dt.timedelta(days=3, hours=9), 1.5)]
    got = sorted((r.step_ts, r.consumption_kl, r.reason, r.missing_before) for r in repaired(spark.createDataFrame(rows, KIND), "day").collect())
    assert got == [(T0, 1.0, "", 0), (T0 + dt.timedelta(1), 2.0, "filled", 0), (T0 + dt.timedelta(2), 3.0, "filled", 0), (T0 + dt.timedelta(3), 4.0, "", 2)]


def test_series_is_summed_and_dealt_once(spark):
    df = repaired(spark.createDataFrame(_rows(), KIND), "hour", 5, 3, 10, 7)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # By (meter, step) and by (meter, range), each once; the summaries by meter and back.
    assert plan.count(" Exchange ") <= 4 and "ReusedExchange" in plan, plan


def test_volumes_beyond_longs_and_below_zero(spark):
    huge = [("m", T0, 4e13), ("m", T0 + dt.timedelta(hours=40), 8e13), ("n", T0, -0.0001), ("n", T0 + dt.timedelta(hours=2), 0.0)]
    got = {(r.meter_id, int((r.step_ts - T0).total_seconds() // 3600)): r.consumption_kl for r in repaired(spark.createDataFrame(huge, KIND), max_gap=50).collect()}
    assert len(got) == 44 and all(got["m", i] == 4e13 + 1e12 * i for i in range(41))
    assert got["n", 1] == -0.0001
