"""Ranks, AUC and bins against brute force, wherever ranges are cut."""

import random

import pytest

from meterflow.operators.ranking import auc, calibration, percent_rank

KIND = "g string, id int, s double, y int"


def _rows(seed=3):
    rng, rows = random.Random(seed), []
    for g, n in (("a", 90), ("b", 40), (None, 25), ("one", 1)):
        for i in range(n):
            # A third of the rows share a score.
            s = 0.5 if rng.random() < 0.33 else round(rng.random(), 1 if g == "b" else 6)
            rows.append((g, i, s, int(rng.random() < 0.2 + 0.6 * s)))
    return rows + [("a", 900, None, 1), ("b", 901, 0.7, None)]


def _groups(rows):
    out = {}
    for g, i, s, y in rows:
        out.setdefault(g, []).append((i, s, y))
    return out


@pytest.mark.parametrize("ranges", [1, 5, 200])
def test_percent_rank(spark, ranges):
    rows = _rows()
    got = {(r.g, r.id): r.percent_rank for r in percent_rank(spark.createDataFrame(rows, KIND), "s", ["g"], ranges=ranges).collect()}
    assert len(got) == len(rows)
    for g, of in _groups(rows).items():
        scores = [s for _, s, _ in of if s is not None]
        for i, s, _ in of:
            want = None if s is None else sum(x < s for x in scores) / (len(scores) - 1) if len(scores) > 1 else 0.0
            assert got[g, i] == (want if want is None else pytest.approx(want, abs=1e-6))


def test_auc_and_bins(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, KIND)
    found = {r.g: r for r in auc(df, "s", "y", ["g"], ranges=7).collect()}
    binned = {(r.g, r.bin): r for r in calibration(df, "s", "y", ["g"], bins=4, ranges=7).collect()}
    for g, of in _groups(rows).items():
        of = [(s, y) for _, s, y in of if s is not None and y is not None]
        good, bad = [s for s, y in of if y], [s for s, y in of if not y]
        wins = sum((p > n) + 0.5 * (p == n) for p in good for n in bad)
        assert (found[g]["rows"], found[g].positives) == (len(of), len(good))
        assert found[g].auc == (pytest.approx(wins / len(good) / len(bad), abs=1e-6) if good and bad else None)
        bins = {}
        for s, y in of:
            bins.setdefault(sum(x < s for x, _ in of) * 4 // len(of), []).append((s, y))
        assert {b for k, b in binned if k == g} == set(bins)
        for b, members in bins.items():
            r = binned[g, b]
            assert (r["rows"], r.positives) == (len(members), sum(y for _, y in members))
            assert r.mean_score == pytest.approx(sum(s for s, _ in members) / len(members), abs=1e-6)
            assert r.positive_rate == pytest.approx(r.positives / r["rows"], abs=1e-6)


def test_without_groups_and_empty(spark):
    rows = [r for r in _rows() if r[0] == "a"]
    got = auc(spark.createDataFrame(rows, KIND), "s", "y").collect()
    assert len(got) == 1 and got[0]["rows"] == 90 and 0.5 < got[0].auc < 1
    empty = spark.createDataFrame([], KIND)
    assert percent_rank(empty, "s").collect() == [] and calibration(empty, "s", "y").collect() == [] and auc(empty, "s", "y", ["g"]).collect() == []


def test_no_window_over_all_rows(spark):
    plan = percent_rank(spark.createDataFrame(_rows(), KIND), "s")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
