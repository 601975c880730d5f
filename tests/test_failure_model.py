"""The stored failure model learns from the past only and orders a later snapshot."""

import datetime as dt
import random

import pytest

from meterflow.operators.failure_model import fit_failure_model, scored
from meterflow.operators.ranking import auc

KIND = ("asset_id string, snapshot_date date, asset_type string, asset_age_days int, days_since_last_maintenance int, "
        "days_since_last_failure int, maintenance_events long, failures_to_date long, failure_within_horizon int")
OLD, LATE = dt.date(2023, 1, 1), dt.date(2023, 9, 1)


def _history(flip_late=False):
    rng, rows = random.Random(6), []
    for day in (OLD, LATE):
        for i in range(300):
            gap = rng.randrange(1000)
            fails = int(rng.random() < gap / 1000)
            if flip_late and day == LATE:
                fails = 1 - fails
            rows.append((f"A{i}", day, rng.choice(["pump", "valve"]), gap + 50, gap, None, 1, 0, fails))
    return rows + [("new", LATE, "type never seen", None, None, None, 0, 0, None), ("untyped", LATE, None, 10, None, None, 0, 0, 0)]


def test_learns_from_the_past_scores_every_later_row(spark, tmp_dir):
    late = spark.createDataFrame(_history(), KIND).where(f"snapshot_date = '{LATE}'")
    fit_failure_model(spark.createDataFrame(_history(), KIND), "2023-06-01", tmp_dir + "/a")
    got = {r.asset_id: r for r in scored(late, tmp_dir + "/a").collect()}
    assert len(got) == 302 and all(0 < r.failure_probability < 1 for r in got.values()) and got["new"].failure_within_horizon is None
    assert auc(scored(late, tmp_dir + "/a"), "failure_probability", "failure_within_horizon").first().auc > 0.7
    # What came after the split changes nothing.
    fit_failure_model(spark.createDataFrame(_history(flip_late=True), KIND), "2023-06-01", tmp_dir + "/b")
    again = {r.asset_id: r.failure_probability for r in scored(late, tmp_dir + "/b").collect()}
    assert all(again[a] == pytest.approx(r.failure_probability, abs=1e-9) for a, r in got.items())


def test_needs_both_labels(spark, tmp_dir):
    with pytest.raises(ValueError):
        fit_failure_model(spark.createDataFrame(_history(), KIND), "2023-02-01", tmp_dir + "/c")


def test_backtest_computes_its_history_once(spark, monkeypatch):
    from meterflow.plans import registry
    from tests.conftest import SF_SMALL

    class Seen(Exception):
        pass

    def fit(history, *_):
        raise Seen(history._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(registry.FM, "fit_failure_model", fit)
    with pytest.raises(Seen) as found:
        registry.QUERIES["failure_model_backtest"](spark, SF_SMALL)
    assert "Exchange" not in str(found.value) and "Scan parquet" in str(found.value)
