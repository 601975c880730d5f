"""Every registered query against its DuckDB twin (the driver's gate)."""

import pytest

import __spark_entry__ as E
from meterflow.plans import registry
from tests.conftest import SF_CHECK, SF_SMALL
from tests.oracle_util import assert_same, duck

KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle_small(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    assert_same(df, con, E.oracle_sql()[key])


@pytest.mark.parametrize("key", ["nrw_daily_summary", "asset_failure_features", "chart_hourly_heatmap",
                                 "avg_pressure_30d", "chart_failure_rate_by_age"])
def test_query_matches_oracle_sf001(spark, key):
    df = E.queries()[key](spark, SF_CHECK)
    assert_same(df, duck(SF_CHECK), E.oracle_sql()[key]) > 0


def test_entry_is_the_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["report_date", "district", "total_supplied_kl", "total_billed_kl", "nrw_kl",
                          "nrw_percent"]
    assert df.count() > 0


def test_model_reports_a_fit_that_stops_early(spark):
    from meterflow.operators.ml import NotConverged, failure_model_scores
    from meterflow.plans import inputs
    with pytest.raises(NotConverged):
        failure_model_scores(inputs.features(spark, SF_SMALL), max_iter=1)


def test_model_keeps_assets_without_age(spark):
    from meterflow.operators.ml import failure_model_scores
    rows = [(f"A{i}", "Pipe" if i % 2 else "Pump", i * 10, i * 3, int(i % 5 == 0)) for i in range(1, 60)]
    rows.append(("A-none", "Pipe", None, None, 0))
    f = spark.createDataFrame(rows, "asset_id string, asset_type string, asset_age_days int, "
                                    "days_since_last_maintenance int, failure_event int")
    out = {r.asset_id: r.failure_probability for r in failure_model_scores(f).collect()}
    assert len(out) == 60 and out["A-none"] is None and out["A1"] is not None
