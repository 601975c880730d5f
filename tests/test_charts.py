from pyspark.sql import functions as F

from meterflow.operators import charts as C
from meterflow.plans import inputs as I
from meterflow.params import AgeBins
from tests.conftest import SF_SMALL


def _features(spark, ages):
    return spark.createDataFrame([(f"A{i}", "Pipe", a, f) for i, (a, f) in enumerate(ages)],
                                 "asset_id string, asset_type string, asset_age_days int, failure_event int")


def test_failure_rate_bins_half_open_and_empty_kept(spark):
    # [lo, hi); out-of-range dropped; empty bins kept with NULL rate.
    f = _features(spark, [(0, 1), (99, 0), (100, 1), (999, 0), (1000, 1), (-1, 1), (None, 1)])
    rows = {r["age_group"]: r for r in C.failure_rate_by_age(f).collect()}
    assert len(rows) == 10
    assert (rows["0-100"]["total_assets"], rows["0-100"]["failures"]) == (2, 1)
    assert rows["0-100"]["failure_rate"] == 0.5
    assert rows["100-200"]["total_assets"] == 1 and rows["900-1000"]["total_assets"] == 1
    assert rows["500-600"]["total_assets"] == 0 and rows["500-600"]["failure_rate"] is None


def test_custom_bins(spark):
    f = _features(spark, [(5, 1), (15, 0)])
    out = C.failure_rate_by_age(f, AgeBins([0, 10, 20], ["young", "old"])).collect()
    assert [(r.age_group, r.total_assets) for r in out] == [("young", 1), ("old", 1)]


def test_histogram_counts_sum_to_valid_rows(spark):
    r = I.event_readings(spark, SF_SMALL)
    h = C.consumption_histogram(r, 10.0)
    valid = r.where(F.col("consumption_kl").isNotNull() & ~F.isnan("consumption_kl")).count()
    assert h.agg(F.sum("count")).first()[0] == valid
    assert all(row.bin_end - row.bin_start == 10.0 for row in h.collect())


def test_heatmap_has_24_hour_columns_and_null_for_missing_cells(spark):
    import datetime as dt
    r = spark.createDataFrame([("SEN-1", dt.datetime(2024, 1, 1, 5), 2.0), ("SEN-1", dt.datetime(2024, 1, 1, 5), 4.0)],
                              "meter_id string, reading_ts timestamp_ntz, consumption_kl double")
    out = C.hourly_heatmap(r).collect()
    assert len(out) == 1 and out[0]["day_of_week"] == "Monday"
    assert out[0]["h05"] == 3.0 and out[0]["h06"] is None
    assert len(out[0]) == 25


def test_chart_plans_have_no_python_nodes(spark):
    from meterflow.plans.reports import chart_datasets
    ds = chart_datasets(I.event_summary(spark, SF_SMALL), I.features(spark, SF_SMALL),
                        I.event_readings(spark, SF_SMALL))
    for name, df in ds.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan, name
