import pytest
from pyspark.sql import functions as F

from meterflow.operators import quality as Q
from meterflow.plans import inputs as I
from tests.conftest import SF_SMALL


def _df(spark):
    return spark.createDataFrame(
        [("SEN-1", 1.0), (None, 2.0), ("SEN-2", -1.0), ("SEN-2", float("nan")), ("SEN-3", 5000.0)],
        "meter_id string, consumption_kl double")


def test_report_counts(spark):
    rep = {r["rule"]: r for r in Q.evaluate(_df(spark), [
        Q.not_null("meter_id", name="nn"), Q.in_range("consumption_kl", 0, 100, name="rng"),
        Q.unique("meter_id", name="uq"), Q.column_exists("meter_id", name="has"),
        Q.column_exists("reading_value", name="missing")]).collect()}
    assert (rep["nn"]["checked"], rep["nn"]["failed"]) == (5, 1)
    assert rep["rng"]["failed"] == 3  # -1, NaN, 5000
    assert rep["uq"]["failed"] == 2 and rep["uq"]["checked"] == 5
    assert rep["has"]["success"] and not rep["missing"]["success"]


def test_row_rules_use_one_pass(spark):
    rep = Q.evaluate(_df(spark), [Q.not_null("meter_id"), Q.in_range("consumption_kl", 0, 100)])
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1


def test_gate_raises_and_passes(spark):
    bad = Q.evaluate(_df(spark), [Q.not_null("meter_id")])
    with pytest.raises(Q.DataQualityError):
        Q.gate(bad)
    good = Q.evaluate(_df(spark).where(F.col("meter_id").isNotNull()), [Q.not_null("meter_id")])
    assert Q.gate(good).collect() == good.collect()


def test_split_is_a_partition_of_the_input(spark):
    r = I.event_readings(spark, SF_SMALL)
    ok, bad = Q.split_clean(r, Q.reading_rules(0.0, 100.0))
    assert ok.count() + bad.count() == r.count()
    assert bad.where(F.size("failed_rules") == 0).count() == 0


def test_unique_rule_hosts_row_rules_in_one_scan(spark):
    df = _df(spark)
    rep = Q.evaluate(df, [Q.not_null("meter_id", name="nn"), Q.unique("meter_id", name="uq"),
                          Q.column_exists("meter_id", name="has")])
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1
    got = {r.rule: (r.checked, r.failed, r.success) for r in rep.collect()}
    assert got == {"nn": (5, 1, False), "uq": (5, 2, False), "has": (5, 0, True)}


def test_empty_input_reports_zero(spark):
    df = _df(spark).where("false")
    got = {r.rule: (r.checked, r.failed) for r in Q.evaluate(df, [Q.not_null("meter_id", name="nn"),
                                                                   Q.unique("meter_id", name="uq")]).collect()}
    assert got == {"nn": (0, 0), "uq": (0, 0)}


def test_write_split_one_pass(spark, tmp_dir):
    import os
    ok_path, bad_path = Q.write_split(_df(spark), [Q.not_null("meter_id"), Q.in_range("consumption_kl", 0, 100)],
                                      os.path.join(tmp_dir, "split"))
    ok, bad = spark.read.parquet(ok_path), spark.read.parquet(bad_path)
    assert ok.count() == 1 and bad.count() == 4


def test_bounded_collect(spark):
    import pytest as _pt
    from meterflow.plans.reports import ResultTooLarge, to_pandas_bounded
    assert len(to_pandas_bounded(spark.range(10), 10)) == 10
    with _pt.raises(ResultTooLarge):
        to_pandas_bounded(spark.range(11), 10)
