import datetime as dt

from pyspark.sql import functions as F

from meterflow.functions.measures import exact_mean, pct, to_units, units_to_volume
from meterflow.functions.rules import billed_by_hash, billed_by_suffix, district_of, meter_suffix
from meterflow.functions.time import parse_utc_timestamp, report_date, weekday_name


def _parse(spark, values, tz="UTC"):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        df = spark.createDataFrame([(v,) for v in values], "s string")
        return [r[0] for r in df.select(parse_utc_timestamp("s")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


CASES = [
    ("2024-01-01T23:30:00.123456Z", dt.datetime(2024, 1, 1, 23, 30, 0, 123456)),
    ("2024-01-01T23:30:00", dt.datetime(2024, 1, 1, 23, 30)),
    ("2024-01-02T07:30:00+08:00", dt.datetime(2024, 1, 1, 23, 30)),
    ("2024-01-01T22:00:00.5-0130", dt.datetime(2024, 1, 1, 23, 30, 0, 500000)),
    ("2024-01-01", dt.datetime(2024, 1, 1)),
    ("garbage", None),
    (None, None),
]


def test_parse_mixed_iso_text_as_utc(spark):
    assert _parse(spark, [c[0] for c in CASES]) == [c[1] for c in CASES]


def test_parse_does_not_depend_on_session_zone(spark):
    # The original's report_date moved with the session zone.
    vals = [c[0] for c in CASES]
    assert _parse(spark, vals, "Australia/Perth") == _parse(spark, vals, "UTC")
    assert _parse(spark, vals, "America/Los_Angeles") == _parse(spark, vals, "UTC")


def test_calendar_keys(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 30),)], "ts timestamp_ntz")
    r = df.select(report_date("ts"), weekday_name("ts"), F.hour("ts")).first()
    assert tuple(r) == ("2024-01-01", "Monday", 23)


def test_exact_units_and_ratio(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "x double")
    total = df.agg(units_to_volume(F.sum(to_units("x"))).alias("t")).first()["t"]
    assert total == 0.6  # a double sum gives 0.6000000000000001
    z = spark.createDataFrame([(0.0, 0.0), (1.0, 4.0)], "n double, d double")
    assert [r[0] for r in z.select(pct("n", "d")).collect()] == [None, 25.0]


def test_exact_mean_skips_nan_and_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,)], "x double")
    assert df.agg(exact_mean("x")).first()[0] == 1.5
    assert df.agg(exact_mean("x", 6)).first()[0] == 1.5


def test_rules(spark):
    df = spark.createDataFrame([("SEN-10", dt.datetime(2024, 1, 1)), ("ITR-7", dt.datetime(2024, 1, 1)),
                                ("BAD", dt.datetime(2024, 1, 1))], "meter_id string, reading_ts timestamp_ntz")
    r = df.select(district_of("meter_id"), meter_suffix("meter_id"), billed_by_suffix("meter_id"),
                  billed_by_hash()).collect()
    assert [tuple(x)[:3] for x in r] == [("SEN", 10, False), ("ITR", 7, True), ("BAD", None, False)]
    # Deterministic, unlike rand()
    again = [x[0] for x in df.select(billed_by_hash()).collect()]
    assert again == [x[3] for x in r]


def test_exact_ratio_rounds_true_ties_half_up(spark):
    from meterflow.functions.measures import exact_ratio
    # 65497812500 units of 1e-4 over 100000 = 65.4978125: a true tie at 6
    # decimals. The double nearest to it lies below the tie, so rounding the
    # double would give .497812.
    df = spark.createDataFrame([(65497812500, 100000), (-65497812500, 100000), (1, 3), (2, 3), (5, 0)],
                               "n long, d long")
    got = [r[0] for r in df.select(exact_ratio("n", "d", 6, -4)).collect()]
    assert got == [65.497813, -65.497813, 0.000033, 0.000067, None]
    got2 = [r[0] for r in df.select(exact_ratio("n", "d", 6, 2)).collect()]
    assert got2[2:] == [33.333333, 66.666667, None]
