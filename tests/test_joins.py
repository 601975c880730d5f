from meterflow.operators.joins import broadcast_if_small, measured_size


def test_measured_size_counts_rows_and_string_bytes(spark):
    df = spark.createDataFrame([("abc", 1), ("de", 2)], "s string, i int")
    n, b = measured_size(df)
    assert n == 2 and b == 2 * (8 + 4) + 5


def test_broadcast_only_within_bounds(spark):
    small = spark.range(10)
    big = spark.range(1000)
    j1 = spark.range(100).join(broadcast_if_small(small, 100), "id")
    j2 = spark.range(100).join(broadcast_if_small(big, 100), "id")
    p1 = j1._jdf.queryExecution().optimizedPlan().toString()
    p2 = j2._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in p1.lower() and "broadcast" not in p2.lower()
