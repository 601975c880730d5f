import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meterflow.operators import lineage
from meterflow.sources import tables


def test_checked_overwrite(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    tables.write_table(df, p)
    tables.write_table(tables.read_table(spark, p).withColumn("v", F.col("v") + 1), p)  # reads its own target
    assert sorted(r.v for r in tables.read_table(spark, p).collect()) == [1, 3, 5, 7, 9]
    with pytest.raises(tables.SchemaMismatchError):
        tables.write_table(spark.range(3), p)
    tables.write_table(spark.range(3), p, overwrite_schema=True)
    assert tables.read_table(spark, p).columns == ["id"]


def test_refresh_replaces_only_touched_partitions(spark, tmp_dir):
    p = os.path.join(tmp_dir, "part")
    a = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "report_date string, v int").withColumn("report_date", F.to_date("report_date"))
    tables.refresh_partitions(a, p, "report_date")
    b = spark.createDataFrame([("2024-01-02", 20), ("2024-01-03", 30)], "report_date string, v int").withColumn("report_date", F.to_date("report_date"))
    tables.refresh_partitions(b, p, "report_date")
    got = sorted((str(r.report_date), r.v) for r in tables.read_table(spark, p, schema=a.schema).collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 20), ("2024-01-03", 30)]


def test_csv_export_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1.5, None)], "k string, x double, n int")
    p = tables.export_csv(df, os.path.join(tmp_dir, "csv"))
    assert tables.read_csv_export(spark, p, df.schema).collect() == df.collect()


def test_lineage_failure_is_only_a_warning(spark, tmp_dir):
    e = lineage.lineage_edges(spark, lineage.BRONZE_TO_SILVER)
    bad_path = os.path.join(tmp_dir, "file")
    open(bad_path, "w").write("not a directory")
    assert lineage.record_lineage(e, bad_path + "/x") is False
    assert lineage.record_lineage(e, os.path.join(tmp_dir, "lineage")) is True


def test_reads_change_nothing_and_repair_is_explicit(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    tables.write_table(spark.range(3), p)
    # The writer died after the target was moved aside; an old staging copy may still be written.
    os.rename(p, p + ".__old-abc")
    live = p + ".__staging-live"
    os.makedirs(live)
    os.utime(live, (0, 0))
    with pytest.raises(AnalysisException):
        tables.read_table(spark, p)
    assert os.path.exists(p + ".__old-abc") and os.path.exists(live)
    assert tables.repair(spark, p) and not tables.repair(spark, p)
    assert tables.read_table(spark, p).count() == 3 and os.path.exists(live)


def test_publish_lands_or_raises(spark, tmp_dir, monkeypatch):
    """Somebody puts a table at the target between the two renames."""
    p = os.path.join(tmp_dir, "t")
    tables.write_table(spark.range(3), p)
    stage = tables.stage_table(spark.range(5), p)
    real = tables._fs

    class Meddled:
        def __init__(self, fs):
            self.fs, self.done = fs, False

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            ok = self.fs.rename(a, b)
            if not self.done:
                self.done = True
                spark.range(1).write.parquet(p)
            return ok

    monkeypatch.setattr(tables, "_fs", lambda s, path: (Meddled(real(s, path)[0]), *real(s, path)[1:]))
    with pytest.raises(tables.PublishError, match="changed by somebody else"):
        tables.publish(spark, stage, p)
    monkeypatch.undo()
    # Neither the other's table nor the new or the old data is lost.
    assert tables.read_table(spark, p).count() == 1 and spark.read.parquet(stage).count() == 5
    old = [x for x in os.listdir(tmp_dir) if ".__old-" in x]
    assert spark.read.parquet(os.path.join(tmp_dir, old[0])).count() == 3


def test_every_write_checks_the_schema(spark, tmp_dir):
    p = os.path.join(tmp_dir, "part")
    a = spark.sql("SELECT DATE'2024-01-01' AS report_date, 1 AS v")
    tables.refresh_partitions(a, p, "report_date")
    tables.write_table(a, p, partition_by=["report_date"])
    with pytest.raises(tables.SchemaMismatchError):
        tables.refresh_partitions(a.withColumnRenamed("v", "w"), p, "report_date")
    assert tables.read_table(spark, p).collect() == a.select("v", "report_date").collect()
