"""Stored tables: read, checked overwrite, staged publish, CSV export and
partition refresh.

Every write checks the stored schema first (``SchemaMismatchError``), whatever
the format. A format with a transaction log (``LOG_FORMATS``) is written
through the format, which keeps its history and is atomic. Plain files have no
log: a full overwrite is written to a staging path next to the target and
swapped in with two renames, so a plan may even read the table it replaces.

Tables have one writer at a time. Reading never changes anything on disk; what
a crashed writer leaves behind is put right only by an explicit ``repair`` of
that writer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


#: Formats that commit through a log of their own.
LOG_FORMATS = {"delta", "iceberg", "hudi"}


class PublishError(OSError):
    """Raised when a staged copy could not be made the table, or it isn't certain."""


class SchemaMismatchError(ValueError):
    """Raised when an overwrite would silently change a stored schema."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def repair(spark: SparkSession, path: str) -> bool:
    """For the table's writer, after a crash between the two renames of ``publish``: put the old copy back.

    Returns whether there was anything to do. Staging copies are left alone.
    """
    fs, target, jvm = _fs(spark, path)
    if fs.exists(target):
        return False
    olds = sorted(fs.globStatus(jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + ".__old-*")) or [],
                  key=lambda st: st.getModificationTime())
    if not olds:
        return False
    if not fs.rename(olds[-1].getPath(), target):
        raise PublishError(f"could not put the old copy back at {path}")
    return True


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """Read a stored table. Give ``schema`` for partitioned tables so the
    partition column keeps its declared type instead of an inferred one."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def _shape(schema: StructType) -> list[tuple[str, str]]:
    """Names and types, whatever the order: partition columns are read back last."""
    return sorted((f.name.lower(), f.dataType.simpleString()) for f in schema.fields)


def check_schema(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Raise unless ``df`` has the stored table's column names and types.

    Partition values that are dates are read back as dates: keep such columns
    DATE in the table.
    """
    if not path_exists(spark, path):
        return
    stored = spark.read.format(fmt).load(path).schema
    if _shape(stored) != _shape(df.schema):
        raise SchemaMismatchError(
            f"schema of new data {_shape(df.schema)} differs from stored {_shape(stored)} at {path}"
        )


def stage_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> str:
    """Write ``df`` to a fresh staging path next to ``path``; return that path.

    Nothing is visible at ``path`` until ``publish`` swaps it in. Reading the
    staged copy back also cuts the lineage of whatever produced ``df``.
    Staged copies of formats with a log are Parquet.
    """
    fmt = "parquet" if fmt in LOG_FORMATS else fmt
    stage = f"{path.rstrip('/')}.__staging-{uuid.uuid4().hex[:12]}"
    w = df.write.format(fmt).mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(stage)
    return stage


def publish(spark: SparkSession, stage: str, path: str, fmt: str = "parquet",
            partition_by: list[str] | None = None) -> str:
    """Make a staged copy the table at ``path``: two renames, then the old copy is removed.

    Either the staged copy is the table afterwards, or this raises: a rename
    that finds something at the target moves the copy *into* it, so that is
    looked for. Readers between the renames find no table, not an old one.
    Formats with a log are written from the copy instead.
    """
    if fmt in LOG_FORMATS:
        write_table(spark.read.parquet(stage), path, fmt, partition_by=partition_by)
        discard(spark, stage)
        return path
    fs, target, jvm = _fs(spark, path)
    staged = jvm.org.apache.hadoop.fs.Path(stage)
    old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.__old-{uuid.uuid4().hex[:12]}")
    had_old = bool(fs.exists(target))
    if had_old and not fs.rename(target, old):
        raise PublishError(f"could not move {path} aside; it is unchanged and the new data is at {stage}")
    swapped = not fs.exists(target) and fs.rename(staged, target)
    inside = jvm.org.apache.hadoop.fs.Path(target, staged.getName())
    if not swapped or fs.exists(inside) or fs.exists(staged):
        if had_old and not fs.exists(target):
            fs.rename(old, target)
        where = inside.toString() if fs.exists(inside) else stage
        raise PublishError(f"{path} was changed by somebody else; the new data is at {where}"
                           + (f", the old at {old.toString()}" if had_old and fs.exists(old) else ""))
    if had_old:
        fs.delete(old, True)
    return path


def discard(spark: SparkSession, stage: str) -> None:
    """Drop a staged copy that must not be published."""
    fs, p, _ = _fs(spark, stage)
    fs.delete(p, True)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    overwrite_schema: bool = False,
    partition_by: list[str] | None = None,
) -> str:
    """Full overwrite: natively by formats with a log, else by swapping a staged copy in.

    With ``overwrite_schema=False`` the stored schema must match first.
    """
    spark = df.sparkSession
    if not overwrite_schema:
        check_schema(spark, df, path, fmt)
    if fmt in LOG_FORMATS:
        w = df.write.format(fmt).mode("overwrite").option("overwriteSchema", str(overwrite_schema).lower())
        (w.partitionBy(*partition_by) if partition_by else w).save(path)
        return path
    return publish(spark, stage_table(df, path, fmt, partition_by), path, fmt)


def export_csv(df: DataFrame, path: str) -> str:
    """Export a data product as header CSV (one folder of part files)."""
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path


def read_csv_export(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)


def refresh_partitions(df: DataFrame, path: str, partition_col: str, fmt: str = "parquet") -> str:
    """Replace only the partitions present in ``df`` (dynamic overwrite).

    Used for the daily refresh of gold products: a day's late readings
    rewrite that day's partition, every other day stays as stored. The schema
    must match the stored one, as for a full overwrite.
    """
    check_schema(df.sparkSession, df, path, fmt)
    (
        df.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .save(path)
    )
    return path
