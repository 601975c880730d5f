"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.session import ensure_checkpoint_dir, scratch_path

#: The white space that separates words: space and \t to \r.
WORD_BREAK = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: F.Column) -> F.Column:
    """Words of a text (null: none), split at ASCII white space only."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder.

    A reliable ``checkpoint``: executors that are lost afterwards lose
    nothing, and the lineage ends here.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Like ``settled`` but as Parquet, so that later reads prune columns."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:6]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def find_package(spark: SparkSession) -> None:
    """Lets Python workers that share this file system import the package (a cluster ships it with --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that only a few texts are held as Python objects and sent back at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


_held: dict[str, object] = {}


def held(name: str, make: Callable[[], object]) -> object:
    """A look-up table kept between the tasks of a Python worker: one at a time, the last one asked for."""
    if name not in _held:
        release()
        _held[name] = make()
    return _held[name]


def release() -> None:
    """Drops what ``held`` keeps: tasks of another operator need the memory."""
    if _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
