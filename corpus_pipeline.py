"""The corpus pipeline: documents in, packed training sequences out.

Each stage is one operator over all that the stage before it kept. Stages are
written to the shared folder and read again, so a lost executor costs at most
the stage that runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterflow.llm import langid, mixing, packing, secret_scan, simhash
from meterflow.llm.common import find_package
from meterflow.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    return langid.accepted(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.deduplicated(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; all documents stay."""
    return secret_scan.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are put in the order of the mixture; all stay."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are packed into token sequences in the order of the mixture, one row a piece.

    The order of rows doesn't outlive writing and reading, so slots are found again from the documents.
    """
    return packing.mixture_packed(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id), ("simhash_dedup", simhash_dedup), ("secret_scan", secrets), ("mixing", mixture), ("packing", sequences)]

#: Not expressible in SQL: a learned model, hashes and a vocabulary that DuckDB lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    find_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
