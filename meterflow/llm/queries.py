"""One query per training-data operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from meterflow.llm.centroids import oracle as centroids_sql
from meterflow.llm.common import find_package, table
from meterflow.llm.mixing import oracle as mixing_sql
from meterflow.llm.quality_rules import oracle as quality_sql
from meterflow.llm.url_rules import oracle as url_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(fn: Query) -> Query:
    @wraps(fn)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        find_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = query
    return query


@register
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.mixing import placed

    return placed(table(spark, sf_dir, "documents"), ["doc_id"])


ORACLES["op1_mixing"] = mixing_sql()


@register
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.fingerprints import compared

    return compared(table(spark, sf_dir, "documents"))


@register
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.pii import report

    return report(table(spark, sf_dir, "documents"))


@register
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@register
def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.url_rules import judged

    return judged(table(spark, sf_dir, "pages"))


ORACLES["op5_url_rules"] = url_sql()


@register
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.secret_scan import report

    return report(table(spark, sf_dir, "documents"))


@register
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.packing import packed

    return packed(table(spark, sf_dir, "documents"))


@register
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.quality_rules import judged

    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op8_quality_rules"] = quality_sql()


@register
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.html_text import extracted

    return extracted(table(spark, sf_dir, "pages"))


@register
def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.langid import identified

    return identified(table(spark, sf_dir, "documents"))


@register
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.centroids import clustered

    return clustered(table(spark, sf_dir, "embeddings"))


ORACLES["op11_centroids"] = centroids_sql()


@register
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.whitening import whitened

    return whitened(table(spark, sf_dir, "embeddings"))


@register
def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.jaccard_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))
