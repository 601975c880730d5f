"""Failure model that is fitted on the past, stored, and scores later snapshots.

It learns from the rows of ``history.feature_history`` whose horizon had ended
by the split date, so neither features nor labels know anything after it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.operators.ml import NotConverged
from meterflow.session import scratch_path

LABEL = "failure_within_horizon"
FEATURES = ["asset_age_days", "days_since_last_maintenance", "days_since_last_failure", "maintenance_events", "failures_to_date",
            "age_unknown", "never_maintained", "never_failed"]


def _prepared(history: DataFrame) -> DataFrame:
    """Every row with all features: unknown days count as the asset's age (or 0) and are marked as unknown."""
    age = F.coalesce(F.col("asset_age_days"), F.lit(0))
    days = ["days_since_last_maintenance", "days_since_last_failure"]
    unknown = {"age_unknown": "asset_age_days", "never_maintained": days[0], "never_failed": days[1]}
    return history.select(
        "asset_id", "snapshot_date", F.coalesce("asset_type", F.lit("unknown")).alias("asset_type"), F.col(LABEL).cast("double").alias(LABEL),
        age.cast("double").alias("asset_age_days"), *[F.coalesce(F.col(d), age).cast("double").alias(d) for d in days],
        F.col("maintenance_events").cast("double").alias("maintenance_events"), F.col("failures_to_date").cast("double").alias("failures_to_date"),
        *[F.col(c).isNull().cast("double").alias(n) for n, c in unknown.items()])


def known_at(split: dt.date | str, horizon_days: int) -> Column:
    """Rows of a history whose horizon had ended by ``split``."""
    return F.date_add("snapshot_date", horizon_days) <= F.to_date(F.lit(str(split)))


def fit_failure_model(history: DataFrame, split: dt.date | str, path: str, horizon_days: int = 90, max_iter: int = 500, reg: float = 0.01,
                      tol: float = 1e-7) -> None:
    """Fit a pipeline (types one-hot, logistic regression on standardised features) on what was known at ``split`` and store it.

    Raises ``ValueError`` unless both labels occur there, and ``NotConverged``
    after ``max_iter`` rounds.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    # Stored once: every round of the fit reads it.
    stored = scratch_path(history.sparkSession, "failure-training")
    _prepared(history.where(F.col(LABEL).isNotNull() & known_at(split, horizon_days))).write.parquet(stored)
    data = history.sparkSession.read.parquet(stored)
    if data.agg(F.count_distinct(LABEL)).first()[0] < 2:
        raise ValueError(f"no failures, or nothing but failures, known at {split}")
    model = Pipeline(stages=[
        StringIndexer(inputCol="asset_type", outputCol="type_ix", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=["type_ix"], outputCols=["type_vec"]),
        VectorAssembler(inputCols=[*FEATURES, "type_vec"], outputCol="features"),
        LogisticRegression(labelCol=LABEL, maxIter=max_iter, regParam=reg, tol=tol)]).fit(data)
    if model.stages[-1].summary.totalIterations >= max_iter:
        raise NotConverged(f"no convergence within {max_iter} iterations")
    model.write().overwrite().save(path)


def scored(history: DataFrame, path: str) -> DataFrame:
    """asset_id, snapshot_date, failure_probability and the label (NULL where it isn't known yet), by the stored model.

    Every row gets a score; an asset type that the model hasn't seen has a place of its own.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    out = PipelineModel.load(path).transform(_prepared(history))
    return out.select("asset_id", "snapshot_date", F.get(vector_to_array("probability"), F.lit(1)).alias("failure_probability"),
                      F.col(LABEL).cast("int").alias(LABEL))
