"""Documented analytics on the gold tables.

X8 fits Spark MLlib's logistic regression on the feature table (distributed
iterative optimisation; only model coefficients reach the driver). X9 is a
seasonal-naive demand forecast: the weekday x hour consumption profile
projected onto the hours after the last reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.operators.charts import hourly_cells
from meterflow.session import ensure_checkpoint_dir

FEATURES = ["asset_age_days", "days_since_last_maintenance"]


class NotConverged(RuntimeError):
    """Raised when the fit stopped at its iteration limit."""


def failure_model_scores(features: DataFrame, max_iter: int = 500, reg: float = 0.01, tol: float = 1e-9,
                         max_types: int = 1000) -> DataFrame:
    """Probability of failure per asset from a logistic model.

    Features: asset age, days since maintenance (standardised) and asset
    type (one-hot). Never-maintained assets (NULL days) get the age as their
    gap, i.e. they count as unmaintained since installation. Raises if the fit
    has not converged after ``max_iter`` rounds, or if there are more than
    ``max_types`` asset types to encode (they are kept on the driver).
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    data = features.select(
        "asset_id",
        F.coalesce(F.col("asset_type"), F.lit("unknown")).alias("asset_type"),
        F.col("asset_age_days").cast("double").alias("asset_age_days"),
        F.coalesce(F.col("days_since_last_maintenance"), F.col("asset_age_days"))
        .cast("double").alias("days_since_last_maintenance"),
        F.col("failure_event").cast("double").alias("label"),
    )
    # The fit passes over the data several times: materialise the feature
    # rows once in the shared checkpoint folder (reliable, lineage cut)
    # instead of recomputing the joins behind them on every pass.
    ensure_checkpoint_dir(features.sparkSession)
    everything = data.checkpoint(eager=True)
    # Assets without an age cannot be scored; they stay in the output with a
    # NULL probability instead of being dropped.
    data = everything.where(F.col("asset_age_days").isNotNull())
    unscored = everything.where(F.col("asset_age_days").isNull()).select(
        "asset_id",
        F.lit(None).cast("double").alias("failure_probability"),
        F.lit(None).cast("int").alias("predicted_failure"),
        F.col("label").cast("int").alias("failure_event"),
    )
    if data.select("asset_type").distinct().limit(max_types + 1).count() > max_types:
        raise ValueError(f"more than {max_types} asset types")
    # asset_type enters one-hot encoded (index fitted on the data: one small
    # distinct-count job); the numeric features are standardised.
    indexed = StringIndexer(inputCol="asset_type", outputCol="type_ix", handleInvalid="keep",
                            stringOrderType="alphabetAsc").fit(data).transform(data)
    encoded = OneHotEncoder(inputCols=["type_ix"], outputCols=["type_vec"]).fit(indexed).transform(indexed)
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="raw").transform(encoded)
    scaler = StandardScaler(inputCol="raw", outputCol="num").fit(assembled)
    scaled = VectorAssembler(inputCols=["num", "type_vec"], outputCol="features").transform(
        scaler.transform(assembled))
    lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter, regParam=reg, tol=tol)
    model = lr.fit(scaled)
    if model.summary.totalIterations >= max_iter:
        raise NotConverged(f"no convergence within {max_iter} iterations")
    # The score is a plain expression over the coefficients (as many as there are types, and two).
    weights = F.array(*[F.lit(float(c)) for c in model.coefficients])
    margin = F.aggregate(F.zip_with(vector_to_array("features"), weights, lambda x, c: x * c),
                         F.lit(float(model.intercept)), lambda s, x: s + x)
    scored = scaled.select("asset_id", (1 / (1 + F.exp(-margin))).alias("failure_probability"), "label")
    return scored.select(
        "asset_id",
        "failure_probability",
        (F.col("failure_probability") > 0.5).cast("int").alias("predicted_failure"),
        F.col("label").cast("int").alias("failure_event"),
    ).unionByName(unscored)


def demand_forecast_naive(readings: DataFrame, horizon_hours: int = 168,
                          decimals: int | None = None) -> DataFrame:
    """Forecast per future hour = mean consumption of that weekday-hour.

    The horizon starts at the hour after the latest reading. The profile is
    grouped by (weekday, hour), so it has at most 7 x 24 rows by
    construction and is broadcast on that bound (measuring it would run the
    full aggregation over the readings twice).
    """
    profile = F.broadcast(hourly_cells(readings, decimals).select(
        "day_of_week", "hour", F.col("consumption_kl").alias("forecast_kl")))
    start = readings.agg(F.max("reading_ts").alias("last")).select(
        (F.date_trunc("hour", F.col("last")) + F.expr("INTERVAL 1 HOUR")).alias("start"))
    hours = start.select(F.explode(F.sequence(
        F.col("start"),
        F.col("start") + F.make_dt_interval(F.lit(0), F.lit(horizon_hours - 1)),
        F.expr("INTERVAL 1 HOUR"),
    )).alias("ts"))
    keyed = hours.select("ts", F.date_format("ts", "EEEE").alias("day_of_week"), F.hour("ts").alias("hour"))
    return keyed.join(profile, ["day_of_week", "hour"], "left").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("forecast_ts"), "day_of_week", "hour", "forecast_kl"
    )
