"""The pipeline's stages as plain functions over DataFrames.

One call per stage of the original bronze -> silver -> gold -> report flow,
so existing workflows map one to one:

    fact     = conform_meter_data(sensus_df, itron_df)
    result   = validate_readings(fact)            # {"success": ..., "results": [...]}
    dim      = asset_dimension(asset_master_df)
    nrw      = nrw_summary(fact)                  # gold.nrw_daily_summary
    features = asset_features(dim, maintenance_log_df, as_of="2024-01-15")
    charts   = chart_datasets(nrw, features, fact)  # eight small DataFrames

Everything returned is a lazy DataFrame except ``validate_readings``,
which evaluates the rules (one pass) and returns the per-rule result.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame

from meterflow.operators import quality
from meterflow.operators.assets import asset_failure_features
from meterflow.operators.conform import dim_asset, fct_meter_readings
from meterflow.operators.nrw import nrw_daily_summary
from meterflow.plans.reports import chart_datasets  # noqa: F401  (re-exported)


def conform_meter_data(sensus: DataFrame | None, itron: DataFrame | None) -> DataFrame:
    """Silver ``fct_meter_readings`` from the nested and the flat feed."""
    return fct_meter_readings(sensus, itron)


def validate_readings(fact: DataFrame, rules: list[quality.Rule] | None = None) -> dict:
    """Evaluate the quality rules; ``success`` is False if any rule failed."""
    rows = [r.asDict() for r in quality.evaluate(fact, rules or quality.reading_rules()).collect()]
    return {"success": all(r["success"] for r in rows), "results": rows}


def asset_dimension(asset_master: DataFrame) -> DataFrame:
    """Silver ``dim_asset`` from the nested asset master."""
    return dim_asset(asset_master)


def nrw_summary(fact: DataFrame, billing_rule: Column | None = None) -> DataFrame:
    """Gold ``nrw_daily_summary``."""
    return nrw_daily_summary(fact, billing_rule)


def asset_features(dim: DataFrame, maintenance_log: DataFrame | None = None,
                   as_of: dt.date | str | None = None, failure_rule: Column | None = None) -> DataFrame:
    """Gold ``asset_failure_features``: the label comes from the log or from an explicit ``failure_rule``."""
    if maintenance_log is None and failure_rule is None:
        raise ValueError("the failure label needs a maintenance log or an explicit failure_rule")
    return asset_failure_features(dim, maintenance_log, as_of, failure_rule)
