"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full through Spark's ``noop`` sink (no driver
collect). One untimed warm-up run of the flagship query absorbs JVM
start-up and JIT; the reported time per query is the best of
$BENCH_REPEAT runs (default 3).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "nrw_daily_summary",
    "fct_meter_readings",
    "dim_asset",
    "asset_failure_features",
    "chart_nrw_timeseries",
    "chart_failures_by_type",
    "chart_monthly_nrw",
    "chart_hourly_profile",
    "chart_hourly_heatmap",
    "chart_nrw_by_weekday",
    "chart_failure_rate_by_age",
    "chart_asset_age_histogram",
    "chart_consumption_histogram",
    "dq_report",
    "nrw_with_district_name",
    "top_loss_districts",
    "avg_pressure_30d",
    "max_vibration_7d",
    "asset_feature_snapshot",
    "readings_with_asset",
    "maintenance_priority",
    "sql_last_30_days",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from meterflow.session import build_session
    from meterflow.plans.registry import QUERIES

    spark = build_session("meterflow-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": "8g"})

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("nrw_daily_summary")  # warm-up
    times = {}
    for q in HEADLINE:
        times[q] = round(min(run(q) for _ in range(repeat)), 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
