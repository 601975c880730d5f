"""Command line: python -m meterflow {silver,gold,snapshot,reports} ...

Runs the jobs on whatever master spark-submit / the environment provides.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if not __package__:  # run as a script (spark-submit meterflow/__main__.py ...)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterflow.session import build_session  # noqa: E402


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="meterflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("silver", help="bronze -> silver")
    s.add_argument("--sensus"), s.add_argument("--itron"), s.add_argument("--asset-master")
    s.add_argument("--multiline", action="store_true")
    s.add_argument("--feed-format", choices=["json", "csv"], default="json")
    s.add_argument("--cluster-days", action="store_true", help="range-partition by day before writing")
    s.add_argument("--silver-dir", required=True)
    s.add_argument("--lineage"), s.add_argument("--quarantine", help="rows that break a rule go here")
    s.add_argument("--format", default="parquet")
    g = sub.add_parser("gold", help="silver -> gold")
    g.add_argument("--silver-dir", required=True), g.add_argument("--gold-dir", required=True)
    g.add_argument("--maintenance-log"), g.add_argument("--as-of"), g.add_argument("--lineage")
    g.add_argument("--refresh-from"), g.add_argument("--refresh-to")
    g.add_argument("--made-up-labels", action="store_true", help="label by a hash of the asset when there is no log")
    g.add_argument("--format", default="parquet")
    g.add_argument("--districts", help="Parquet district dimension: district_id, district_name, region_name")
    n = sub.add_parser("snapshot", help="weekly asset feature snapshot (kept as history)")
    n.add_argument("--silver-dir", required=True), n.add_argument("--gold-dir", required=True)
    n.add_argument("--maintenance-log", required=True), n.add_argument("--date", required=True)
    n.add_argument("--sensors", required=True, help="Parquet: asset_id, reading_ts, sensor, value")
    r = sub.add_parser("reports", help="gold -> chart datasets")
    r.add_argument("--silver-dir", required=True), r.add_argument("--gold-dir", required=True)
    r.add_argument("--out-dir", required=True)
    a = ap.parse_args(argv)

    spark = build_session("meterflow-" + a.cmd)
    if a.cmd == "silver":
        from meterflow.plans.silver import BronzePaths, run_bronze_to_silver

        rep = run_bronze_to_silver(spark, BronzePaths(a.sensus, a.itron, a.asset_master, a.multiline, a.feed_format),
                                   a.silver_dir, lineage_path=a.lineage, cluster_days=a.cluster_days,
                                   quarantine_path=a.quarantine, fmt=a.format)
        print(json.dumps([r.asDict() for r in rep.collect()]))
    elif a.cmd == "gold":
        from meterflow.plans.gold import failure_rule_by_hash, run_silver_to_gold

        days = (a.refresh_from, a.refresh_to) if a.refresh_from or a.refresh_to else None
        if days and not all(days):
            ap.error("--refresh-from and --refresh-to go together")
        dims = spark.read.parquet(a.districts) if a.districts else None
        print(json.dumps(run_silver_to_gold(spark, a.silver_dir, a.gold_dir, a.maintenance_log, a.as_of,
                                            refresh_days=days, lineage_path=a.lineage, districts=dims, fmt=a.format,
                                            failure_rule=failure_rule_by_hash() if a.made_up_labels else None)))
    elif a.cmd == "snapshot":
        from meterflow.plans.gold import run_feature_snapshot

        print(json.dumps({"asset_feature_snapshots": run_feature_snapshot(
            spark, a.silver_dir, a.gold_dir, a.maintenance_log, spark.read.parquet(a.sensors), a.date)}))
    else:
        from meterflow.plans.reports import chart_datasets, write_chart_datasets
        from meterflow.sources.tables import read_table

        gold, silver = a.gold_dir.rstrip("/"), a.silver_dir.rstrip("/")
        ds = chart_datasets(read_table(spark, f"{gold}/nrw_daily_summary"),
                            read_table(spark, f"{gold}/asset_failure_features"),
                            read_table(spark, f"{silver}/fct_meter_readings"))
        print(json.dumps(write_chart_datasets(ds, a.out_dir)))
    spark.stop()


if __name__ == "__main__":
    main()
