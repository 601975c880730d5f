"""The command-line jobs, run as a user would (separate process)."""

import json
import os
import subprocess
import sys

from meterflow.sources import fixtures as fx
from tests.conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    out = subprocess.run([sys.executable, "-m", "meterflow", *args], cwd=REPO, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_cli_silver_gold_reports(spark, tmp_dir):
    ev = fx.table(spark, SF_SMALL, "events")
    o, li = fx.table(spark, SF_SMALL, "orders"), fx.table(spark, SF_SMALL, "lineitem")
    b = os.path.join(tmp_dir, "bronze")
    fx.land_json(fx.sensus_from_events(ev), b + "/sensus")
    fx.land_json(fx.itron_from_events(ev), b + "/itron")
    fx.land_json(fx.asset_master_from_orders(o, li), b + "/asset")
    fx.land_csv(fx.maintenance_log_from_lineitem(li, o), b + "/log")
    silver, gold, charts = (os.path.join(tmp_dir, x) for x in ("silver", "gold", "charts"))
    report = _run("silver", "--sensus", b + "/sensus", "--itron", b + "/itron", "--asset-master", b + "/asset",
                  "--silver-dir", silver)
    assert all(r["success"] for r in report)
    paths = _run("gold", "--silver-dir", silver, "--gold-dir", gold, "--maintenance-log", b + "/log",
                 "--as-of", "2001-12-31")
    assert set(paths) == {"nrw_daily_summary", "asset_failure_features"}
    out = _run("reports", "--silver-dir", silver, "--gold-dir", gold, "--out-dir", charts)
    assert len(out) == 8
    heat = spark.read.parquet(out["hourly_consumption_heatmap"])
    assert heat.count() == 7 and len(heat.columns) == 25
