"""bench.py prints one JSON line with the driver's fields (run in its own process)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_json_contract():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_REPS="1", BENCH_CPUS="2")
    res = subprocess.run([sys.executable, "bench.py", "clean_prices", "daily_series"], cwd=ROOT, env=env,
                         capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    lines = [ln for ln in res.stdout.splitlines() if ln.startswith("{")]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"clean_prices", "daily_series"}
    assert out["value"] > 0


DRIVER_SCRIPT = r"""
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__ as E
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
print("ENTRY_ROWS", E.entry(spark).count())
for name in ("clean_prices", "price_anomalies", "dq_source_freshness", "freshness_anomalies"):
    print("ROWS", name, E.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_driver_style_session_runs_queries(tmp_path):
    """A session built the driver's way (not by stationlens) must run the queries."""
    script = tmp_path / "driver.py"
    script.write_text(DRIVER_SCRIPT)
    res = subprocess.run([sys.executable, str(script), ROOT], capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    assert "ENTRY_ROWS" in res.stdout and res.stdout.count("ROWS ") == 5
