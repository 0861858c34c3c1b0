import json
import os
import subprocess
import sys

from conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "rate_by_attribute"],
                         capture_output=True, text=True, env=env, timeout=600, cwd=ROOT)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec)
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"rate_by_attribute"} and rec["value"] > 0
