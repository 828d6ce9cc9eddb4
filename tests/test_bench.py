"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_contract(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_QUERIES="total_events,top_items", BENCH_REFERENCE_COPIES="0")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=str(tmp_path),
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["metric"] and set(d["queries"]) == {"total_events", "top_items"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-6 and d["sf"] == 0.001
