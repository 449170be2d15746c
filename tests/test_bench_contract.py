"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_REPEATS="1",
               BENCH_CPUS="4", BENCH_QUERIES="core")
    res = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=900, cwd=ROOT)
    lines = [ln for ln in res.stdout.splitlines() if ln.strip()]
    assert res.returncode == 0, res.stderr[-2000:]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and out["sf"] == 0.001 and out["value"] > 0
    assert any(k.startswith("q_") for k in out["queries"])
