"""bench.py prints one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_json_contract():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="4")
    proc = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "nest_orders", "two_source_merge"],
                          capture_output=True, text=True, env=env, timeout=900)
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [ln for ln in proc.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"shared_step_tables", "nest_orders", "two_source_merge"}
    assert out["value"] > 0 and all(v >= 0 for v in out["queries"].values())
