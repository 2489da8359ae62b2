"""bench.py prints one JSON line with the agreed keys (run as its own process: it stops its session)."""

import json
import os
import subprocess
import sys

from .conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2", BENCH_RUNS="1", BENCH_LANDED="0",
               BENCH_QUERIES="top_deals,renewal_scorecard")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, cwd=ROOT)
    lines = [x for x in out.stdout.splitlines() if x.startswith("{")]
    assert len(lines) == 1, out.stdout + out.stderr
    r = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(r)
    assert r["unit"] == "sec" and r["sf"] == "0.001"
    assert set(r["queries"]) == {"top_deals", "renewal_scorecard"}
