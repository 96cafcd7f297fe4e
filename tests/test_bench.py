"""The bench prints one JSON line with the agreed fields."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_line():
    env = {
        **os.environ,
        "BENCH_SF_DIR": "/root/testdata/sf0.001",
        "BENCH_CPUS": "2",
        "BENCH_MEMORY": "2g",
    }
    done = subprocess.run(
        [sys.executable, "bench.py", "minor_victims", "v_minor_priority"],
        cwd=ROOT,
        env=env,
        capture_output=True,
        text=True,
        timeout=300,
    )
    (line,) = done.stdout.strip().splitlines()
    result = json.loads(line)
    assert set(result) == {"metric", "value", "unit", "queries", "sf"}
    assert result["unit"] == "sec" and result["sf"] == "0.001"
    assert set(result["queries"]) == {"minor_victims", "v_minor_priority"}
