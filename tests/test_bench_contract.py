"""bench.py prints exactly one JSON line with the agreed fields."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env,
        capture_output=True,
        text=True,
        timeout=900,
        check=True,
    )
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] == "case_study_total" and d["unit"] == "sec" and d["sf"] == 0.001
    assert d["value"] > 0 and "build_tables" in d["queries"] and "shared.build_cubes" in d["queries"]
    assert len([k for k in d["queries"] if not k.startswith("shared.")]) >= 30
