"""bench.py prints exactly one JSON line with the driver's keys."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF, "BENCH_CPUS": "2"}
    proc = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "route_codes", "name_parts"],
                          capture_output=True, text=True, env=env, timeout=600, check=True)
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and set(out["queries"]) == {"route_codes", "name_parts"}
    assert out["value"] == pytest.approx(sum(out["queries"].values()), abs=0.01)
