"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(
        os.environ,
        BENCH_SF_DIR="/root/testdata/sf0.001",
        BENCH_CPUS="2",
        BENCH_REPEAT="1",
        BENCH_WARMUP="0",
        BENCH_QUERIES="zone_metrics,nearest_city_events_per_row",
        BENCH_DRIVER_MEMORY="2g",
    )
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env, capture_output=True, text=True, timeout=600, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"zone_metrics", "nearest_city_events_per_row"}
    assert result["value"] > 0
