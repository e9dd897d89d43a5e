"""Reference-shaped baseline: the oracle's brute-force plans timed in DuckDB.

    python tools/baseline.py [sf_dir] [threads]

The oracle SQL is the plain reading of the marts (dictionary cross join +
rank, full channel-pair enumeration, whole-group windows).  Timing it on one
node gives the single-node number the Spark plans are compared with in
README.md.  Prints one JSON line: median of 3 per query, seconds.
"""

from __future__ import annotations

import json
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from cityweave.plans.oracle import ORACLE_SQL  # noqa: E402

HEADLINE = (
    "nearest_city_events_keyed",
    "nearest_city_events_per_row",
    "user_geo_profile",
    "zone_metrics",
    "pair_recommendations",
    "nearby_pairs",
)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    threads = int(argv[2]) if len(argv) > 2 else 8
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in ("nation", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    out, rows = {}, {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            n = con.execute(f"SELECT count(*) FROM ({ORACLE_SQL[name]})").fetchone()[0]
            runs.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(runs), 3)
        rows[name] = n
    print(json.dumps({"engine": f"duckdb {duckdb.__version__}", "threads": threads, "sf_dir": sf_dir,
                      "queries": out, "rows": rows}))


if __name__ == "__main__":
    main(sys.argv)
