"""Skew demonstration: one (channel, cell) holding a third of the users.

    BENCH_SF_DIR=/root/testdata/sf0.1 python tools/skew_demo.py

Derives a skewed variant of the fixture (every third user's events moved to
one spot and their subscriptions to one channel), runs the grid pair join
plain and salted, checks both give the same rows, and reads task run times
from Spark's event log (written to a fresh scratch folder): with salting the
hot group's work is spread over many tasks instead of one.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cityweave.operators import social  # noqa: E402
from cityweave.plans.catalog import _inputs  # noqa: E402


def skewed_events(events):
    hot = (F.col("message_from") % 3 == 0) | (F.col("usr").try_cast("bigint") % 3 == 0) | (
        F.col("reaction_from").try_cast("bigint") % 3 == 0
    )
    spot_lat = F.lit(-33.865) + (F.col("event_id") % 7) * F.lit(0.00001)
    spot_lon = F.lit(151.2094) + (F.col("event_id") % 5) * F.lit(0.00001)
    return events.select(
        *[c for c in events.columns if c not in ("lat", "lon", "subscription_channel")],
        F.when(hot & F.col("lat").isNotNull(), spot_lat).otherwise(F.col("lat")).alias("lat"),
        F.when(hot & F.col("lon").isNotNull(), spot_lon).otherwise(F.col("lon")).alias("lon"),
        F.when(hot & (F.col("event_type") == "subscription"), F.lit(0).cast("bigint"))
        .otherwise(F.col("subscription_channel"))
        .alias("subscription_channel"),
    )


def _event_lines(log_dir: str):
    """Lines of every event-log file under ``log_dir`` (plain or zstd)."""
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True)):
        if path.endswith(".zstd"):
            import zstandard

            with open(path, "rb") as raw:
                text = zstandard.ZstdDecompressor().stream_reader(raw).read().decode()
        else:
            with open(path) as fh:
                text = fh.read()
        yield from text.splitlines()


def task_times(log_dir: str, job_group: str) -> list[float]:
    """Executor run time (s) of every task of the jobs in ``job_group``."""
    times = []
    stages = set()
    for line in _event_lines(log_dir):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            if ev.get("Properties", {}).get("spark.jobGroup.id") == job_group:
                stages.update(ev.get("Stage IDs", []))
        elif kind == "SparkListenerTaskEnd" and ev.get("Stage ID") in stages:
            metrics = ev.get("Task Metrics") or {}
            times.append(metrics.get("Executor Run Time", 0) / 1000.0)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    log_dir = tempfile.mkdtemp(prefix="cityweave-skew-log-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    events, _ = _inputs(spark, sf_dir)
    events = skewed_events(events)
    channels = social.user_channels(events)
    positions = social.latest_action(events)
    contacts = social.contact_pairs(events)
    out = {}
    rows = {}
    for label, hot_rows in (("plain", 10**9), ("salted", 50)):
        group = f"skew-{label}"
        spark.sparkContext.setJobGroup(group, group)
        df = social.nearby_pairs(channels, positions, contacts, hot_rows=hot_rows)
        t0 = time.perf_counter()
        rows[label] = df.groupBy().count().first()[0]
        wall = time.perf_counter() - t0
        out[label] = {"wall_sec": round(wall, 2)}
    spark.stop()
    for label in out:
        times = sorted(task_times(log_dir, f"skew-{label}"), reverse=True)
        out[label].update(
            {"tasks": len(times), "max_task_sec": round(times[0], 2) if times else None,
             "top3_task_sec": [round(t, 2) for t in times[:3]]}
        )
    print(json.dumps({"sf_dir": sf_dir, "rows": rows, "runs": out}))


if __name__ == "__main__":
    main()
