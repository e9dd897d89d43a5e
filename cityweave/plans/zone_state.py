"""Zone mart from a state table of day partials: a run reads only days it lacks.

``<state>/day=YYYY-MM-DD/source=<stamp>/`` holds a day's partials.  The stamp
names what they were made from: the day's files (names, sizes, times), the
dictionary and the mode.  A late or replaced day has another stamp and is read
again; a replay of the same day finds its folder.  Days are written to a
staging folder and renamed into place, so a folder is always whole: a run that
is killed leaves days out, and the next one adds them.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityweave.operators import zones
from cityweave.operators.leaves import place_index
from cityweave.session import prepare_session
from cityweave.sources.events import absent_days, day_paths, flatten_events, read_events
from cityweave.sources.sinks import Folders

KEYED = "year int, month int, week int, zone_id string, message_id long, event_type string, least double, n long"
PER_ROW = "year int, month int, week int, zone_id string, event_type string, n long"


def _dictionary_stamp(cities: DataFrame) -> str:
    total, rows = cities.agg(F.sum(F.xxhash64(*sorted(cities.columns)).cast("decimal(38,0)")), F.count(F.lit(1))).first()
    return f"{rows}:{total}"


def day_folders(spark: SparkSession, base_path: str, process_date, depth: int, cities: DataFrame, state: str, keyed: bool, missing: str) -> dict[str, str]:
    """State folder of each day of the window that the log has."""
    absent = absent_days(spark, base_path, process_date, depth)
    paths = [p for p in day_paths(process_date, depth, base_path) if p not in absent]
    if (absent and missing != "skip") or not paths:
        raise FileNotFoundError(f"no events for {len(absent)} days: {', '.join(absent)}")
    log, made_from = Folders(spark, base_path), f"{_dictionary_stamp(cities)}|{keyed}"
    out = {}
    for path in paths:
        stamp = hashlib.sha256(f"{log.stamp(path)}|{made_from}".encode()).hexdigest()[:16]
        out[path.rsplit("=", 1)[1]] = f"{state.rstrip('/')}/day={path.rsplit('=', 1)[1]}/source={stamp}"
    return out


def update(
    spark: SparkSession, base_path: str, process_date, depth: int, cities: DataFrame, state: str, keyed: bool = True, missing: str = "error"
) -> tuple[dict[str, str], list[str]]:
    """Add the window's days that the state lacks; returns all its folders and the days that were read."""
    prepare_session(spark)
    folders = Folders(spark, state)
    wanted = day_folders(spark, base_path, process_date, depth, cities, state, keyed, missing)
    lacking = sorted(day for day, folder in wanted.items() if not folders.exists(folder))
    if not lacking:
        return wanted, []
    schema = read_events(spark, base_path, lacking[-1], 1).schema
    root = base_path.rstrip("/").rsplit("/", 1)[0]
    days = spark.read.option("basePath", root).schema(schema).parquet(*[f"{base_path.rstrip('/')}={day}" for day in lacking])
    flat = flatten_events(days.withColumn("date", F.col("date").cast("string")))
    located = flat.select("date", "message_id", "message_from", "message_ts", "datetime", "usr", "event_type", "lat", "lon").where("lat is not null and lon is not null")
    staged = f"{state.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    try:
        partials = zones.day_partials(located, place_index(cities), keyed=keyed)
        partials.withColumn("day", F.col("day").cast("string")).write.partitionBy("day").parquet(staged)
        for day in lacking:
            made = f"{staged}/day={day}"
            if folders.exists(made):
                folders.move(made, wanted[day])
            else:  # a day without located events
                folders.make(wanted[day])
            for old in folders.names(f"{state.rstrip('/')}/day={day}"):
                if not wanted[day].endswith(old):
                    folders.delete(f"{state.rstrip('/')}/day={day}/{old}")
    finally:
        folders.delete(staged)
    return wanted, lacking


def zone_metrics_of_window(
    spark: SparkSession, base_path: str, process_date, depth: int, cities: DataFrame, state: str,
    keyed: bool = True, missing: str = "error", calendar: str = "month",
) -> DataFrame:
    """The zone mart of the window; events are read only for days that the state lacks."""
    wanted, _ = update(spark, base_path, process_date, depth, cities, state, keyed, missing)
    partials = spark.read.schema(KEYED if keyed else PER_ROW).parquet(*wanted.values())
    return zones.zone_metrics_of_days(partials, calendar, keyed)
