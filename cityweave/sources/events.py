"""Date-partitioned event log (``<root>/date=YYYY-MM-DD/*.parquet``)."""

from __future__ import annotations

import datetime as _dt
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cityweave.sources.contract import reconciled

# Fields of the nested ``event`` struct the marts read, with the flat name
# each one gets.  ``event.user`` becomes ``usr`` (``user`` is an SQL keyword).
EVENT_FIELDS = (
    ("message_id", "message_id"),
    ("message_from", "message_from"),
    ("message_to", "message_to"),
    ("message_ts", "message_ts"),
    ("datetime", "datetime"),
    ("user", "usr"),
    ("subscription_channel", "subscription_channel"),
    ("reaction_from", "reaction_from"),
)

TOP_LEVEL_FIELDS = ("event_type", "lat", "lon")


def _parse_day(process_date: str | _dt.date) -> _dt.date:
    if isinstance(process_date, _dt.date):
        return process_date
    return _dt.datetime.strptime(process_date, "%Y-%m-%d").date()


def window_bounds(process_date: str | _dt.date, depth: int) -> tuple[_dt.date, _dt.date]:
    """``[process_date - (depth-1), process_date]``, process date inclusive."""
    if int(depth) < 1:
        raise ValueError(f"depth must be >= 1 day, got {depth}")
    end = _parse_day(process_date)
    return end - _dt.timedelta(days=int(depth) - 1), end


def day_paths(process_date: str | _dt.date, depth: int, base_path: str) -> list[str]:
    """Leaf folders of the window, newest first.

    ``base_path`` ends in the partition name (``.../events/date``); a trailing
    ``/`` is ignored.
    """
    start, end = window_bounds(process_date, depth)
    base = base_path.rstrip("/")
    days = (end - _dt.timedelta(days=i) for i in range((end - start).days + 1))
    return [f"{base}={d.isoformat()}" for d in days]


def date_window(df: DataFrame, process_date, depth: int, date_col: str = "date") -> DataFrame:
    """Keep rows whose day lies in the look-back window.

    On a partition column this becomes a ``PartitionFilters`` entry, so only
    the folders of the window are listed and read.
    """
    start, end = window_bounds(process_date, depth)
    day: Column = F.col(date_col).cast("date")
    return df.where(day.between(F.lit(start), F.lit(end)))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def absent_days(spark: SparkSession, base_path: str, process_date, depth: int) -> list[str]:
    """Day folders of the window that do not exist (one look-up a day)."""
    return [p for p in day_paths(process_date, depth, base_path) if not _exists(spark, p)]


def read_events(
    spark: SparkSession,
    base_path: str,
    process_date,
    depth: int,
    missing: str = "error",
    schema: StructType | str | None = None,
    contract: StructType | str | None = None,
) -> DataFrame:
    """Events of the ``depth`` days ending at ``process_date``.

    Only the window's day folders are listed, never the whole log; ``basePath``
    keeps the ``date`` column.  A missing day is an error; ``missing="skip"``
    warns and reads the others, but a window without any day is an error
    either way.  With ``schema`` no file is opened to infer one.  With
    ``contract`` the footers of every day are reconciled with it first
    (``sources.contract``), and the window is read by it in one scan.
    """
    if missing not in ("skip", "error"):
        raise ValueError(f"missing must be 'skip' or 'error', got {missing!r}")
    paths = day_paths(process_date, depth, base_path)
    absent = absent_days(spark, base_path, process_date, depth)
    if absent and (missing == "error" or len(absent) == len(paths)):
        raise FileNotFoundError(f"no events for {len(absent)} of {len(paths)} days: {', '.join(absent)}")
    if absent:
        warnings.warn(f"events of {len(absent)} days are missing: {', '.join(absent)}", stacklevel=2)
    present = [p for p in paths if p not in absent]
    if contract is not None:
        schema = reconciled(spark, present, contract)
    root = base_path.rstrip("/").rsplit("/", 1)[0]
    reader = spark.read.option("basePath", root)
    reader = reader.schema(schema) if schema is not None else reader
    return reader.parquet(*present)


def flatten_events(events: DataFrame) -> DataFrame:
    """Nested ``event.*`` log -> flat columns used by every operator.

    Selecting struct fields lets Spark prune the parquet read to just the
    nested fields used downstream.
    """
    extra = [c for c in ("event_id", "date") if c in events.columns]
    return events.select(
        *extra,
        *[F.col(f"event.{src}").alias(dst) for src, dst in EVENT_FIELDS],
        *TOP_LEVEL_FIELDS,
    )
