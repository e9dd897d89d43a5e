"""Activity per city by month and ISO week (the zone mart)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityweave.functions.calendar import iso_week_of, month_of
from cityweave.functions.parsing import event_time
from cityweave.operators.nearest import nearest_city

# Event types counted by the zone mart and the suffix each
# count carries (registrations are reported as new users).
ZONE_COUNTS = (
    ("message", "message"),
    ("reaction", "reaction"),
    ("subscription", "subscription"),
    ("registration", "user"),
)

# The reference ranks cities per (message_id, event_type).
KEYED = ("message_id", "event_type")


def located_events(events: DataFrame) -> DataFrame:
    """Events with coordinates and the columns the zone mart reads."""
    return events.select(
        "message_id", "message_from", "message_ts", "datetime", "usr", "event_type", "lat", "lon",
        *[c for c in ("event_id",) if c in events.columns],
    ).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def closest_event_cities(
    events: DataFrame, cities: DataFrame, key: Sequence[str] | None = KEYED
) -> DataFrame:
    """Nearest city per event.

    ``key=("message_id", "event_type")`` reproduces the reference: events that
    share a key (including every NULL ``message_id`` of a type) compete and
    only the globally closest survive.  ``key=None`` keeps every event.
    """
    return nearest_city(located_events(events), cities, key=key)


def _counts(prefix: str):
    return [
        F.count_if(F.col("event_type") == F.lit(kind)).alias(f"{prefix}_{suffix}")
        for kind, suffix in ZONE_COUNTS
    ]


# ``calendar="month"`` is the reference's key (no year: the same month of two
# years merges); ``"year_month"`` adds the calendar year of the event.
CALENDARS = {"month": (), "year_month": ("year",)}


def _with_calendar(closest: DataFrame, calendar: str = "month") -> DataFrame:
    if calendar not in CALENDARS:
        raise ValueError(f"calendar must be one of {sorted(CALENDARS)}, got {calendar!r}")
    ts = event_time("message_ts", "datetime")
    year = [F.year(ts).alias("year")] if CALENDARS[calendar] else []
    return closest.select(
        *year,
        month_of(ts).alias("month"),
        iso_week_of(ts).alias("week"),
        F.col("city_id").alias("zone_id"),
        "event_type",
    )


def zone_month_metrics(closest: DataFrame, calendar: str = "month") -> DataFrame:
    """``month, zone_id, month_message, month_reaction, month_subscription, month_user``."""
    keys = [*CALENDARS.get(calendar, ()), "month", "zone_id"]
    return _with_calendar(closest, calendar).groupBy(*keys).agg(*_counts("month"))


def zone_week_metrics(closest: DataFrame, calendar: str = "month") -> DataFrame:
    """Counts per ``(month, week, zone_id)``; a week spanning two months appears twice."""
    keys = [*CALENDARS.get(calendar, ()), "month", "week", "zone_id"]
    return _with_calendar(closest, calendar).groupBy(*keys).agg(*_counts("week"))


def zone_metrics(closest: DataFrame, calendar: str = "month") -> DataFrame:
    """Week rows with their month totals repeated (the zone mart).

    One aggregation at the finest grain, then month totals as a window sum
    over the already tiny result -- the facts are scanned and shuffled once
    (partial aggregation map-side), instead of twice plus a join.  Equal to
    ``month LEFT JOIN week ON (month, zone_id)``: every month group has at
    least one week group, and a NULL month (no usable time) matches no week,
    so its week columns are NULL.
    """
    return with_months(zone_week_metrics(closest, calendar), calendar)


def with_months(weeks: DataFrame, calendar: str = "month") -> DataFrame:
    """Week rows with their month totals: the mart from ``zone_week_metrics``."""
    years = list(CALENDARS[calendar])
    per_month = Window.partitionBy(*years, "month", "zone_id")
    no_month = F.col("month").isNull()
    week_cols = [
        F.when(~no_month, F.col(f"week_{s}")).alias(f"week_{s}") for _, s in ZONE_COUNTS
    ]
    month_cols = [
        F.sum(F.col(f"week_{s}")).over(per_month).cast("bigint").alias(f"month_{s}")
        for _, s in ZONE_COUNTS
    ]
    return weeks.select(
        *years,
        "month",
        F.when(~no_month, F.col("week")).alias("week"),
        "zone_id",
        *week_cols,
        *month_cols,
    )


# --- the mart from day partials ---------------------------------------------------

KEY = ("message_id", "event_type")


def day_partials(located: DataFrame, cities, day: str = "date", keyed: bool = True) -> DataFrame:
    """What a day adds to any window: ``day, year, month, week, zone_id, event_type, n``, with ``keyed`` also ``message_id, least``.

    A key competes within the whole window, so its state is mergeable: the
    least distance of the day with the counts of the rows that tie there.  Rows
    farther away in the same day can't be nearest in any window with that day.
    """
    scored = nearest_city(located, cities)
    ts = event_time("message_ts", "datetime")
    when = (F.year(ts).alias("year"), month_of(ts).alias("month"), iso_week_of(ts).alias("week"))
    rows = scored.select(F.col(day).cast("date").alias("day"), *when, F.col("city_id").alias("zone_id"), *KEY, F.col("distance_km").alias("least"))
    place = ("year", "month", "week", "zone_id")
    if not keyed:
        return rows.groupBy("day", *place, "event_type").agg(F.count(F.lit(1)).alias("n"))
    counted = rows.groupBy("day", *KEY, "least", *place).agg(F.count(F.lit(1)).alias("n"))
    nearest = Window.partitionBy("day", *KEY).orderBy("least")
    return counted.withColumn("_rank", F.rank().over(nearest)).where(F.col("_rank") == 1).drop("_rank")


def merged_weeks(partials: DataFrame, calendar: str = "month", keyed: bool = True) -> DataFrame:
    """``zone_week_metrics`` of all days in ``partials``."""
    if keyed:  # a key has a row for each day and place of its ties, however many events it had
        nearest = Window.partitionBy(*KEY).orderBy("least")
        partials = partials.withColumn("_rank", F.rank().over(nearest)).where(F.col("_rank") == 1)
    counts = [
        F.coalesce(F.sum(F.when(F.col("event_type") == F.lit(kind), F.col("n"))), F.lit(0)).alias(f"week_{suffix}") for kind, suffix in ZONE_COUNTS
    ]
    return partials.groupBy(*CALENDARS[calendar], "month", "week", "zone_id").agg(*counts)


def zone_metrics_of_days(partials: DataFrame, calendar: str = "month", keyed: bool = True) -> DataFrame:
    """The zone mart of the days in ``partials``; equal to ``zone_metrics`` over all their events."""
    return with_months(merged_weeks(partials, calendar, keyed), calendar)
