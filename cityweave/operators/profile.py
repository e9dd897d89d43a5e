"""Geographic profile per user: current city, home city, itinerary, local time.

Row order inside a user is ``(message_ts, message_id, city_id)`` ascending
(the reference orders by time only, which leaves ties -- including the two
rows of a message tied between two cities -- undefined).  ``message_ts`` is
compared as a parsed timestamp, not as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityweave.functions.calendar import DEFAULT_TIME_ZONE, local_time
from cityweave.functions.parsing import parse_timestamp
from cityweave.operators.nearest import nearest_city

ORDER = ("message_ts", "message_id", "city_id")


# Where a message's time is read from, first non-NULL wins.  The reference
# reads ``message_ts`` alone and drops messages without it; logs that carry the
# time of some messages only in ``datetime`` can ask for ``COALESCED_TIME_FIELDS``.
MESSAGE_TIME_FIELDS = ("message_ts",)
COALESCED_TIME_FIELDS = ("message_ts", "datetime")


def message_points(events: DataFrame, time_fields=MESSAGE_TIME_FIELDS) -> DataFrame:
    """Complete messages: id, sender, time and coordinates present."""
    raw_time = F.coalesce(*[F.col(c) for c in time_fields]) if len(time_fields) > 1 else F.col(time_fields[0])
    return events.where(
        (F.col("event_type") == F.lit("message"))
        & F.col("message_id").isNotNull()
        & F.col("message_from").isNotNull()
        & raw_time.isNotNull()
        & F.col("lat").isNotNull()
        & F.col("lon").isNotNull()
    ).select(
        "message_id",
        F.col("message_from").alias("user_id"),
        parse_timestamp(raw_time).alias("message_ts"),
        F.col("lat").alias("message_lat"),
        F.col("lon").alias("message_lon"),
        "event_type",
    )


def closest_message_cities(messages: DataFrame, cities: DataFrame, keyed: bool = True) -> DataFrame:
    """Nearest city per message (rank 1 per ``message_id`` when ``keyed``)."""
    located = nearest_city(
        messages.select("message_id", "user_id", "message_ts", "message_lat", "message_lon"),
        cities,
        lat="message_lat",
        lon="message_lon",
        key=["message_id"] if keyed else None,
    )
    return located.select("message_id", "user_id", "message_ts", "distance_km", "city_id", "city_name")


def _place_aggregates() -> list[Column]:
    """Latest row (time DESC with NULL last, message_id DESC, city_id ASC) and the
    city names seen, as buffers that merge over pieces of a user."""
    ts, name = F.col("message_ts"), F.col("city_name")
    latest = F.struct(ts.isNull(), -F.unix_micros(ts), -F.col("message_id"), F.col("city_id"), name.alias("city_name"), ts.alias("message_ts"))
    return [
        F.min(latest).alias("_cur"),
        F.count(name).alias("_named"),
        F.count_if(name.isNull()).alias("_unnamed"),
        F.min(name).alias("_lo"),
        F.max(name).alias("_hi"),
    ]


def _places(tz: str) -> list[Column]:
    """Columns of the mart that follow from ``_place_aggregates``.

    A user has a home city when all names are NULL, or none is NULL and
    min = max (a NULL name counts as a city of its own, as in the reference).
    """
    one_city = (F.col("_named") == 0) | ((F.col("_unnamed") == 0) & (F.col("_lo") == F.col("_hi")))
    return [
        F.col("_cur.city_name").alias("act_city"),
        F.when(one_city, F.col("_hi")).alias("home_city"),
        local_time(F.col("_cur.message_ts"), tz).alias("local_time"),
        one_city.alias("_has_home"),
    ]


def user_places(closest: DataFrame, tz: str = DEFAULT_TIME_ZONE) -> DataFrame:
    """Current city, its local time and the home city, in one aggregation per user.

    Partial aggregation map-side, one shuffle on ``user_id``: a user holding a
    third of all messages is reduced in every task before it moves.
    """
    return closest.groupBy("user_id").agg(*_place_aggregates()).select("user_id", *_places(tz))


def current_city(closest: DataFrame, tz: str = DEFAULT_TIME_ZONE) -> DataFrame:
    """City of each user's latest message and that message's local time."""
    return user_places(closest, tz).select("user_id", "act_city", "local_time")


def per_city_counts(closest: DataFrame) -> DataFrame:
    """Messages per (user, city name)."""
    return closest.groupBy("user_id", "city_name").agg(F.count(F.lit(1)).alias("messages_count"))


def home_city(closest: DataFrame) -> DataFrame:
    """Users seen in exactly one city name, with that name."""
    return user_places(closest).where("_has_home").select("user_id", "home_city")


def _pieces(closest: DataFrame, pieces: int | None) -> DataFrame:
    """``closest`` with ``_piece``: ranges of the order (user, time, message, city).

    The ranges are cut by rank: Spark samples the whole order, so a piece holds
    about as many rows as any other, whatever the users' sizes and however
    their times bunch; a user with a third of all rows spans many pieces.  A
    user's pieces, ordered by number, are in the user's order.
    """
    n = pieces or int(closest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_first() for c in ("user_id", *ORDER)]
    return closest.select("user_id", *ORDER, "city_name").repartitionByRange(n, *order).withColumn("_piece", F.spark_partition_id())


def _stepped(closest: DataFrame, pieces: int | None) -> DataFrame:
    """Pieces with the previous row's city inside the piece (``_prev``) and its first row marked."""
    w = Window.partitionBy("user_id", "_piece").orderBy(*[F.col(c).asc_nulls_first() for c in ORDER])
    rows = _pieces(closest, pieces).withColumn("_prev", F.lag("city_name").over(w))
    return rows.withColumn("_first", F.row_number().over(w) == 1)


def travel_events(closest: DataFrame, pieces: int | None = None) -> DataFrame:
    """Rows where a user's city differs from the previous row's (first row included).

    ``lag`` within each piece of a user; a piece's first row is compared with
    the last city of the user's piece before, from a summary of one row a
    (user, piece).  No task sorts a user's whole history.
    """
    rows = _stepped(closest, pieces)
    last = rows.groupBy("user_id", "_piece").agg(F.max_by("city_name", F.struct(*ORDER)).alias("_last"))
    in_turn = Window.partitionBy("user_id").orderBy("_piece")
    carried = last.select("user_id", "_piece", F.lag("_last").over(in_turn).alias("_carry"))
    prev = F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_prev"))
    return (
        rows.join(carried, ["user_id", "_piece"], "left")
        .where(prev.isNull() | (F.col("city_name") != prev))
        .select("user_id", "message_id", "message_ts", "city_id", "city_name")
    )


def _itineraries(closest: DataFrame, pieces: int | None) -> DataFrame:
    """Per user: the pieces' itineraries in order (``_parts``) and the place buffers."""
    leg = ~F.col("_first") & (F.col("_prev").isNull() | (F.col("city_name") != F.col("_prev")))
    key = F.struct(*ORDER)
    by_piece = _stepped(closest, pieces).groupBy("user_id", "_piece").agg(
        F.min_by("city_name", key).alias("first"),
        F.max_by("city_name", key).alias("last"),
        F.count_if(leg).alias("n"),
        F.array_sort(F.collect_list(F.when(leg, F.struct(*ORDER, "city_name")))).alias("legs"),
        *_place_aggregates(),
    )
    names = F.transform("legs", lambda x: x["city_name"]).alias("names")
    return by_piece.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("_piece", "first", "last", "n", names))).alias("_parts"),
        F.min("_cur").alias("_cur"),
        F.sum("_named").alias("_named"),
        F.sum("_unnamed").alias("_unnamed"),
        F.min("_lo").alias("_lo"),
        F.max("_hi").alias("_hi"),
    )


def _travels() -> list[Column]:
    """``travel_count`` and ``travel_array`` from ``_parts``.

    A piece's first row is a trip when the piece before ended in another or an
    unnamed city (the ``lag`` rule across the border).  Unnamed cities count as
    trips but are left out of the array.
    """

    def opens(x: Column, i: Column) -> Column:
        before = F.get(F.col("_parts"), i - 1)["last"]
        return (i == 0) | before.isNull() | F.coalesce(x["first"] != before, F.lit(False))

    trips = F.transform("_parts", lambda x, i: x["n"] + F.when(opens(x, i), 1).otherwise(0))
    none = F.array().cast("array<string>")
    visited = F.transform("_parts", lambda x, i: F.concat(F.when(opens(x, i), F.array(x["first"])).otherwise(none), x["names"]))
    return [
        F.aggregate(trips, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("travel_count"),
        F.filter(F.flatten(visited), lambda x: x.isNotNull()).alias("travel_array"),
    ]


def travel_stats(closest: DataFrame, pieces: int | None = None) -> DataFrame:
    """``travel_count`` and the ordered itinerary ``travel_array`` per user.

    Inside each piece of a user a window marks the rows whose city differs from
    the row before, and the piece is summarised as (first city, last city,
    inner legs); per user the summaries are stitched in order.
    """
    return _itineraries(closest, pieces).select("user_id", *_travels())


PROFILE_COLUMNS = ("user_id", "act_city", "home_city", "travel_count", "travel_array", "local_time")


def user_geo_profile(closest: DataFrame, tz: str = DEFAULT_TIME_ZONE, pieces: int | None = None) -> DataFrame:
    """The profile mart: one row per user with a located message.

    One range shuffle, one on (user, piece) and one on the user serve both the
    itinerary and the places; ``closest`` is read once.  ``pieces`` is the
    number of ranges (the session's shuffle partitions); the result does not
    depend on it.
    """
    return user_profiles(closest, tz, pieces).select(*PROFILE_COLUMNS)


def user_profiles(closest: DataFrame, tz: str = DEFAULT_TIME_ZONE, pieces: int | None = None) -> DataFrame:
    """The profile mart's columns and ``has_home``: whether the user has a home city (which may be unnamed)."""
    return _itineraries(closest, pieces).select("user_id", *_places(tz), *_travels()).select(*PROFILE_COLUMNS, F.col("_has_home").alias("has_home"))
