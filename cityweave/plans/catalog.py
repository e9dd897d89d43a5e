"""Named queries over the derived fixture, one per operator of the marts.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame (but for
``window_events``, which first writes the log it reads) over the whole fixture (every event of ``events``, every city of ``nation``).
Results are shown the same way the DuckDB oracle shows them: timestamps as
wall-clock (``timestamp_ntz``), dates as ISO text, distances rounded to 4
decimals, the itinerary as comma-joined text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityweave.functions.calendar import iso_week_of, local_time, month_of
from cityweave.functions.parsing import event_time
from cityweave.operators import nearest as nearest_ops
from cityweave.operators import pair_classes, profile, social, zones
from cityweave.session import checkpoint_dir, delete_at_exit, prepare_session
from cityweave.sources import fixture
from cityweave.sources.cities import read_cities
from cityweave.sources.contract import EVENT_CONTRACT
from cityweave.sources.events import date_window, flatten_events, read_events

# Parameters of the fixed-parameter queries (shared with the oracle).
WINDOW_PROCESS_DATE = "2024-02-15"
WINDOW_DEPTH = 30
AS_OF = "2024-05-01 12:00:00"
COARSE_CELL_KM = 2.5
SHORT_LISTS = 6
HOT_ROWS = 10
MANY_PIECES = 64
BURST_TIME = "2024-03-01 12:00:00"


def _ntz(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def _iso_day(c: str) -> Column:
    """Dates as ``YYYY-MM-DD`` text: engines disagree on how a date leaves the engine."""
    return F.date_format(F.col(c), "yyyy-MM-dd")


def _km(c: str = "distance_km") -> Column:
    """Rounded to 4 decimals, halves up: through decimal digits, as ``round`` does it, only near a half."""
    scaled = F.col(c) * F.lit(1e4)
    whole = F.rint(scaled)
    plain = (scaled >= 0) & (scaled < 1e10) & (F.abs(scaled - whole) < 0.49999)
    return F.when(plain, whole / F.lit(1e4)).otherwise(F.round(F.col(c), 4)).alias(c)


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Fixture events in the production layout, flattened, and the cities."""
    prepare_session(spark)
    return flatten_events(fixture.geo_events(spark, sf_dir)), fixture.cities(spark, sf_dir)


def _closest_messages(spark, sf_dir, time_fields=profile.MESSAGE_TIME_FIELDS, **options) -> DataFrame:
    """Nearest city per message."""
    events, cities = _inputs(spark, sf_dir)
    return profile.closest_message_cities(profile.message_points(events, time_fields), cities, **options)


def _closest_events(spark, sf_dir, key=zones.KEYED) -> DataFrame:
    events, cities = _inputs(spark, sf_dir)
    return zones.closest_event_cities(events, cities, key=key)


# --- sources, projections, scalar functions ---------------------------------


def decimal_comma_parse(spark, sf_dir):
    _inputs(spark, sf_dir)
    return fixture.cities(spark, sf_dir)


def event_projection(spark, sf_dir):
    events, _ = _inputs(spark, sf_dir)
    m = profile.message_points(events)
    return m.select("message_id", "user_id", _ntz("message_ts").alias("message_ts"),
                    "message_lat", "message_lon", "event_type")


def event_time_coalesce(spark, sf_dir):
    events, _ = _inputs(spark, sf_dir)
    return events.select("event_id", "event_type", _ntz(event_time()).alias("event_ts"))


def date_window_filter(spark, sf_dir):
    events, _ = _inputs(spark, sf_dir)
    return date_window(events, WINDOW_PROCESS_DATE, WINDOW_DEPTH, "date").select(
        "event_id", "event_type", _iso_day("date").alias("date")
    )


def calendar_parts(spark, sf_dir):
    events, _ = _inputs(spark, sf_dir)
    ts = event_time()
    return events.select("event_id", month_of(ts).alias("month"), iso_week_of(ts).alias("week"))


def local_time_query(spark, sf_dir):
    events, _ = _inputs(spark, sf_dir)
    m = profile.message_points(events)
    return m.select("message_id", _ntz(local_time("message_ts")).alias("local_time"))


# --- nearest city -------------------------------------------------------------


def nearest_city_messages(spark, sf_dir):
    c = _closest_messages(spark, sf_dir)
    return c.select("message_id", "user_id", _ntz("message_ts").alias("message_ts"), _km(),
                    "city_id", "city_name")


def _event_city_rows(df: DataFrame) -> DataFrame:
    return df.select("event_id", "message_id", "event_type", "city_id", _km())


def nearest_city_events_keyed(spark, sf_dir):
    return _event_city_rows(_closest_events(spark, sf_dir))


def nearest_city_events_per_row(spark, sf_dir):
    return _event_city_rows(_closest_events(spark, sf_dir, key=None))


def nearest_city_grid(spark, sf_dir):
    """Per-row nearest city through smaller leaves: the result must not depend on their lists."""
    events, cities = _inputs(spark, sf_dir)
    located = nearest_ops.nearest_city(zones.located_events(events), cities, leaf_places=SHORT_LISTS)
    return _event_city_rows(located)


def nearest_city_many(spark, sf_dir):
    """Per-row nearest city with thousands of cities, for one event of each place."""
    prepare_session(spark)
    places = fixture.geo_events_flat(spark, sf_dir).where("lat is not null and lon is not null")
    spread = places.select(
        "event_id",
        (F.col("lat") + F.col("event_id") % 997 / F.lit(10.0)).alias("lat"),
        (F.col("lon") - F.col("event_id") % 1999 / F.lit(8.0)).alias("lon"),
    )
    found = nearest_ops.nearest_city(spread, fixture.many_cities(spark, sf_dir))
    return found.select("event_id", "city_id", _km())


def nearest_city_one_place(spark, sf_dir):
    """Keyed nearest city where a third of the rows share a NULL key and one coordinate."""
    _, cities = _inputs(spark, sf_dir)
    points = fixture.one_place_events(spark, sf_dir).select("event_id", "message_id", "lat", "lon")
    found = nearest_ops.nearest_city(points, cities, key=["message_id"], hot_rows=HOT_ROWS)
    return found.select("event_id", "message_id", "city_id", _km())


def window_events(spark, sf_dir):
    """Events and cities through the real readers: the fixture written as a day log and a
    CSV dictionary to the shared folder, a window read back, cities attached."""
    events, _ = _inputs(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/log-{uuid.uuid4().hex}"
    delete_at_exit(spark, root)
    fixture.geo_events(spark, sf_dir).write.partitionBy("date").parquet(f"{root}/events")
    fixture.city_text(spark, sf_dir).write.option("header", True).option("sep", ";").csv(f"{root}/cities")
    window = flatten_events(read_events(spark, f"{root}/events/date", WINDOW_PROCESS_DATE, WINDOW_DEPTH, missing="skip"))
    found = nearest_ops.nearest_city(zones.located_events(window), read_cities(spark, f"{root}/cities"))
    return _event_city_rows(found)


def window_events_contract(spark, sf_dir):
    """A window of three layouts read by the event contract: ids narrower on some days, fields missing on others."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/log-{uuid.uuid4().hex}"
    delete_at_exit(spark, root)
    log, event = fixture.geo_events(spark, sf_dir), F.col("event")
    narrow = event.withField("message_to", event["message_to"].cast("int")).withField("subscription_channel", event["subscription_channel"].cast("smallint"))
    fewer = event.dropFields("message_to", "reaction_from")
    for at, of_day in enumerate((event, narrow, fewer)):
        days = log.where(F.dayofmonth(F.col("date").cast("date")) % 3 == at)
        days.withColumn("event", of_day).write.mode("append").partitionBy("date").parquet(f"{root}/events")
    window = read_events(spark, f"{root}/events/date", WINDOW_PROCESS_DATE, WINDOW_DEPTH, missing="skip", contract=EVENT_CONTRACT)
    flat = flatten_events(window)
    return flat.groupBy(F.col("date").cast("string").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum("message_id").alias("sum_message_id"),
        F.sum("message_to").alias("sum_message_to"),
        F.sum("subscription_channel").alias("sum_channel"),
        F.count("reaction_from").alias("n_reaction_from"),
    )


# --- profile mart -------------------------------------------------------------


def per_city_counts(spark, sf_dir):
    return profile.per_city_counts(_closest_messages(spark, sf_dir))


def current_city(spark, sf_dir):
    c = profile.current_city(_closest_messages(spark, sf_dir))
    return c.select("user_id", "act_city", _ntz("local_time").alias("local_time"))


def home_city(spark, sf_dir):
    return profile.home_city(_closest_messages(spark, sf_dir))


def user_cities(spark, sf_dir):
    u = profile.user_places(_closest_messages(spark, sf_dir))
    return u.select("user_id", "act_city", "home_city", _ntz("local_time").alias("local_time"))


def travel_events(spark, sf_dir):
    t = profile.travel_events(_closest_messages(spark, sf_dir))
    return t.select("user_id", "message_id", _ntz("message_ts").alias("message_ts"),
                    "city_id", "city_name")


def _itinerary_text(c: str = "travel_array") -> Column:
    return F.when(F.size(c) > 0, F.array_join(c, ",")).alias(c)


def _stats_rows(t: DataFrame) -> DataFrame:
    return t.select("user_id", "travel_count", _itinerary_text())


def travel_stats(spark, sf_dir):
    return _stats_rows(profile.travel_stats(_closest_messages(spark, sf_dir)))


def travel_stats_hot(spark, sf_dir):
    """Itineraries cut into many pieces: messages of a third of all users belong to one
    user, nine of ten of them at one time."""
    events, cities = _inputs(spark, sf_dir)
    messages = profile.message_points(events, profile.COALESCED_TIME_FIELDS)
    hot = F.col("user_id") % 3 == 0
    burst = hot & (F.col("message_id") % 10 != 0)
    messages = messages.withColumns({
        "user_id": F.when(hot, F.lit(0)).otherwise(F.col("user_id")).cast("bigint"),
        "message_ts": F.when(burst, F.lit(BURST_TIME).cast("timestamp")).otherwise(F.col("message_ts")),
    })
    closest = profile.closest_message_cities(messages, cities)
    return _stats_rows(profile.travel_stats(closest, pieces=MANY_PIECES))


def _profile_rows(closest: DataFrame) -> DataFrame:
    p = profile.user_geo_profile(closest)
    return p.select("user_id", "act_city", "home_city", "travel_count", _itinerary_text(), _ntz("local_time").alias("local_time"))


def user_geo_profile(spark, sf_dir):
    return _profile_rows(_closest_messages(spark, sf_dir))


def user_geo_profile_strict(spark, sf_dir):
    """The default reading of the message time, named: ``message_ts`` only."""
    return _profile_rows(_closest_messages(spark, sf_dir, ("message_ts",)))


def user_geo_profile_coalesced(spark, sf_dir):
    """Profile mart that also takes messages whose time is only in ``datetime``."""
    return _profile_rows(_closest_messages(spark, sf_dir, profile.COALESCED_TIME_FIELDS))


# --- zone mart ------------------------------------------------------------------


def zone_month_metrics(spark, sf_dir):
    return zones.zone_month_metrics(_closest_events(spark, sf_dir))


def zone_week_metrics(spark, sf_dir):
    return zones.zone_week_metrics(_closest_events(spark, sf_dir))


def zone_metrics(spark, sf_dir):
    return zones.zone_metrics(_closest_events(spark, sf_dir))


def zone_metrics_year_month(spark, sf_dir):
    """Zone mart keyed by calendar year too (Dec 2023 and Dec 2024 stay apart)."""
    return zones.zone_metrics(_closest_events(spark, sf_dir), calendar="year_month")


def zone_metrics_per_row(spark, sf_dir):
    """Zone mart with every located event counted (``key=None``)."""
    return zones.zone_metrics(_closest_events(spark, sf_dir, key=None))


def _of_days(spark, sf_dir, keyed: bool) -> DataFrame:
    events, cities = _inputs(spark, sf_dir)
    located = events.where("lat is not null and lon is not null")
    return zones.zone_metrics_of_days(zones.day_partials(located, cities, keyed=keyed), keyed=keyed)


def zone_metrics_days(spark, sf_dir):
    """Zone mart merged from day partials, keys competing over all days."""
    return _of_days(spark, sf_dir, True)


def zone_metrics_days_per_row(spark, sf_dir):
    """Zone mart merged from day partials, every located event counted."""
    return _of_days(spark, sf_dir, False)


# --- recommendation mart ------------------------------------------------------


def user_channels(spark, sf_dir):
    events, _ = _inputs(spark, sf_dir)
    return social.user_channels(events)


def channel_pair_counts(spark, sf_dir):
    events, _ = _inputs(spark, sf_dir)
    return social.channel_pair_counts(social.user_channels(events))


def contact_pairs(spark, sf_dir):
    events, _ = _inputs(spark, sf_dir)
    return social.contact_pairs(events)


def pairs_without_contact_counts(spark, sf_dir):
    events, _ = _inputs(spark, sf_dir)
    return social.pairs_without_contact_counts(social.user_channels(events), social.contact_pairs(events))


def channel_classes(spark, sf_dir):
    """Membership of the classes: users of one channel set."""
    events, _ = _inputs(spark, sf_dir)
    return pair_classes.channel_classes(social.user_channels(events))


def channel_pairs(spark, sf_dir):
    """Pairs of users of each channel as class rows with the number of pairs they stand for."""
    events, _ = _inputs(spark, sf_dir)
    channels = social.user_channels(events)
    return pair_classes.channel_pair_classes(channels, pair_classes.channel_classes(channels))


def contact_exceptions(spark, sf_dir):
    """Contact pairs inside each channel: what the pairs without contact leave out."""
    events, _ = _inputs(spark, sf_dir)
    return pair_classes.contact_exceptions(social.user_channels(events), social.contact_pairs(events))


def pairs_without_contact(spark, sf_dir):
    """Class rows with the pairs that are not in contact."""
    events, _ = _inputs(spark, sf_dir)
    channels = social.user_channels(events)
    classes = pair_classes.channel_classes(channels)
    return pair_classes.pairs_without_contact_classes(channels, social.contact_pairs(events), classes)


def latest_action(spark, sf_dir):
    events, _ = _inputs(spark, sf_dir)
    la = social.latest_action(events)
    return la.select("user_id", _ntz("action_time").alias("action_time"), "lat", "lon", "event_type")


def latest_action_zone(spark, sf_dir):
    """Zone (nearest city, ties kept) of each user's latest position."""
    events, cities = _inputs(spark, sf_dir)
    z = social.zoned_positions(social.latest_action(events), cities)
    return z.select("user_id", F.explode("zone_ids").alias("zone_id"))


def pair_distance(spark, sf_dir):
    """Distance between the latest positions of users who messaged each other."""
    events, _ = _inputs(spark, sf_dir)
    d = social.pair_distance(social.contact_pairs(events), social.latest_action(events))
    return d.select("user_left", "user_right", "user_left_lat", "user_left_lon",
                    "user_right_lat", "user_right_lon", _km())


def _nearby(spark, sf_dir, **options) -> DataFrame:
    events, _ = _inputs(spark, sf_dir)
    return social.nearby_pairs(
        social.user_channels(events),
        social.latest_action(events),
        social.contact_pairs(events),
        **options,
    )


def _nearby_rows(df: DataFrame) -> DataFrame:
    return df.select("user_left", "user_right", "user_left_lat", "user_left_lon",
                     "user_right_lat", "user_right_lon", _km())


def nearby_pairs(spark, sf_dir):
    return _nearby_rows(_nearby(spark, sf_dir))


def nearby_pairs_grid(spark, sf_dir):
    """Same pairs through a coarser grid: the result must not depend on the cell size."""
    return _nearby_rows(_nearby(spark, sf_dir, cell_km=COARSE_CELL_KM))


def nearby_pairs_salted(spark, sf_dir):
    """Same pairs with small blocks: every dense (channel, cell) is salted."""
    return _nearby_rows(_nearby(spark, sf_dir, hot_rows=HOT_ROWS))


def nearby_pairs_zone(spark, sf_dir):
    events, cities = _inputs(spark, sf_dir)
    z = social.zoned_nearby_pairs(events, cities)
    return z.select("user_left", "user_right", "zone_id")


def pair_recommendations(spark, sf_dir):
    events, cities = _inputs(spark, sf_dir)
    r = social.pair_recommendations(events, cities, as_of=AS_OF)
    return r.select("user_left", "user_right", _iso_day("processed_dttm").alias("processed_dttm"),
                    "zone_id", _ntz("local_time").alias("local_time"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "decimal_comma_parse": decimal_comma_parse,
    "event_projection": event_projection,
    "event_time_coalesce": event_time_coalesce,
    "date_window_filter": date_window_filter,
    "calendar_parts": calendar_parts,
    "local_time": local_time_query,
    "nearest_city_messages": nearest_city_messages,
    "nearest_city_events_keyed": nearest_city_events_keyed,
    "nearest_city_events_per_row": nearest_city_events_per_row,
    "nearest_city_grid": nearest_city_grid,
    "nearest_city_many": nearest_city_many,
    "nearest_city_one_place": nearest_city_one_place,
    "window_events": window_events,
    "window_events_contract": window_events_contract,
    "per_city_counts": per_city_counts,
    "current_city": current_city,
    "home_city": home_city,
    "user_cities": user_cities,
    "travel_events": travel_events,
    "travel_stats": travel_stats,
    "user_geo_profile": user_geo_profile,
    "travel_stats_hot": travel_stats_hot,
    "user_geo_profile_strict": user_geo_profile_strict,
    "user_geo_profile_coalesced": user_geo_profile_coalesced,
    "zone_month_metrics": zone_month_metrics,
    "zone_week_metrics": zone_week_metrics,
    "zone_metrics": zone_metrics,
    "zone_metrics_per_row": zone_metrics_per_row,
    "zone_metrics_year_month": zone_metrics_year_month,
    "zone_metrics_days": zone_metrics_days,
    "zone_metrics_days_per_row": zone_metrics_days_per_row,
    "user_channels": user_channels,
    "channel_pair_counts": channel_pair_counts,
    "contact_pairs": contact_pairs,
    "channel_classes": channel_classes,
    "channel_pairs": channel_pairs,
    "contact_exceptions": contact_exceptions,
    "pairs_without_contact": pairs_without_contact,
    "pairs_without_contact_counts": pairs_without_contact_counts,
    "latest_action": latest_action,
    "latest_action_zone": latest_action_zone,
    "pair_distance": pair_distance,
    "nearby_pairs": nearby_pairs,
    "nearby_pairs_grid": nearby_pairs_grid,
    "nearby_pairs_salted": nearby_pairs_salted,
    "nearby_pairs_zone": nearby_pairs_zone,
    "pair_recommendations": pair_recommendations,
}
