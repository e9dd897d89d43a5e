"""Geo-social fixture derived from the driver's generic tables.

The driver tables (``events``, ``nation``) carry no coordinates or social
fields, so cities and geo events are derived from them with portable SQL
expressions (FIXTURES.md section 3).  The same definition is repeated in the
DuckDB oracle, so both engines see identical rows.  Everything grows with
``events``: one geo event per driver event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityweave.sources.cities import parse_city_dictionary
from cityweave.sources.events import EVENT_FIELDS

# The fixture's data definition (FIXTURES.md section 3).
CITY_LAT_EXPR = (
    "cast(-44000 + ((n_nationkey % 24) % 5)*7000 + (n_nationkey % 24)*113 as double)"
    " / cast(1000 as double)"
)
CITY_LON_EXPR = (
    "cast(114000 + cast(floor((n_nationkey % 24)/5) as int)*8000 + (n_nationkey % 24)*71 as double)"
    " / cast(1000 as double)"
)
TS_TEXT_EXPR = "cast(ts + interval '1' day * cast(event_id % 90 - 20 as int) as string)"
EVENT_DATE_EXPR = "cast(ts + interval '1' day * cast(event_id % 90 - 20 as int) as date)"
EVENT_TYPE_EXPR = (
    "case event_type when 'view' then 'message' when 'click' then 'message'"
    " when 'error' then 'reaction' when 'purchase' then 'subscription'"
    " else 'registration' end"
)
CITY_INDEX_EXPR = (
    "cast(case when event_id % 5 < 3 or user_id % 10 = 0 then user_id % 24"
    " else (event_id*7) % 24 end as int)"
)
GE_EXPRS = {
    "message_id": "case when event_type='message' then event_id"
    " when event_type='reaction' then event_id % 500 end",
    "message_from": "case when event_type='message' then user_id end",
    "message_to": "case when event_type='message' and event_id % 4 <> 0"
    " then (user_id*31+event_id) % 150 end",
    "message_ts": "case when event_type='message' and event_id % 3 = 0 then ts_s end",
    "datetime": "case when not (event_type='message' and event_id % 3 = 0)"
    " and event_id % 101 <> 0 then ts_s end",
    "usr": "case when event_type in ('subscription','registration') then cast(user_id as string) end",
    "subscription_channel": "case when event_type='subscription' and event_id % 23 <> 0 then event_id % 17 end",
    "reaction_from": "case when event_type='reaction' then cast(user_id as string) end",
    "lat": "case when event_id % 50 <> 0 then cast(-44000 + (k % 5)*7000 + k*113"
    " + (event_id*13) % 11 - 5 as double)/cast(1000 as double) end",
    "lon": "case when event_id % 50 <> 0 then cast(114000 + cast(floor(k/5) as int)*8000"
    " + k*71 + (event_id*17) % 7 - 3 as double)/cast(1000 as double) end",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def city_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary as it appears in the CSV: strings with decimal commas."""
    nation = _table(spark, sf_dir, "nation")
    return nation.select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("city"),
        F.regexp_replace(F.expr(CITY_LAT_EXPR).cast("string"), r"\.", ",").alias("lat"),
        F.regexp_replace(F.expr(CITY_LON_EXPR).cast("string"), r"\.", ",").alias("lng"),
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 cities (24 places; city 24 sits exactly on city 0)."""
    return parse_city_dictionary(city_text(spark, sf_dir))


def _spread(events: DataFrame) -> DataFrame:
    """A table of fewer splits than cores, such as one small file, is dealt to all cores; others stay as they are."""
    cores = events.sparkSession.sparkContext.defaultParallelism
    return events.repartition(cores) if events.rdd.getNumPartitions() < cores else events


def geo_events_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One geo event per driver event, in the flat form the operators use."""
    ge0 = _spread(_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")).select(
        "event_id",
        "user_id",
        F.expr(TS_TEXT_EXPR).alias("ts_s"),
        F.expr(EVENT_DATE_EXPR).alias("date"),
        F.expr(EVENT_TYPE_EXPR).alias("event_type"),
        F.expr(CITY_INDEX_EXPR).alias("k"),
    )
    return ge0.select(
        "event_id",
        "date",
        "event_type",
        *[F.expr(GE_EXPRS[name]).alias(name) for name in _FLAT_ORDER if name in GE_EXPRS],
    ).select("event_id", "date", *_FLAT_ORDER)


_FLAT_ORDER = [dst for _, dst in EVENT_FIELDS] + ["event_type", "lat", "lon"]


def geo_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events in the production layout: ``event`` struct + top level."""
    flat = geo_events_flat(spark, sf_dir)
    return flat.select(
        "event_id",
        "date",
        F.struct(*[F.col(dst).alias(src) for src, dst in EVENT_FIELDS]).alias("event"),
        "event_type",
        "lat",
        "lon",
    )


def many_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large dictionary over the whole globe, derived from ``orders`` (grows with it)."""
    key = F.col("o_orderkey")
    return _table(spark, sf_dir, "orders").select(
        key.cast("string").alias("city_id"),
        F.concat(F.lit("c"), key.cast("string")).alias("city_name"),
        ((key * 7919 % 170_001 - 85_000) / F.lit(1000.0)).alias("city_lat"),
        ((key * 104_729 % 360_001 - 180_000) / F.lit(1000.0)).alias("city_lon"),
    )


def one_place_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which a third share a NULL key and one coordinate."""
    flat = geo_events_flat(spark, sf_dir)
    hot = F.col("event_id") % 3 == 0
    return flat.withColumns({
        "message_id": F.when(~hot, F.col("event_id") % 1000),
        "lat": F.when(hot, F.lit(-33.0)).otherwise(F.col("lat")),
        "lon": F.when(hot, F.lit(120.0)).otherwise(F.col("lon")),
    }).where("lat is not null and lon is not null")
