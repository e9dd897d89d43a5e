import datetime as dt
import math

from pyspark.sql import functions as F

from cityweave.functions import (
    EARTH_RADIUS_KM,
    decimal_comma_to_double,
    event_time,
    haversine_km,
    iso_week_of,
    local_time,
    month_of,
    to_user_id,
)

KM_PER_DEG = EARTH_RADIUS_KM * math.pi / 180


def _dist(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    return [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]


def test_haversine_basic(spark):
    same, syd_mel, sym = _dist(
        spark,
        [(-33.865, 151.2094, -33.865, 151.2094), (-33.865, 151.2094, -37.8136, 144.9631),
         (-37.8136, 144.9631, -33.865, 151.2094)],
    )
    assert same == 0.0
    assert 705 < syd_mel < 720
    assert sym == syd_mel


def test_haversine_edges_have_no_nan(spark):
    d = _dist(
        spark,
        [(90.0, 0.0, 90.0, 120.0), (-90.0, 10.0, 90.0, 10.0), (0.0, 179.9999, 0.0, -179.9999),
         (10.0, 20.0, -10.0, -160.0), (0.0, 0.0, 0.0, 180.0)],
    )
    assert all(not math.isnan(x) for x in d)
    assert d[0] < 1e-6
    # asin loses digits next to 1: antipodal distances are good to ~1 m
    assert abs(d[1] - math.pi * EARTH_RADIUS_KM) < 1e-3
    assert d[2] < 0.03
    assert abs(d[3] - math.pi * EARTH_RADIUS_KM) < 1e-3
    assert abs(d[4] - math.pi * EARTH_RADIUS_KM) < 1e-3


def test_haversine_around_one_km(spark):
    inside, outside = _dist(
        spark, [(0.0, 10.0, 0.9999 / KM_PER_DEG, 10.0), (0.0, 10.0, 1.0001 / KM_PER_DEG, 10.0)]
    )
    assert inside < 1.0 < outside


def test_decimal_comma_and_ids(spark):
    df = spark.createDataFrame(
        [("-33,865", "1"), ("x,8", "abc"), ("151.2094", "3000000000"), (None, None)], "t string, u string"
    )
    out = df.select(decimal_comma_to_double("t").alias("v"), to_user_id("u").alias("id")).collect()
    assert out[0].v == -33.865 and out[0].id == 1
    assert out[1].v is None and out[1].id is None
    assert out[2].v == 151.2094 and out[2].id == 3000000000
    assert out[3].v is None and out[3].id is None


def test_calendar_parts(spark):
    df = spark.createDataFrame([("2022-01-01 10:00:00", None), (None, "2024-12-30 00:00:00"), (None, None)],
                               "message_ts string, datetime string")
    ts = event_time()
    out = df.select(month_of(ts).alias("m"), iso_week_of(ts).alias("w")).collect()
    assert (out[0].m, out[0].w) == (1, 52)
    assert (out[1].m, out[1].w) == (12, 1)
    assert (out[2].m, out[2].w) == (None, None)


def test_local_time_sydney_dst(spark):
    df = spark.createDataFrame([("2022-06-21 12:00:00",), ("2022-01-21 12:00:00",)], "t string")
    out = df.select(local_time(F.to_timestamp("t")).cast("timestamp_ntz").alias("lt")).collect()
    assert out[0].lt == dt.datetime(2022, 6, 21, 22, 0)
    assert out[1].lt == dt.datetime(2022, 1, 21, 23, 0)
