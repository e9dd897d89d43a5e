import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cityweave.operators.profile import (
    _pieces,
    current_city,
    home_city,
    travel_events,
    travel_stats,
    user_geo_profile,
)
from tests.conftest import rows

SCHEMA = "user_id bigint, message_id bigint, message_ts timestamp, city_id string, city_name string"
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def _closest(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def _seq(user, names, start_id=0, step=dt.timedelta(hours=7)):
    return [(user, start_id + i, T0 + i * step, None if n is None else n.lower(), n) for i, n in enumerate(names)]


def test_itineraries(spark):
    data = _seq(1, ["A", "A", "B", "A"]) + _seq(2, ["A", None, "A"], 10) + _seq(3, [None], 20)
    out = {r.user_id: r for r in travel_stats(_closest(spark, data)).collect()}
    assert (out[1].travel_count, out[1].travel_array) == (3, ["A", "B", "A"])
    assert (out[2].travel_count, out[2].travel_array) == (2, ["A", "A"])
    assert (out[3].travel_count, out[3].travel_array) == (1, [])


def test_equal_timestamps_break_on_message_then_city(spark):
    t = T0
    data = [(1, 5, t, "2", "B"), (1, 5, t, "1", "A"), (1, 4, t, "3", "C")]
    out = travel_stats(_closest(spark, data)).collect()[0]
    assert out.travel_array == ["C", "A", "B"]


def _brute_travel(df):
    w = Window.partitionBy("user_id").orderBy("message_ts", "message_id", "city_id")
    prev = F.lag("city_name").over(w)
    return df.withColumn("_p", prev).where(F.col("_p").isNull() | (F.col("city_name") != F.col("_p")))


def test_two_level_itinerary_matches_single_window(spark):
    rnd = random.Random(3)
    data = []
    mid = 0
    for user in range(6):
        t = T0
        for _ in range(rnd.randint(1, 60)):
            t += dt.timedelta(minutes=rnd.choice([0, 5, 300, 1500, 4000]))
            name = rnd.choice(["A", "B", "C", None]) if user != 5 else "A"
            data.append((user, mid, t, None if name is None else name.lower(), name))
            mid += 1
    df = _closest(spark, data)
    for pieces in (1, 3, 40):
        got = travel_events(df, pieces).select("user_id", "message_id", "city_id")
        want = _brute_travel(df).select("user_id", "message_id", "city_id")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    stats = {r.user_id: r for r in travel_stats(df, 7).collect()}
    for user, r in stats.items():
        names = [x for x in r.travel_array]
        assert all(a != b for a, b in zip(names, names[1:])) or any(
            row[4] is None for row in data if row[0] == user
        )
    assert stats[5].travel_count == 1 and stats[5].travel_array == ["A"]


def test_home_city_rules(spark):
    data = _seq(1, ["A", "A"]) + _seq(2, ["A", "B"], 10) + _seq(3, ["A", None], 20) + _seq(4, [None], 30)
    got = rows(home_city(_closest(spark, data)))
    # a NULL name counts as a city: user 3 has two, user 4 one (home NULL)
    assert got == [(1, "A"), (4, None)]


def test_current_city_latest_with_tie_break(spark):
    t = T0
    data = [(1, 1, t, "1", "A"), (1, 2, t + dt.timedelta(hours=1), "3", "C"),
            (1, 2, t + dt.timedelta(hours=1), "2", "B")]
    out = current_city(_closest(spark, data)).collect()[0]
    # same message tied between two cities: smaller city_id wins
    assert out.act_city == "B"
    assert out.local_time is not None


def test_profile_has_one_row_per_user(spark):
    data = _seq(1, ["A", "B"]) + _seq(2, ["A"], 10)
    p = user_geo_profile(_closest(spark, data))
    got = {r.user_id: r for r in p.collect()}
    assert set(got) == {1, 2}
    assert got[1].home_city is None and got[2].home_city == "A"
    assert got[1].travel_array == ["A", "B"] and got[1].act_city == "B"


def test_stitched_stats_match_single_window(spark):
    rnd = random.Random(9)
    data, mid = [], 0
    for user in range(8):
        t = T0
        for _ in range(rnd.randint(1, 50)):
            t += dt.timedelta(minutes=rnd.choice([0, 30, 600, 1440, 3000]))
            name = rnd.choice(["A", "B", None]) if user % 2 else rnd.choice(["A", "B", "C"])
            data.append((user, mid, t if rnd.random() > 0.05 else None, None if name is None else name.lower(), name))
            mid += 1
    df = _closest(spark, data)
    legs = _brute_travel(df)
    want = legs.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("travel_count"),
        F.array_sort(F.collect_list(F.struct("message_ts", "message_id", "city_id", "city_name"))).alias("s"),
    ).select("user_id", "travel_count",
             F.filter(F.transform("s", lambda x: x["city_name"]), lambda x: x.isNotNull()).alias("travel_array"))
    for pieces in (1, 4, 50):
        assert rows(travel_stats(df, pieces)) == rows(want), pieces


def test_message_time_fields_and_parsed_order(spark):
    from cityweave.operators.profile import COALESCED_TIME_FIELDS, message_points

    ev = spark.createDataFrame(
        [("message", 1, 7, "2024-01-01 9:00:00", None, 0.0, 0.0),
         ("message", 2, 7, "2024-01-01 10:00:00", None, 0.0, 0.0),
         ("message", 3, 7, None, "2024-01-01 11:00:00", 0.0, 0.0)],
        "event_type string, message_id bigint, message_from bigint, message_ts string, datetime string,"
        " lat double, lon double",
    )
    both = message_points(ev, time_fields=COALESCED_TIME_FIELDS)
    assert both.count() == 3
    strict = message_points(ev)
    assert strict.count() == 2
    # 10:00 is later than 9:00 although '9' > '1' as text
    latest = both.orderBy(F.col("message_ts").desc()).first()
    assert latest.message_id == 3
    assert strict.orderBy(F.col("message_ts").desc()).first().message_id == 2


def test_home_city_is_by_name_not_id(spark):
    data = [(1, 1, T0, "10", "Sydney"), (1, 2, T0 + dt.timedelta(hours=1), "11", "Sydney")]
    assert rows(home_city(_closest(spark, data))) == [(1, "Sydney")]


def test_places_aggregation_equals_window_form(spark):
    rnd = random.Random(4)
    data, mid = [], 0
    for user in range(30):
        for _ in range(rnd.randint(1, 12)):
            t = T0 + dt.timedelta(hours=rnd.randint(0, 40))
            for city in rnd.sample(["A", "B", "C", None], rnd.choice([1, 1, 2])):
                data.append((user, mid, t, None if city is None else city.lower(), city))
            mid += 1
    df = _closest(spark, data)
    per_city = df.groupBy("user_id", "city_name").count()
    w_all = Window.partitionBy("user_id")
    home_w = per_city.withColumn("n", F.count(F.lit(1)).over(w_all)).where("n = 1").select(
        "user_id", F.col("city_name").alias("home_city"))
    assert rows(home_city(df)) == rows(home_w)
    w_last = Window.partitionBy("user_id").orderBy(
        F.col("message_ts").desc(), F.col("message_id").desc(), F.col("city_id").asc())
    cur_w = df.withColumn("rn", F.row_number().over(w_last)).where("rn = 1").select(
        "user_id", F.col("city_name").alias("act_city"))
    assert rows(current_city(df).select("user_id", "act_city")) == rows(cur_w)


def test_pieces_are_even_whatever_the_times(spark):
    """One user, 3000 rows at one time and one row 90 days before: no piece is large."""
    data = [(1, i, T0, str(i % 3), "ABC"[i % 3]) for i in range(3000)] + [(1, -1, T0 - dt.timedelta(days=90), "0", "A")]
    df = _closest(spark, data)
    sizes = [r["count"] for r in _pieces(df, 20).groupBy("_piece").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 3 * 3001 / 20
    got = travel_stats(df, 20).collect()[0]
    assert got.travel_count == 3000 and got.travel_array[:4] == ["A", "B", "C", "A"]
