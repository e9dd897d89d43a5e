import datetime as dt
import random

from pyspark.sql import functions as F

from cityweave.functions.geo import haversine_km
from cityweave.functions.parsing import parse_timestamp, to_user_id
from cityweave.operators.social import (
    channel_pair_counts,
    contact_pairs,
    latest_action,
    nearby_pairs,
    pair_recommendations,
    pairs_without_contact_counts,
    user_channels,
)
from cityweave.plans.catalog import _inputs
from tests.conftest import SF_SMALL, rows


def _brute_nearby(channels, positions, contacts, max_km):
    a = channels.alias("a")
    b = channels.alias("b")
    pairs = a.join(b, (F.col("a.subscription_channel") == F.col("b.subscription_channel"))
                   & (F.col("a.user_id") < F.col("b.user_id"))).select(
        F.col("a.user_id").alias("user_left"), F.col("b.user_id").alias("user_right"))
    pairs = pairs.join(contacts, ["user_left", "user_right"], "left_anti")
    lp = positions.select(F.col("user_id").alias("user_left"), F.col("lat").alias("la"), F.col("lon").alias("lo"))
    rp = positions.select(F.col("user_id").alias("user_right"), F.col("lat").alias("ra"), F.col("lon").alias("ro"))
    d = pairs.join(lp, "user_left").join(rp, "user_right").withColumn("d", haversine_km("la", "lo", "ra", "ro"))
    return d.where(F.col("d") < max_km).select("user_left", "user_right")


def test_grid_join_equals_brute_force_everywhere(spark):
    rnd = random.Random(11)
    centres = [(89.9995, 0.0), (-89.9995, 77.0), (0.0, 179.9995), (0.0, -179.9995), (0.0, 0.0), (51.5, -0.1)]
    pos, chans = [], []
    uid = 0
    for lat0, lon0 in centres:
        for _ in range(25):
            lat = max(-90.0, min(90.0, lat0 + rnd.uniform(-0.008, 0.008)))
            lon = lon0 + rnd.uniform(-0.008, 0.008)
            lon = (lon + 180) % 360 - 180
            pos.append((uid, lat, lon))
            for ch in rnd.sample(range(4), rnd.randint(1, 3)):
                chans.append((uid, ch))
            uid += 1
    positions = spark.createDataFrame(pos, "user_id bigint, lat double, lon double")
    channels = spark.createDataFrame(chans, "user_id bigint, subscription_channel bigint")
    contacts = spark.createDataFrame([(0, 1), (2, 3), (30, 31)], "user_left bigint, user_right bigint")
    for max_km, cell in ((1.0, None), (1.0, 3.0), (0.3, None)):
        got = nearby_pairs(channels, positions, contacts, max_km=max_km, cell_km=cell).select(
            "user_left", "user_right")
        want = _brute_nearby(channels, positions, contacts, max_km)
        assert want.count() > 0
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_one_row_per_shared_channel_and_contacts_removed(spark):
    positions = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.001), (3, 0.0, 0.002)],
                                      "user_id bigint, lat double, lon double")
    channels = spark.createDataFrame([(1, 10), (2, 10), (1, 11), (2, 11), (3, 10)],
                                     "user_id bigint, subscription_channel bigint")
    contacts = spark.createDataFrame([(2, 3)], "user_left bigint, user_right bigint")
    got = rows(nearby_pairs(channels, positions, contacts), "user_left", "user_right")
    assert got == [(1, 2), (1, 2), (1, 3)]
    assert rows(nearby_pairs(channels, positions, contacts, distinct_pairs=True),
                "user_left", "user_right") == [(1, 2), (1, 3)]


def test_latest_action_single_pass_equals_union(spark):
    events, _ = _inputs(spark, SF_SMALL)
    base = events.where("datetime is not null and lat is not null and lon is not null")
    parts = [
        base.where("event_type = 'reaction'").select(to_user_id("reaction_from").alias("user_id"), "*"),
        base.where("event_type = 'message'").select(to_user_id("message_from").alias("user_id"), "*"),
        base.where("event_type = 'subscription'").select(to_user_id("usr").alias("user_id"), "*"),
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2]).where("user_id is not null")
    union = union.select("user_id", parse_timestamp("datetime").alias("t"), "lat", "lon", "event_type")
    want = union.groupBy("user_id").agg(F.max(F.struct("t", "lat", "lon", "event_type")).alias("x")).select(
        "user_id", "x.*")
    got = latest_action(events)
    assert rows(got) == rows(want)


def test_contacts_and_pair_counts(spark):
    ev = spark.createDataFrame(
        [("message", 1, 2), ("message", 2, 1), ("message", 3, 3), ("message", 4, None)],
        "event_type string, message_from bigint, message_to bigint",
    )
    assert rows(contact_pairs(ev)) == [(1, 2), (3, 3)]
    channels = spark.createDataFrame(
        [(1, 10), (2, 10), (3, 10), (1, 11)], "user_id bigint, subscription_channel bigint"
    )
    assert rows(channel_pair_counts(channels)) == [(10, 3, 3), (11, 1, 0)]
    got = rows(pairs_without_contact_counts(channels, contact_pairs(ev)))
    assert got == [(10, 3, 1, 2), (11, 0, 0, 0)]


def test_user_ids_are_not_narrowed(spark):
    ev = spark.createDataFrame([("subscription", "3000000000", 1), ("subscription", "abc", 1)],
                               "event_type string, usr string, subscription_channel bigint")
    assert rows(user_channels(ev)) == [(3000000000, 1)]


def test_recommendations_properties(spark):
    events, cities = _inputs(spark, SF_SMALL)
    rec = pair_recommendations(events, cities, as_of="2024-05-01 12:00:00")
    assert rec.where("user_left >= user_right").count() == 0
    bad = rec.join(contact_pairs(events), ["user_left", "user_right"], "left_semi")
    assert bad.count() == 0
    r = rec.first()
    assert str(r.processed_dttm) == "2024-05-01"


def test_grid_join_with_one_hot_cell(spark):
    """A third of the users in one channel at one spot: same pairs as brute force."""
    rnd = random.Random(5)
    pos = [(i, -33.865 + rnd.uniform(-0.002, 0.002), 151.2094 + rnd.uniform(-0.002, 0.002)) for i in range(120)]
    pos += [(1000 + i, rnd.uniform(-40, -10), rnd.uniform(115, 150)) for i in range(240)]
    chans = [(u, 1) for u, _, _ in pos[:120]] + [(u, u % 3) for u, _, _ in pos[120:]]
    positions = spark.createDataFrame(pos, "user_id bigint, lat double, lon double")
    channels = spark.createDataFrame(chans, "user_id bigint, subscription_channel bigint")
    contacts = spark.createDataFrame([(0, 1)], "user_left bigint, user_right bigint")
    want = _brute_nearby(channels, positions, contacts, 1.0)
    for hot_rows in (2000, 25, 7):  # no salting, then 5 and 18 salts per side for the hot cell
        got = nearby_pairs(channels, positions, contacts, hot_rows=hot_rows).select("user_left", "user_right")
        assert got.count() == 120 * 119 // 2 - 1
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_salted_join_keeps_per_channel_multiplicity(spark):
    positions = spark.createDataFrame(
        [(u, 0.0, 0.0001 * u) for u in range(30)], "user_id bigint, lat double, lon double"
    )
    channels = spark.createDataFrame([(u, c) for u in range(30) for c in (1, 2)],
                                     "user_id bigint, subscription_channel bigint")
    contacts = spark.createDataFrame([(0, 1)], "user_left bigint, user_right bigint")
    plain = nearby_pairs(channels, positions, contacts, hot_rows=1000).select("user_left", "user_right")
    salted = nearby_pairs(channels, positions, contacts, hot_rows=4).select("user_left", "user_right")
    assert plain.count() == 2 * (30 * 29 // 2 - 1)
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_contact_counts_match_pair_enumeration(spark):
    rnd = random.Random(21)
    chans = [(u, c) for u in range(40) for c in range(12) if rnd.random() < (0.9 if u < 3 else 0.25)]
    contacts = sorted({(min(a, b), max(a, b)) for a, b in ((rnd.randrange(40), rnd.randrange(40)) for _ in range(150))})
    channels = spark.createDataFrame(chans, "user_id bigint, subscription_channel bigint")
    cdf = spark.createDataFrame(contacts, "user_left bigint, user_right bigint")
    got = {r.subscription_channel: tuple(r)[1:] for r in pairs_without_contact_counts(channels, cdf).collect()}
    members = {}
    for u, c in chans:
        members.setdefault(c, set()).add(u)
    cset = set(contacts)
    for c, us in members.items():
        pairs = [(a, b) for a in us for b in us if a < b]
        in_contact = sum(1 for p in pairs if p in cset)
        assert got[c] == (len(pairs), in_contact, len(pairs) - in_contact)


def test_zone_per_user_equals_zone_per_pair_row(spark):
    from cityweave.operators.nearest import nearest_city
    from cityweave.operators.social import zoned_nearby_pairs

    events, cities = _inputs(spark, SF_SMALL)
    near = nearby_pairs(user_channels(events), latest_action(events), contact_pairs(events))
    located = nearest_city(near.drop("distance_km"), cities, lat="user_left_lat", lon="user_left_lon")
    per_row = located.select("user_left", "user_right", F.col("city_id").alias("zone_id"))
    per_user = zoned_nearby_pairs(events, cities).select("user_left", "user_right", "zone_id")
    assert per_row.count() > 0
    assert per_row.exceptAll(per_user).count() == 0 and per_user.exceptAll(per_row).count() == 0


def test_unnamed_channels_form_no_pairs(spark):
    channels = spark.createDataFrame([(1, None), (2, None), (3, None), (1, 5), (2, 5)], "user_id bigint, subscription_channel bigint")
    contacts = spark.createDataFrame([(1, 2)], "user_left bigint, user_right bigint")
    assert rows(channel_pair_counts(channels)) == [(5, 2, 1), (None, 3, 0)]
    assert rows(pairs_without_contact_counts(channels, contacts)) == [(5, 1, 1, 0), (None, 0, 0, 0)]


def test_a_cool_cell_beside_a_hot_one_is_split(spark):
    """40 members next to 1000: the key where they meet is salted by both sizes."""
    from cityweave.operators.social import _split_hot_cells

    cell = "struct(0L as cx, 0L as cy, 0L as cz) as _cell"
    probe = spark.range(1040).selectExpr("1L as subscription_channel", cell, "id as _u1")
    build = spark.range(40).selectExpr("1L as subscription_channel", cell, "id as _u2")
    p, b, key = _split_hot_cells(probe, build, 50)
    n_p = {tuple(r)[:-1]: r["count"] for r in p.groupBy(*key).count().collect()}
    n_b = {tuple(r)[:-1]: r["count"] for r in b.groupBy(*key).count().collect()}
    assert max(n_p[k] * n_b.get(k, 0) for k in n_p) <= 2 * 50 * 50
    assert p.join(b, key).select("_u1", "_u2").distinct().count() == p.join(b, key).count() == 1040 * 40


def test_run_stamp(spark):
    """``as_of`` in any zone is one moment; without it the run's own date and time are used."""
    from cityweave.operators.social import stamped

    zoned = spark.createDataFrame([(1, 2, "3")], "user_left bigint, user_right bigint, zone_id string")
    a, b = (stamped(zoned, t, "UTC").first() for t in ("2024-05-01T12:00:00+10:00", "2024-05-01 02:00:00"))
    assert a == b and str(a.local_time) == "2024-05-01 02:00:00"
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    now = stamped(zoned, None, "UTC").first()
    assert before - dt.timedelta(minutes=1) <= now.local_time <= before + dt.timedelta(minutes=5)
    assert now.processed_dttm in (before.date(), now.local_time.date())


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_are_not_moved_to_meet_contacts(spark):
    """A hub in contact with everybody, and contacts far apart: taken off where the pairs are formed."""
    positions = spark.createDataFrame([(u, 0.0, 0.0001 * u if u < 40 else 5.0) for u in range(60)], "user_id bigint, lat double, lon double")
    channels = spark.createDataFrame([(u, c) for u in range(60) for c in (1, 2)], "user_id bigint, subscription_channel bigint")
    met = [(0, u) for u in range(1, 60)] + [(3, 7), (3, 7), (5, 5), (9, 8), (39, 40), (41, 45), (None, 4)]
    contacts = spark.createDataFrame(met, "user_left bigint, user_right bigint")
    want = _brute_nearby(channels, positions, contacts, 1.0)
    for hot_rows in (2000, 5):
        got = nearby_pairs(channels, positions, contacts, hot_rows=hot_rows)
        assert "LeftAnti" not in _plan(got)
        got = got.select("user_left", "user_right")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_contacts_are_listed_by_the_end_with_fewer(spark):
    positions = spark.createDataFrame([(u, 0.0, 0.0) for u in range(50)], "user_id bigint, lat double, lon double")
    contacts = spark.createDataFrame([(0, u) for u in range(1, 50)], "user_left bigint, user_right bigint")
    from cityweave.operators.social import _near_contacts

    assert sorted((r.user_id, r._known) for r in _near_contacts(contacts, positions, 1.0).collect()) == [(u, [0]) for u in range(1, 50)]


def test_copies_of_a_hot_cell_are_bounded(spark):
    from cityweave.operators import social

    members = spark.range(300).select(F.lit(1).alias("subscription_channel"), F.lit(0).alias("_cell"), F.col("id").alias("_u1"))
    probe, build, _ = social._split_hot_cells(members, members.withColumnRenamed("_u1", "_u2"), 1)
    assert probe.count() == build.count() == 300 * social.MAX_SALTS


def test_zones_are_searched_by_user_not_by_pair(spark):
    from cityweave.operators.social import zoned_nearby_pairs

    events, cities = _inputs(spark, SF_SMALL)
    assert "_places" not in _plan(zoned_nearby_pairs(events, cities))
