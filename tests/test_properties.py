"""Property tests (hypothesis): grid pairs = brute force; distance is a metric-like function."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cityweave.functions.geo import haversine_km
from cityweave.operators.social import nearby_pairs
from tests.test_social import _brute_nearby

centre = st.tuples(st.floats(-90, 90), st.floats(-180, 180))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    centres=st.lists(centre, min_size=1, max_size=3),
    spread=st.floats(0.0005, 0.03),
    max_km=st.sampled_from([0.5, 1.0, 2.0]),
    cell=st.sampled_from([None, 3.0]),
    seed=st.integers(0, 10_000),
)
def test_grid_pairs_equal_brute_force(spark, centres, spread, max_km, cell, seed):
    import random

    rnd = random.Random(seed)
    pos, chans = [], []
    for lat0, lon0 in centres:
        for _ in range(12):
            lat = max(-90.0, min(90.0, lat0 + rnd.uniform(-spread, spread)))
            lon = (lon0 + rnd.uniform(-spread, spread) + 180) % 360 - 180
            uid = len(pos)
            pos.append((uid, lat, lon))
            chans += [(uid, c) for c in range(2) if rnd.random() < 0.7]
    positions = spark.createDataFrame(pos, "user_id bigint, lat double, lon double")
    channels = spark.createDataFrame(chans or [(0, 0)], "user_id bigint, subscription_channel bigint")
    contacts = spark.createDataFrame([(0, 1)], "user_left bigint, user_right bigint")
    got = nearby_pairs(channels, positions, contacts, max_km=max_km, cell_km=cell).select("user_left", "user_right")
    want = _brute_nearby(channels, positions, contacts, max_km)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(centre, centre), min_size=1, max_size=20))
def test_distance_symmetric_nonnegative_bounded(spark, pairs):
    rows = [(a[0], a[1], b[0], b[1]) for a, b in pairs]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    out = df.select(
        haversine_km("a", "b", "c", "d").alias("ab"), haversine_km("c", "d", "a", "b").alias("ba")
    ).collect()
    for r in out:
        assert r.ab == r.ba
        assert 0.0 <= r.ab <= 20015.09
