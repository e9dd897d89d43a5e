"""What each pair of members costs: same rows with less work."""

import math
import random
import re

import pytest

from pyspark.sql import functions as F

from cityweave.functions.geo import EARTH_RADIUS_KM, cos_lat, haversine_km, unit_vector, within_km
from cityweave.operators import social
from cityweave.plans.catalog import _km
from tests.test_social import _brute_nearby


def test_pairs_are_tested_without_trigonometry_of_latitudes(spark):
    """Cosines and vectors are found once a user: before, the join's condition had two cosines a pair."""
    positions = spark.createDataFrame([(1, 0.0, 0.0)], "user_id bigint, lat double, lon double")
    channels = spark.createDataFrame([(1, 1)], "user_id bigint, subscription_channel bigint")
    contacts = spark.createDataFrame([(1, 2)], "user_left bigint, user_right bigint")
    plan = social.nearby_pairs(channels, positions, contacts)._jdf.queryExecution().optimizedPlan().toString()
    pair_join = next(line for line in plan.splitlines() if "Join Inner" in line and "_u1" in line)
    assert "COS(" not in pair_join and re.search(r"_x1.*_x2", pair_join)
    above = plan.split(pair_join)[0]
    assert "COS(" not in above


@pytest.mark.parametrize("max_km", [1.0, 1e-6, 300.0, 19_000.0, 30_000.0])
def test_within_km_is_the_distance_test(spark, max_km):
    rnd = random.Random(4)
    degrees = math.degrees(max_km / EARTH_RADIUS_KM)
    points = []
    for lat, lon in [(0.0, 0.0), (89.99999, 10.0), (-90.0, 5.0), (10.0, 179.99999), (51.5, -0.1), (100.0, 20.0), (3.0, 725.0), (1e7, 1e9)]:
        for _ in range(150):
            turn, far = rnd.uniform(0, 2 * math.pi), degrees * rnd.choice([0.0, 0.5, 1 - 1e-7, 1.0, 1 + 1e-7, 1 + 1e-12, 2.0])
            points.append((lat, lon, lat + far * math.cos(turn), lon + far * math.sin(turn)))
            points.append((lat, lon, lat + far * rnd.choice([-1, 1]), lon))
    points += [(0.0, 180.0, 0.0, -180.0), (None, 0.0, 0.0, 0.0), (float("nan"), 0.0, 0.0, 0.0), (float("inf"), 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    df = df.withColumns({f"{n}{i}": v for i, (lat, lon) in ((1, "ab"), (2, "cd")) for n, v in zip("xyz", unit_vector(lat, lon), strict=True)})
    df = df.withColumns({"cos1": cos_lat("a"), "cos2": cos_lat("c"), "km": haversine_km("a", "b", "c", "d")})
    quick = haversine_km("a", "b", "c", "d", "cos1", "cos2")
    assert df.where(~quick.eqNullSafe(F.col("km"))).count() == 0
    near = F.coalesce(within_km(["x1", "y1", "z1"], ["x2", "y2", "z2"], quick, max_km), F.lit(False))
    want = F.coalesce(F.col("km") < max_km, F.lit(False))
    assert df.where(near != want).select("a", "b", "c", "d", "km").collect() == []
    assert df.where(want).count() > 0


def test_pairs_of_a_hot_cell_are_met_from_one_side(spark):
    """Before, every own probe was copied to all blocks, and half of the pairs that met were left out."""
    cell = "struct(0L as cx, 0L as cy, 0L as cz) as _cell"
    probe = spark.range(320).selectExpr("1L as subscription_channel", cell, "true as _own", "id as _u1")
    more = spark.range(1000, 1050).selectExpr("1L as subscription_channel", cell, "false as _own", "id as _u1")
    build = spark.range(320).selectExpr("1L as subscription_channel", cell, "id as _u2")
    for probes, foreign in ((probe, 0), (probe.unionAll(more), 50)):
        p, b, key = social._split_hot_cells(probes, build, 20)
        met = p.join(b, key).where("if(_ordered, _u1 < _u2, _u1 != _u2)")
        pairs = met.select(F.least("_u1", "_u2").alias("l"), F.greatest("_u1", "_u2").alias("g"))
        assert met.count() == pairs.distinct().count() == 320 * 319 // 2 + foreign * 320
        own = p.where("_own").count() / 320
        assert own <= 0.65 * social.MAX_SALTS
        assert p.join(b, key).where("_own").count() <= 0.6 * 320 * 320


def test_hot_cells_with_neighbours_give_the_same_pairs(spark):
    """Cells of unequal sizes side by side, so that salts of both sides agree in some and differ in others."""
    rnd = random.Random(9)
    pos = [(u, rnd.gauss(0, 0.01), rnd.gauss(0, 0.004)) for u in range(500)]
    positions = spark.createDataFrame(pos, "user_id bigint, lat double, lon double")
    channels = spark.createDataFrame([(u, c) for u in range(500) for c in (1, 2) if rnd.random() < 0.8] + [(1, None), (2, None)], "user_id bigint, subscription_channel bigint")
    contacts = spark.createDataFrame([(u, u + 1) for u in range(0, 400, 3)], "user_left bigint, user_right bigint")
    want = _brute_nearby(channels, positions, contacts, 1.0).cache()
    for hot_rows in (2000, 40, 12, 3):
        got = social.nearby_pairs(channels, positions, contacts, hot_rows=hot_rows).select("user_left", "user_right")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, hot_rows


def test_rounding_of_distances_is_rounds(spark):
    rnd = random.Random(2)
    values = [rnd.uniform(0, 2) for _ in range(4000)] + [rnd.uniform(0, 20_020) for _ in range(4000)]
    values += [i / 20_000 for i in range(4000)] + [math.nextafter(i / 20_000, s) for i in range(1, 4000, 7) for s in (0, 1e9)]
    values += [0.0, -0.0, -0.00005, -1.23456, 1e6, 123456.78905, 1e15, 1e300, float("inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "distance_km double")
    both = df.select("distance_km", _km().alias("ours"), F.round("distance_km", 4).alias("want"))
    assert both.where("not (ours <=> want)").collect() == []
