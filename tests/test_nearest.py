import math
import random

import pytest

from pyspark.sql import functions as F

from cityweave.operators import leaves, nearest
from cityweave.operators.nearest import nearest_city
from cityweave.sources.cities import read_cities
from tests.conftest import rows

CITIES = [
    ("1", "A", 0.0, 0.0),
    ("2", "B", 0.0, 2.0),
    ("3", "A2", 0.0, 0.0),  # same place as A: exact tie
    ("4", "C", 50.0, 50.0),
]


def _cities(spark):
    return spark.createDataFrame(CITIES, "city_id string, city_name string, city_lat double, city_lon double")


def test_per_row_keeps_ties(spark):
    pts = spark.createDataFrame([(1, 0.0, 0.1), (2, 0.0, 1.9), (3, 0.0, 1.0)], "pid int, lat double, lon double")
    out = nearest_city(pts, _cities(spark))
    got = rows(out, "pid", "city_id")
    # point 3 is equidistant from A/A2 (same place) and B
    assert got == [(1, "1"), (1, "3"), (2, "2"), (3, "1"), (3, "2"), (3, "3")]


def test_keyed_mode_groups_compete(spark):
    pts = spark.createDataFrame(
        [(1, None, 0.0, 0.1), (2, None, 0.0, 0.5), (3, 7, 0.0, 1.9), (4, 7, 0.0, 1.5)],
        "pid int, k int, lat double, lon double",
    )
    out = nearest_city(pts, _cities(spark), key=["k"])
    # the NULL key is one group: only pid 1 (closest) survives, with both tied cities
    assert rows(out, "pid", "city_id") == [(1, "1"), (1, "3"), (3, "2")]


def _brute(points, cities, keyed=False):
    """[(pid, city_id)] by a full search; ties within 1e-9 km."""
    least, found = {}, []
    for pid, k, lat, lon in points:
        ds = []
        for cid, _, clat, clon in cities:
            h = math.sin(math.radians(clat - lat) / 2) ** 2 + math.cos(math.radians(lat)) * math.cos(math.radians(clat)) * math.sin(math.radians(clon - lon) / 2) ** 2
            ds.append((2 * 6371.0 * math.asin(math.sqrt(min(1.0, h))), cid))
        best = min(ds)[0]
        key = k if keyed else pid
        least[key] = min(best, least.get(key, math.inf))
        found += [(pid, cid, key, d) for d, cid in ds if d <= best + 1e-9]
    return sorted((pid, cid) for pid, cid, key, d in found if d <= least[key] + 1e-9)


def _frames(spark, pts, cities):
    return (
        spark.createDataFrame(pts, "pid int, k int, lat double, lon double"),
        spark.createDataFrame(cities, "city_id string, city_name string, city_lat double, city_lon double"),
    )


@pytest.mark.parametrize("leaf, on_driver", [(4, 2000), (100, 2000), (16, 0)])
def test_leaves_equal_full_search(spark, monkeypatch, leaf, on_driver):
    monkeypatch.setattr(leaves, "DRIVER_PLACES", on_driver)
    monkeypatch.setattr(leaves, "TASK_PLACES", 20)
    rnd = random.Random(7)
    cities = [(str(i), f"c{i}", rnd.uniform(-85, 85), rnd.uniform(-180, 180)) for i in range(60)]
    cities.append(("dup", "c0-again", cities[0][2], cities[0][3]))
    pts = [(i, None, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(300)]
    pts += [(1000 + i, None, c[2] + rnd.uniform(-0.01, 0.01), c[3]) for i, c in enumerate(cities[:10])]
    pts += [(2000, None, 90.0, 0.0), (2001, None, -90.0, 45.0), (2002, None, 0.0, 180.0), (2003, None, cities[0][2], cities[0][3])]
    pts += [(2004, None, 10.0, 190.0), (2005, None, 10.0, -180.0), (2006, None, -0.0, 540.0), (2007, None, 100.0, 20.0), (2008, None, -271.0, 400.0)]
    pdf, cdf = _frames(spark, pts, cities)
    got = rows(nearest_city(pdf, cdf, leaf_places=leaf), "pid", "city_id")
    assert got == sorted(_brute(pts, cities), key=lambda t: tuple((x is None, str(x)) for x in t))
    assert [r for r in got if r[0] == 2003] == [(2003, "0"), (2003, "dup")]


def test_points_without_finite_coordinates_have_no_city(spark):
    pts = [(1, None, None, 1.0), (2, None, 1.0, None), (3, None, float("nan"), 1.0), (4, None, 1.0, float("inf"))]
    pdf, _ = _frames(spark, pts, [])
    assert nearest_city(pdf, _cities(spark)).count() == 0


def test_empty_dictionary_gives_no_rows(spark):
    pts = spark.createDataFrame([(1, 0.0, 0.0)], "pid int, lat double, lon double")
    empty = _cities(spark).where("false")
    assert nearest_city(pts, empty).count() == 0


def test_dictionary_rewritten_from_ten_to_thousands_of_rows(spark, tmp_path):
    rnd = random.Random(2)
    pts = [(i, None, rnd.uniform(-60, 60), rnd.uniform(-180, 180)) for i in range(40)]
    pdf, _ = _frames(spark, pts, [])
    path = tmp_path / "geo.csv"
    for n in (10, 3000):
        cities = [(str(i), f"c{i}", round(rnd.uniform(-60, 60), 4), round(rnd.uniform(-180, 180), 4)) for i in range(n)]
        lines = [f"{i};{name};{lat};{lon}".replace(".", ",") for i, name, lat, lon in cities]
        path.write_text("\n".join(["id;city;lat;lng", *lines]) + "\n")
        found = nearest_city(pdf, read_cities(spark, str(path)))
        assert rows(found, "pid", "city_id") == sorted(_brute(pts, cities), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("hot_rows", [2, 10**6])
def test_keyed_mode_does_not_depend_on_hot_rows(spark, hot_rows, monkeypatch):
    rnd = random.Random(13)
    monkeypatch.setattr(nearest, "MAX_HOT_KEYS", 10)
    cities = [(str(i), f"c{i}", rnd.uniform(-50, 50), rnd.uniform(-170, 170)) for i in range(20)]
    pts = [(i, rnd.choice([None, None, 1, 2, *range(3, 60)]), rnd.uniform(-60, 60), rnd.uniform(-180, 180)) for i in range(200)]
    pts += [(1000 + i, None, cities[0][2], cities[0][3]) for i in range(40)]  # ties of the NULL key
    pdf, cdf = _frames(spark, pts, cities)
    got = rows(nearest_city(pdf, cdf, key=["k"], hot_rows=hot_rows), "pid", "city_id")
    assert got == sorted(_brute(pts, cities, keyed=True), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_rows_of_a_hot_null_key_are_not_moved(spark):
    """20,000 rows of the NULL key at one place stay in the partitions they come from."""
    pts = spark.range(0, 40_000, 1, 8).select(
        F.col("id").cast("int").alias("pid"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"),
        F.when(F.col("id") % 2 == 1, 0.0).otherwise(F.col("id") / 1000).alias("lat"),
        F.lit(0.05).alias("lon"),
    )
    found = nearest_city(pts, _cities(spark), key=["k"], hot_rows=1000)
    # as with large facts: the points are too many to broadcast, and neither partitions nor files are merged
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "100k", "spark.sql.files.openCostInBytes": "128m"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        per_task = found.where("k is null").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in per_task) == 40_000  # two cities tied at each
    assert max(r["count"] for r in per_task) <= 40_000 // 8 + 2


def test_pairs_of_squares_and_places_stay_where_they_are(spark):
    """The least distances of the few squares are broadcast: the pairs, many times the dictionary, aren't joined by shuffle."""
    places = spark.createDataFrame([(0.0, 1.0, []), (5.0, 2.0, [])], "lat double, lon double, cities array<string>")
    first = leaves._opened(places, 2, None)
    for opened in (first, leaves._opened(places, 3, first)):
        assert "strategy=broadcast" in opened._jdf.queryExecution().optimizedPlan().toString()
    assert first.groupBy("_row", "_column").count().count() == 32
