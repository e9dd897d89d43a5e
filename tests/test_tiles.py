import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from cityweave.operators import leaves, tiles
from cityweave.operators.nearest import nearest_city
from tests.conftest import rows
from tests.test_nearest import _brute, _frames

CITY_COLUMNS = "city_id string, city_name string, city_lat double, city_lon double"


@pytest.fixture
def tiled(monkeypatch):
    """Every dictionary is searched in tiles, of few cities and few points."""
    monkeypatch.setattr(leaves, "DRIVER_PLACES", 0)
    monkeypatch.setattr(leaves, "TREE_CITIES", 0)
    monkeypatch.setattr(tiles, "TILE_CITIES", 10)
    monkeypatch.setattr(tiles, "TASK_POINTS", 40)
    monkeypatch.setattr(tiles, "BUCKET", 2)


def _sorted(found):
    return sorted(found, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_large_dictionary_is_written_once_and_searched_exactly(spark):
    """Before, the index listed each place of a large dictionary about fifty times."""
    n = leaves.TREE_CITIES + 500
    rnd = np.random.default_rng(3)
    lat, lon = np.round(rnd.uniform(-80, 80, n), 3), np.round(rnd.uniform(-180, 180, n), 3)
    cities = spark.createDataFrame([(str(i), f"c{i}", float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))], CITY_COLUMNS)
    index = leaves.place_index(cities)
    assert index.cities.count() == n
    pts = [(i, None, float(a), float(b)) for i, (a, b) in enumerate(zip(rnd.uniform(-85, 85, 200), rnd.uniform(-180, 180, 200)))]
    pdf, _ = _frames(spark, pts, [("0", "c", 0.0, 0.0)])
    want = _brute(pts, [(str(i), "", float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))])
    assert rows(nearest_city(pdf, index), "pid", "city_id") == _sorted(want)


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("spread", [(85, 180), (3, 4)])
def test_tiles_equal_full_search(spark, tiled, keyed, spread):
    rnd = random.Random(7)
    cities = [(str(i), f"c{i}", rnd.uniform(-spread[0], spread[0]), rnd.uniform(-spread[1], spread[1])) for i in range(150)]
    cities += [(f"dup{i}", "again", cities[i][2], cities[i][3]) for i in range(30)]
    pts = [(i, rnd.choice([None, 1, 2, *range(3, 90)]), rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(300)]
    pts += [(1000 + i, i, c[2], c[3] + rnd.choice([0.0, 0.01])) for i, c in enumerate(cities[:60])]
    pts += [(2000, 7, 90.0, 0.0), (2001, 7, -90.0, 45.0), (2002, 8, 0.0, 180.0), (2004, 8, 10.0, 190.0), (2006, 9, -0.0, 540.0), (2007, 9, 100.0, 20.0), (2008, 9, -271.0, 400.0)]
    pts += [(3000, None, None, 1.0), (3001, None, 1.0, float("nan")), (3002, None, float("inf"), 1.0)]
    pdf, cdf = _frames(spark, pts, cities)
    pdf = pdf.withColumn("seen", F.lit("2024-01-01 10:00:00").cast("timestamp")).withColumn("more", F.struct("pid", F.array("k").alias("ks")))
    found = nearest_city(pdf, cdf, key=["k"] if keyed else None)
    assert rows(found, "pid", "city_id") == _sorted(_brute([p for p in pts if p[0] < 3000], cities, keyed=keyed))
    assert found.where("more.pid = pid and more.ks[0] <=> k and seen = timestamp'2024-01-01 10:00:00'").count() == found.count()


def test_tie_between_cities_of_different_tiles(spark, tiled):
    cities = [(f"{a}{i}", "c", a * (1.0 + i), 0.0) for a in (-1, 1) for i in range(40)]
    pts = [(i, None, 0.0, 0.0) for i in range(100)] + [(200, None, 0.4, 0.0)]
    pdf, cdf = _frames(spark, pts, cities)
    got = rows(nearest_city(pdf, cdf), "pid", "city_id")
    assert got == _sorted([(i, c) for i in range(100) for c in ("-10", "10")] + [(200, "10")])


def test_repeated_points_keep_their_rows(spark, tiled):
    cities = [(str(i), "c", float(i), 0.0) for i in range(40)]
    pdf, cdf = _frames(spark, [(1, None, 3.5, 0.0)] * 150 + [(2, None, 20.2, 0.1)] * 3, cities)
    assert nearest_city(pdf, cdf).groupBy("pid", "city_id").count().where("count not in (150, 3)").count() == 0
    assert nearest_city(pdf.where("pid = 3"), cdf).count() == 0


def test_tree_finds_all_nearest_in_small_batches(monkeypatch):
    monkeypatch.setattr(tiles, "BATCH_POINTS", 50)
    monkeypatch.setattr(tiles, "BATCH_PAIRS", 200)
    rnd = np.random.default_rng(5)
    # on a lattice, so that there are ties, with repeated places and a point far from all
    lat, lon = rnd.integers(-20, 20, 400) / 10, rnd.integers(-20, 20, 400) / 10
    at = tiles.unit(np.append(rnd.uniform(-3, 3, 180), 80.0), np.append(rnd.uniform(-3, 3, 180), 170.0))
    tree = tiles.BoxTree.over(tiles.unit(lat, lon))
    chord = ((at[:, None, :] - tree.xyz[None, :, :]) ** 2).sum(axis=2)
    want = np.argwhere(chord <= chord.min(axis=1, keepdims=True) * tiles.MARGIN + tiles.SLACK)
    point, item, _ = tree.nearest(at)
    assert sorted(zip(point.tolist(), item.tolist())) == sorted(map(tuple, want.tolist()))
