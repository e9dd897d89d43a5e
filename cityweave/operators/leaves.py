"""A density-adaptive tree of squares over a city dictionary.

Every place on the globe lies in one leaf; a leaf lists the places (distinct
city positions) that can be nearest to any point in it.  A square's list
follows from its centre m and the largest distance rho of its points from m:
if the place nearest to m is at d, the places nearest to a point of the square
lie within d + 2 rho of m: the search runs outward from m and stops there.  A
square with more than ``leaf_places`` of them is cut into four, whose lists are
taken from its own; so leaves are small where places are dense and large where
there are few, and the work grows with the dictionary, not with its square.

Small dictionaries are cut on the driver (at most ``DRIVER_PLACES`` places), and
dictionaries of more than ``TREE_CITIES`` rows aren't listed by leaves but searched
in tiles (``tiles``), as their lists would be many times the dictionary.  Those
between are cut by Spark, level by level, where a square's list exceeds
``TASK_PLACES``, and then square by square in tasks; the levels cut by Spark
have few squares, so their least distances are partial minima that are
broadcast, and no window or task holds the dictionary.  Cities at one position are one place with a list of
cities.  Squares of the last level (about 10 m) may list more places.
"""

from __future__ import annotations

import dataclasses
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityweave.functions.geo import EARTH_RADIUS_KM, haversine_km
from cityweave.operators.tiles import TileIndex, tile_index, unit as _unit
from cityweave.session import scratch_table

LEAF_PLACES, LEAF_PLACES_MANY = 8, 16  # of small dictionaries, and of those that are cut by Spark
LAST_LEVEL = 21  # level l has 2^l rows and 2^(l+1) columns of squares
TOP_LEVEL = 2  # 32 squares, where a large dictionary's cutting begins
DRIVER_PLACES = 2000
TASK_PLACES = 50_000
TREE_CITIES = 6_000
# Leaves are broadcast with their lists up to this many bytes, and their keys alone up to so many leaves.
INDEX_BYTES = 32 << 20
MAX_KEYS = 2_000_000
SLACK_KM = 1e-6  # guards the bounds against rounding

_ROW, _LEVEL = 28, 56  # a square's key: level, row and column in one long
_CITIES = "array<struct<city_id:string,city_name:string>>"
_PLACES = f"array<struct<lat:double,lon:double,x:double,y:double,z:double,cities:{_CITIES}>>"


@dataclasses.dataclass(frozen=True)
class PlaceIndex:
    """``leaves(_leaf, _places)``, the levels that have leaves, and what of them may be broadcast."""

    leaves: DataFrame
    levels: tuple[int, ...]
    whole: bool
    keys: bool


def _reach(level, row, xp):
    """2 rho of the squares in ``row``: chord bound over the half sides, at the latitude where the parallel is longest."""
    half = np.pi / 2.0 ** (level + 1)
    middle = xp.abs((row + 0.5) * 2 * half - np.pi / 2)
    widest = xp.cos(middle) * xp.cos(xp.maximum(middle - half, 0.0))
    h = np.sin(half / 2) ** 2 + widest * np.sin(half / 2) ** 2
    return 4 * EARTH_RADIUS_KM * xp.arcsin(xp.sqrt(xp.minimum(h, 1.0))) + SLACK_KM


def cut(level: int, row: np.ndarray, column: np.ndarray, lat: np.ndarray, lon: np.ndarray, leaf_places: int, last: int = LAST_LEVEL) -> list[tuple]:
    """Leaves ``(keys, counts, places)`` below the squares ``(row, column)`` of ``level``, each of which may list every place.

    Works on all (square, place) pairs of a level at once.
    """
    square = np.repeat(np.arange(len(row)), len(lat))
    place = np.tile(np.arange(len(lat)), len(row))
    at, out = _unit(lat, lon), []
    while len(square):
        side = 180.0 / 2**level
        centre = _unit((row + 0.5) * side - 90, (column + 0.5) * side - 180)
        chord = np.zeros(len(square))
        for axis in range(3):
            chord += (centre[square, axis] - at[place, axis]) ** 2
        first = np.flatnonzero(np.diff(square, prepend=-1))
        nearest = 2 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(np.minimum.reduceat(chord, first) / 4, 1.0)))
        upto = np.minimum((nearest + _reach(level, row[square[first]], np)) / EARTH_RADIUS_KM, np.pi)
        limit = 4 * np.sin(upto / 2) ** 2 + 1e-15
        near = chord <= np.repeat(limit, np.diff(first, append=len(square)))
        square, place = square[near], place[near]
        count = np.bincount(square, minlength=len(row))
        done = (count > 0) & ((count <= leaf_places) | (level >= last))
        out.append(((level << _LEVEL) | (row[done] << _ROW) | column[done], count[done], place[done[square]]))
        rest = ~done[square]
        # four squares for each that is left, in the order of squares
        left = np.flatnonzero(~done & (count > 0))
        new = np.zeros(len(row), np.int64)
        new[left] = np.arange(len(left))
        parent, place = new[square[rest]], place[rest]
        square = (parent[:, None] * 4 + np.arange(4)).ravel()
        place = np.repeat(place, 4)
        order = np.argsort(square, kind="stable")
        square, place = square[order], place[order]
        row = np.repeat(row[left] * 2, 4) + np.tile([0, 0, 1, 1], len(left))
        column = np.repeat(column[left] * 2, 4) + np.tile([0, 1, 0, 1], len(left))
        level += 1
    return [np.concatenate([part[i] for part in out]) if out else np.empty(0, np.int64) for i in range(3)]


def _listed(places: pa.Table, leaves: list[np.ndarray]) -> pa.Table:
    """``_leaf, _places`` of ``cut``'s leaves over ``places(lat, lon, cities)``."""
    keys, counts, at = leaves
    places = places.combine_chunks()
    lat, lon = (places[c].to_numpy() for c in ("lat", "lon"))
    xyz = _unit(lat, lon)
    cities = places["cities"].combine_chunks()
    columns = [pa.array(lat), pa.array(lon), *(pa.array(xyz[:, i].copy()) for i in range(3)), cities if isinstance(cities, pa.Array) else cities.chunk(0)]
    each = pa.StructArray.from_arrays(columns, ["lat", "lon", "x", "y", "z", "cities"]).take(pa.array(at))
    return pa.table({"_leaf": pa.array(keys, pa.int64()), "_places": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), each)})


def _city_rows(cities: DataFrame) -> DataFrame:
    ok = (F.abs("city_lat") < float("inf")) & (F.abs("city_lon") < float("inf"))
    city = F.struct(F.col("city_id").cast("string").alias("city_id"), "city_name").alias("city")
    return cities.where(ok).select((F.col("city_lat") + 0.0).alias("lat"), (F.col("city_lon") + 0.0).alias("lon"), city)


def _opened(places: DataFrame, level: int, parents: DataFrame | None) -> DataFrame:
    """``_row, _column, lat, lon, cities``: places that can be nearest to a point of a square of ``level``."""
    side = 180.0 / 2**level
    if parents is None:
        squares = F.explode(F.sequence(F.lit(0), F.lit(2 ** (2 * level + 1) - 1)))
        pairs = places.select("*", squares.alias("_n")).select((F.col("_n") / 2 ** (level + 1)).cast("long").alias("_row"), (F.col("_n") % 2 ** (level + 1)).alias("_column"), "lat", "lon", "cities")
    else:
        pairs = parents.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(3)))).select(
            (F.col("_row") * 2 + F.floor(F.col("_k") / 2)).alias("_row"), (F.col("_column") * 2 + F.col("_k") % 2).alias("_column"), "lat", "lon", "cities")
    pairs = pairs.select(F.col("_row").cast("long").alias("_row"), F.col("_column").cast("long").alias("_column"), "lat", "lon", "cities")
    pairs = pairs.withColumn("_d", haversine_km((F.col("_row") + 0.5) * side - 90, (F.col("_column") + 0.5) * side - 180, "lat", "lon"))
    least = pairs.groupBy("_row", "_column").agg(F.min("_d").alias("_least"))
    reach = _reach(level, F.col("_row"), _Spark)
    # few squares: each comes from one of more than TASK_PLACES places.  The pairs stay where they are.
    return pairs.join(F.broadcast(least), ["_row", "_column"]).where(F.col("_d") <= F.col("_least") + reach).select("_row", "_column", "lat", "lon", "cities")


class _Spark:
    """The numpy functions of ``_reach`` as columns."""

    abs, cos, sqrt, arcsin = (staticmethod(f) for f in (F.abs, F.cos, F.sqrt, F.asin))
    maximum = staticmethod(lambda a, b: F.greatest(a, F.lit(b)))
    minimum = staticmethod(lambda a, b: F.least(a, F.lit(b)))


def place_index(cities: DataFrame, leaf_places: int | None = None) -> PlaceIndex | TileIndex:
    """The tree of ``cities(city_id, city_name, city_lat, city_lon)``; reads the dictionary.

    May be passed to ``nearest_city`` in place of the dictionary, to use it again.
    """
    if leaf_places is not None and leaf_places < 2:  # a square on the line between two places always lists both
        raise ValueError(f"leaf_places must be at least 2, got {leaf_places}")
    spark = cities.sparkSession
    rows = _city_rows(cities)
    few = rows.limit(DRIVER_PLACES + 1).toArrow()
    if few.num_rows <= DRIVER_PLACES:
        return _cut_here(spark, few, leaf_places or LEAF_PLACES)
    if (n := rows.count()) > TREE_CITIES:
        return tile_index(rows, n)
    places = scratch_table(spark, "places", rows.groupBy("lat", "lon").agg(F.array_sort(F.collect_list("city")).alias("cities")))
    level, square, parents, ready = TOP_LEVEL, ["_row", "_column"], None, []
    while True:
        opened = scratch_table(spark, "squares", _opened(places, level, parents))
        crowded = scratch_table(spark, "crowded", opened.groupBy(*square).count().where(F.col("count") > TASK_PLACES).select(*square))
        listed = opened.withColumn("_level", F.lit(level))
        if level == LAST_LEVEL or crowded.isEmpty():
            ready.append(listed)
            break
        # only crowded squares are cut further, however deep the densest goes
        ready.append(listed.join(F.broadcast(crowded), square, "left_anti"))
        parents = opened.join(F.broadcast(crowded), square, "left_semi")
        level += 1

    def finish(table: pa.Table) -> pa.Table:
        row, column = (np.array([table[c][0].as_py()]) for c in square)
        return _listed(table, cut(table["_level"][0].as_py(), row, column, table["lat"].to_numpy(), table["lon"].to_numpy(), leaf_places or LEAF_PLACES_MANY))

    by_square = functools.reduce(DataFrame.unionByName, ready).groupBy("_level", *square)
    leaves = scratch_table(spark, "leaves", by_square.applyInArrow(finish, f"_leaf long, _places {_PLACES}"))
    # a place takes about 120 bytes in a list
    count, listed, levels = leaves.agg(F.count(F.lit(1)), F.sum(F.size("_places")), F.array_sort(F.collect_set(F.shiftright("_leaf", _LEVEL)))).first()
    return PlaceIndex(leaves, tuple(range(min(levels), max(levels) + 1)), 120 * listed <= INDEX_BYTES, count <= MAX_KEYS)


def _cut_here(spark: SparkSession, few: pa.Table, leaf_places: int) -> PlaceIndex:
    by_place: dict[tuple, list] = {}
    for r in few.to_pylist():
        by_place.setdefault((r["lat"], r["lon"]), []).append(r["city"])
    held = [{"lat": lat, "lon": lon, "cities": cities} for (lat, lon), cities in by_place.items()]
    city = pa.list_(pa.struct([("city_id", pa.string()), ("city_name", pa.string())]))
    table = pa.Table.from_pylist(held, pa.schema([("lat", pa.float64()), ("lon", pa.float64()), ("cities", city)]))
    leaves = cut(0, np.array([0, 0]), np.array([0, 1]), table["lat"].to_numpy(), table["lon"].to_numpy(), leaf_places)
    levels = (leaves[0] >> _LEVEL).tolist() or [0]
    frame = spark.createDataFrame(_listed(table, leaves).to_pylist(), f"_leaf long, _places {_PLACES}")
    return PlaceIndex(frame, tuple(range(min(levels), max(levels) + 1)), True, True)


def _turn(degrees: Column) -> Column:
    return F.pmod(degrees + 180.0, F.lit(360.0)) - 180.0


def _on_globe(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Latitude in [-90, 90] and longitude in [-180, 180) of any finite angles."""
    plain = F.abs(lat) <= 90.0
    turned = _turn(lat)
    over = F.abs(turned) > 90.0
    folded = F.when(over, F.signum(turned) * 180.0 - turned).otherwise(turned)
    return F.when(plain, lat).otherwise(folded), F.when(plain, _turn(lon)).otherwise(_turn(lon + F.when(over, 180.0).otherwise(0.0)))


def with_places(points: DataFrame, index: PlaceIndex, lat: Column, lon: Column) -> DataFrame:
    """``points`` on the globe with ``_places``, the list of their leaf."""
    finite = (F.abs(lat) < float("inf")) & (F.abs(lon) < float("inf"))
    phi, lam = _on_globe(lat, lon)
    deepest = index.levels[-1]
    row = F.least(F.floor((phi + 90.0) * (2**deepest / 180.0)), F.lit(2**deepest - 1))
    column = F.least(F.floor((lam + 180.0) * (2**deepest / 180.0)), F.lit(2 ** (deepest + 1) - 1))
    keys = [F.lit(n << _LEVEL) + F.shiftright("_r", deepest - n) * F.lit(1 << _ROW) + F.shiftright("_c", deepest - n) for n in index.levels]
    located = points.where(finite).withColumns({"_r": row.cast("long"), "_c": column.cast("long")})
    key = keys[0] if len(keys) == 1 else F.explode(F.array(*keys))
    located = located.withColumn("_leaf", key).drop("_r", "_c")
    if index.whole:
        return located.join(F.broadcast(index.leaves), "_leaf").drop("_leaf")
    if len(keys) > 1:
        names = index.leaves.select("_leaf")
        located = located.join(F.broadcast(names) if index.keys else names, "_leaf", "left_semi")
    return located.join(index.leaves, "_leaf").drop("_leaf")
