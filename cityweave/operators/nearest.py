"""Nearest city of each point, ties kept: one exact plan for every dictionary size.

``place_index`` cuts the globe into leaves with short lists of possible nearest
places; every point takes the argmin over the list of its leaf.  No facts x
cities, and the index needs no pass over the facts.  Its size is measured: up
to a bound it is broadcast, and the search is map only.  Large dictionaries are
cut into tiles instead, where a task's points meet the tile's places (``tiles``);
points near a border visit several tiles and take the least of what these find.

Two semantics:

* ``key=None`` (per row): every point gets the cities at its least distance.
* ``key=[...]`` (reference semantics): among all rows sharing ``key``, only the
  (row, city) combinations at the smallest distance survive.  A NULL or
  repeated key competes as one group.  The search runs once and its result is
  written; keys are counted and their least distances found there, in one
  partial aggregation.  Keys with a large share of the rows (at most
  ``MAX_HOT_KEYS`` of them, whatever the input's size) are broadcast with their
  least distance, so their rows stay where they are, ties included.  All other
  keys take a rank-1 window, whose group limit drops most rows before they move.

Rows without coordinates, or with non-finite ones, have no nearest city.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityweave.functions.geo import haversine_km
from cityweave.operators.leaves import PlaceIndex, place_index, with_places
from cityweave.operators.tiles import MARGIN, SLACK, TileIndex, with_close_places
from cityweave.session import scratch_table

# A key is hot above this many rows and above one in MAX_HOT_KEYS of all rows:
# there can't be more hot keys than that, so their table may be broadcast.
HOT_KEY_ROWS = 100_000
MAX_HOT_KEYS = 10_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nearest_by_place(points: DataFrame, index: PlaceIndex | TileIndex, lat="lat", lon="lon", distance_col: str = "distance_km") -> DataFrame:
    """Per-row argmin over the list of the row's leaf or tiles; one output row per tied city.

    Squared chords (no trigonometry per place) pick the places that may be
    nearest, with a margin far above their rounding; the distance of those few
    is the haversine's, and so are ties.  A search in tiles runs at once.
    """
    lat_c, lon_c = _c(lat), _c(lon)
    tiled = isinstance(index, TileIndex)
    listed = with_close_places(points, index, lat_c, lon_c) if tiled else _close_of_leaf(points, index, lat_c, lon_c)
    distances = F.transform("_places", lambda p: haversine_km(lat_c, lon_c, p["lat"], p["lon"]))
    winners = F.filter("_places", lambda p, i: F.get(F.col("_ds"), i) == F.col("_best"))
    best = listed.withColumn("_ds", distances).withColumn("_best", F.array_min("_ds"))
    if tiled:
        of_row = Window.partitionBy("_row").orderBy("_best")
        several = best.where("_copies > 1").withColumn("_rank", F.rank().over(of_row)).where("_rank = 1").drop("_rank")
        best = best.where("_copies = 1").unionByName(several)
    return best.withColumn("_hit", F.explode(F.flatten(F.transform(winners, lambda p: p["cities"])))).select(
        *[F.col(c) for c in points.columns],
        F.col("_hit.city_id").alias("city_id"),
        F.col("_hit.city_name").alias("city_name"),
        F.col("_best").alias(distance_col),
    )


def _close_of_leaf(points: DataFrame, index: PlaceIndex, lat: Column, lon: Column) -> DataFrame:
    """``points`` with ``_places``: those of the leaf within the margin of its nearest."""
    phi, lam = F.radians(lat), F.radians(lon)
    own = {"_x": F.cos(phi) * F.cos(lam), "_y": F.cos(phi) * F.sin(lam), "_z": F.sin(phi)}
    square = lambda p, axis: (p[axis] - F.col(f"_{axis}")) * (p[axis] - F.col(f"_{axis}"))
    chords = F.transform("_places", lambda p: square(p, "x") + square(p, "y") + square(p, "z"))
    # named twice, so that Spark does not put the minimum itself into the lambda, once a place
    close = F.filter("_places", lambda p, i: (F.get(F.col("_chords"), i) <= F.col("_upto")) | F.col("_upto").isNull())
    return (
        with_places(points.withColumns(own), index, lat, lon)
        .withColumn("_chords", chords)
        .withColumn("_upto", F.array_min("_chords") * MARGIN + F.lit(SLACK))
        .withColumn("_places", close)
    )


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return functools.reduce(operator.and_, (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)))


def closest_per_key(scored: DataFrame, key: Sequence[str], distance_col: str, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Rows of ``scored`` (a table) at the smallest distance of their key; NULLs are one key."""
    key, own = list(key), [f"_hot{i}" for i in range(len(key))]
    per_key = scored.groupBy(*[F.col(k).alias(o) for k, o in zip(key, own, strict=True)]).agg(F.count(F.lit(1)).alias("_n"), F.min(distance_col).alias("_least"))
    share = (scored.select(F.count(F.lit(1)).alias("_n")).scalar() / F.lit(MAX_HOT_KEYS)).alias("_share")
    hot = per_key.where(F.col("_n") > F.lit(hot_rows)).withColumn("_share", share).where("_n > _share")
    hot = F.broadcast(hot.select(*own, "_least"))  # at most MAX_HOT_KEYS rows
    at_rest = scored.join(hot, _same(key, own) & (F.col(distance_col) == F.col("_least"))).select(*scored.columns)
    w = Window.partitionBy(*key).orderBy(F.col(distance_col).asc())
    others = scored.join(hot, _same(key, own), "left_anti")
    ranked = others.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") == 1).drop("_rank")
    return ranked.unionByName(at_rest)


def nearest_city(
    points: DataFrame,
    cities: DataFrame | PlaceIndex | TileIndex,
    lat="lat",
    lon="lon",
    key: Sequence[str] | None = None,
    distance_col: str = "distance_km",
    leaf_places: int | None = None,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Attach ``city_id, city_name, distance_km`` of the nearest city(ies).

    ``cities`` is the dictionary, which is read at once, or its index.
    ``leaf_places`` bounds the lists of the index and ``hot_rows`` tells the
    keys whose rows are not moved; the result depends on neither.  With ``key``
    the search itself runs at once, into a table of the shared folder.
    """
    index = cities if isinstance(cities, (PlaceIndex, TileIndex)) else place_index(cities, leaf_places)
    scored = nearest_by_place(points, index, lat, lon, distance_col)
    if key is None:
        return scored
    return closest_per_key(scratch_table(points.sparkSession, "scored", scored), key, distance_col, hot_rows)
