"""Nearest places of points where the dictionary itself is a large table.

The unit sphere's space is cut into tiles by the planes of a balanced tree over
a sample of the cities (``SAMPLE_CITIES`` at most, drawn only to place the cuts
and for bounds; every city is in a tile).  A point's distance to the nearest
sampled city bounds that to its nearest city, so the point visits the tiles whose
box of cities lies within that bound: nearly always one, a few near a border.  A
tile's points and cities meet in a task, which searches a tree over the tile's
places; tiles of many points are dealt to several tasks (``TASK_POINTS``).  Each
city and each point moves once, but for the points near a border, and nothing is
written for places that no point asks for.  A tile has about ``TILE_CITIES``
cities up to ``2 ** MAX_DEPTH`` tiles, and grows with the dictionary beyond that.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cityweave.session import scratch_table

TILE_CITIES = 30_000
MAX_DEPTH = 14
SAMPLE_CITIES = 100_000
TASK_POINTS = 100_000
BUCKET = 8  # items of a tree's leaf
BATCH_POINTS, BATCH_PAIRS = 10_000, 4_000_000  # looked up at once

MARGIN, SLACK = 1.000001, 1e-17  # of squared chords, far above their rounding

_CITIES = "array<struct<city_id:string,city_name:string>>"
_CLOSE = f"array<struct<lat:double,lon:double,cities:{_CITIES}>>"


def unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Positions on the unit sphere; a chord between two of them is 2 sin(arc / 2)."""
    phi, lam = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(phi) * np.cos(lam), np.cos(phi) * np.sin(lam), np.sin(phi)], axis=1)


def _spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``first[i] ... first[i] + count[i] - 1``, one span after another."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


@dataclasses.dataclass
class BoxTree:
    """Halvings of a set of positions; level l has 2^l nodes, each with the box of its positions."""

    xyz: np.ndarray  # in the order of the leaves
    order: np.ndarray  # their numbers in the set
    low: list[np.ndarray]
    high: list[np.ndarray]
    axis: list[np.ndarray]  # by which a level's nodes are cut, and where
    at: list[np.ndarray]

    @staticmethod
    def over(xyz: np.ndarray, depth: int | None = None) -> BoxTree:
        n = len(xyz)
        deepest = max(0, (n // BUCKET).bit_length() - 1)
        depth = deepest if depth is None else min(depth, deepest)
        order, tree = np.arange(n), BoxTree(xyz, np.arange(n), [], [], [], [])
        for level in range(depth + 1):
            starts = np.arange(2**level) * n >> level
            here = xyz[order]
            tree.low.append(np.minimum.reduceat(here, starts))
            tree.high.append(np.maximum.reduceat(here, starts))
            if level == depth:
                break
            axis = np.argmax(tree.high[level] - tree.low[level], axis=1)
            node = np.repeat(np.arange(2**level), np.diff(starts, append=n))
            key = here[np.arange(n), axis[node]]
            sort = np.lexsort((key, node))
            order, key = order[sort], key[sort]
            tree.axis.append(axis)
            tree.at.append(key[(np.arange(2**level) * 2 + 1) * n >> level + 1])
        tree.xyz, tree.order = xyz[order], order
        return tree

    @property
    def depth(self) -> int:
        return len(self.axis)

    def node_of(self, points: np.ndarray, depth: int) -> np.ndarray:
        """The node of level ``depth`` on whose side of the cuts each point lies."""
        node, row = np.zeros(len(points), np.int64), np.arange(len(points))
        for level in range(depth):
            node = node * 2 + (points[row, self.axis[level][node]] >= self.at[level][node])
        return node

    def items(self, point: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, place in ``xyz``) for each position of the leaves."""
        n = len(self.xyz)
        first = leaf * n >> self.depth
        count = ((leaf + 1) * n >> self.depth) - first
        return np.repeat(point, count), _spans(first, count)

    def chords(self, points: np.ndarray, point: np.ndarray, item: np.ndarray) -> np.ndarray:
        out = np.zeros(len(point))
        for axis in range(3):
            out += (points[point, axis] - self.xyz[item, axis]) ** 2
        return out

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point, place in ``xyz``, squared chord) of all positions within the margin of each point's nearest."""
        point, item = self.items(np.arange(len(points)), self.node_of(points, self.depth))
        upto = _least(self.chords(points, point, item), point)
        out = []
        for some, point, leaf in near_nodes(self.low, self.high, points, upto):
            point, item = self.items(point, leaf)
            chord = self.chords(points[some], point, item)
            close = chord <= (_least(chord, point) * MARGIN + SLACK)[point]
            out.append((point[close] + some.start, item[close], chord[close]))
        return tuple(np.concatenate(part) for part in zip(*out, strict=True))


def _least(value: np.ndarray, point: np.ndarray) -> np.ndarray:
    """The least value of each point; ``point`` rises and has every number."""
    return np.minimum.reduceat(value, np.flatnonzero(np.diff(point, prepend=-1)))


def near_nodes(low: list[np.ndarray], high: list[np.ndarray], points: np.ndarray, upto: np.ndarray):
    """Yields ``(slice of points, point in it, node)``: nodes of the last level that may hold a position within
    ``upto``, a squared chord, and within what nearer boxes allow."""
    slices = [slice(i, min(i + BATCH_POINTS, len(points))) for i in reversed(range(0, len(points), BATCH_POINTS))]
    while slices:
        some = slices.pop()
        at, bound = points[some], upto[some].copy()
        point, node = np.arange(len(at)), np.zeros(len(at), np.int64)
        for level in range(len(low)):
            if level:
                point, node = np.repeat(point, 2), (np.repeat(node * 2, 2).reshape(-1, 2) + [0, 1]).ravel()
            if len(point) > BATCH_PAIRS and len(at) > 1:
                middle = some.start + len(at) // 2
                slices += [slice(middle, some.stop), slice(some.start, middle)]
                break
            inner, outer = np.zeros(len(point)), np.zeros(len(point))
            for axis in range(3):
                x = at[point, axis]
                below, above = low[level][node, axis] - x, x - high[level][node, axis]
                inner += np.maximum(np.maximum(below, above), 0.0) ** 2
                outer += np.minimum(below, above) ** 2  # to the box's farthest corner
            # a box that holds anything holds it within its farthest corner
            bound = np.minimum(bound, _least(outer, point))
            near = inner <= (bound * MARGIN + SLACK)[point]
            point, node = point[near], node[near]
        else:
            yield some, point, node


@dataclasses.dataclass(frozen=True)
class TileIndex:
    """``cities(lat, lon, city_id, city_name, _tile)``, the sample's tree, and the boxes of the tiles and of the nodes above them."""

    cities: DataFrame
    sample: BoxTree
    low: list[np.ndarray]
    high: list[np.ndarray]


def tile_index(rows: DataFrame, n: int) -> TileIndex:
    """Tiles of ``rows(lat, lon, city)``, about ``n`` of them."""
    spark = rows.sparkSession
    drawn = rows.select("lat", "lon").sample(min(1.0, SAMPLE_CITIES / n), seed=1) if n > SAMPLE_CITIES else rows.select("lat", "lon")
    drawn = drawn.toArrow()
    sample = BoxTree.over(unit(drawn["lat"].to_numpy(), drawn["lon"].to_numpy()))
    depth = min(MAX_DEPTH, sample.depth, (-(-n // TILE_CITIES) - 1).bit_length())

    def tiled(batches):
        for b in batches:
            tile = sample.node_of(unit(b["lat"].to_numpy(), b["lon"].to_numpy()), depth)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tile, pa.int64())], names=[*b.schema.names, "_tile"])

    flat = rows.select("lat", "lon", "city.city_id", "city.city_name")
    cities = scratch_table(spark, "tile-cities", flat.mapInArrow(tiled, "lat double, lon double, city_id string, city_name string, _tile long"))
    phi, lam = F.radians("lat"), F.radians("lon")
    at = {"x": F.cos(phi) * F.cos(lam), "y": F.cos(phi) * F.sin(lam), "z": F.sin(phi)}
    boxes = cities.groupBy("_tile").agg(*[f(c) for f in (F.min, F.max) for c in at.values()]).toArrow()
    tile = boxes["_tile"].to_numpy()
    low, high = [np.full((2**depth, 3), np.inf)], [np.full((2**depth, 3), -np.inf)]
    for axis in range(3):
        low[0][tile, axis], high[0][tile, axis] = boxes.column(1 + axis).to_numpy(), boxes.column(4 + axis).to_numpy()
    for _ in range(depth):
        low.insert(0, np.minimum(low[0][::2], low[0][1::2]))
        high.insert(0, np.maximum(high[0][::2], high[0][1::2]))
    return TileIndex(cities, sample, low, high)


def with_close_places(points: DataFrame, index: TileIndex, lat: Column, lon: Column) -> DataFrame:
    """``points`` on the globe, once for each tile they visit, with ``_places``: those within the margin of
    the tile's nearest.  Copies of a point share ``_row``, and ``_copies`` is their number.

    Runs at once: the points are written with their tiles, and then with their places.
    """
    spark, sample, low, high = points.sparkSession, index.sample, index.low, index.high
    finite = (F.abs(lat) < float("inf")) & (F.abs(lon) < float("inf"))
    located = points.where(finite).withColumns({"_lat": lat.cast("double"), "_lon": lon.cast("double"), "_row": F.monotonically_increasing_id()})

    def visits(batches):
        for b in batches:
            at = unit(b["_lat"].to_numpy(), b["_lon"].to_numpy())
            counts, tiles = np.zeros(len(at), np.int64), [np.empty(0, np.int64)]
            if len(at):
                point, _, chord = sample.nearest(at)
                for some, point, tile in near_nodes(low, high, at, _least(chord, point)):
                    counts[some] = np.bincount(point, minlength=some.stop - some.start)
                    tiles.append(tile)
            listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(np.concatenate(tiles), pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns, listed], names=[*b.schema.names, "_tiles"])

    # the numbers of the rows are those that were written, whatever is run again
    visiting = scratch_table(spark, "tile-points", located.mapInArrow(visits, _adding(located, "_tiles array<bigint>")))
    visit = visiting.withColumns({"_tile": F.explode("_tiles"), "_copies": F.size("_tiles")}).drop("_tiles")
    # at most 2 ** MAX_DEPTH rows; cities of tiles that no point visits don't move
    parts = visit.groupBy("_tile").agg(F.ceil(F.count(F.lit(1)) / F.lit(TASK_POINTS)).alias("_n"))
    parts = F.broadcast(scratch_table(spark, "tile-parts", parts))
    left = visit.join(parts, "_tile").withColumn("_part", F.pmod(F.xxhash64("_row"), "_n")).drop("_n")
    right = index.cities.join(parts, "_tile").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).drop("_n")
    columns = [c for c in left.columns if c not in ("_lat", "_lon", "_tile", "_part")]
    schema = _adding(left.select(columns), f"_places {_CLOSE}")

    def search(points: pa.Table, cities: pa.Table) -> pa.Table:
        places, at = _places(cities.combine_chunks())
        tree = BoxTree.over(at)
        point, item, _ = tree.nearest(unit(points["_lat"].to_numpy(), points["_lon"].to_numpy()))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(point, minlength=points.num_rows))])
        listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), places.take(pa.array(tree.order[item])))
        return points.select(columns).append_column("_places", listed)

    key = ["_tile", "_part"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        lambda points, cities: search(points, cities) if points.num_rows else _none(points.select(columns)), schema)
    return scratch_table(spark, "tile-found", found)


def _adding(df: DataFrame, columns: str) -> StructType:
    return StructType([*df.schema.fields, *StructType.fromDDL(columns).fields])


def _none(points: pa.Table) -> pa.Table:
    city = pa.list_(pa.struct([("city_id", pa.string()), ("city_name", pa.string())]))
    return points.append_column("_places", pa.array([], pa.list_(pa.struct([("lat", pa.float64()), ("lon", pa.float64()), ("cities", city)]))))


def _places(cities: pa.Table) -> tuple[pa.StructArray, np.ndarray]:
    """``lat, lon, cities`` of each distinct position, and the positions."""
    lat, lon = cities["lat"].to_numpy(), cities["lon"].to_numpy()
    order = np.lexsort((lon, lat))
    lat, lon = lat[order], lon[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(lat) != 0) | (np.diff(lon) != 0)]))
    named = pa.StructArray.from_arrays([_whole(cities[c].take(pa.array(order))) for c in ("city_id", "city_name")], ["city_id", "city_name"])
    listed = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), named)
    lat, lon = lat[first], lon[first]
    return pa.StructArray.from_arrays([pa.array(lat), pa.array(lon), listed], ["lat", "lon", "cities"]), unit(lat, lon)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
