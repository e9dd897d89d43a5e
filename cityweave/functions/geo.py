"""Great-circle distance and a 3-D grid for proximity joins."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius used by the marts (km).
EARTH_RADIUS_KM = 6371.0

# Grid cells are made a hair wider than the search radius so that rounding at
# the cell edge can never separate two points that are within the radius.
CELL_WIDENING = 1.000001

# Rounding of a chord of the unit sphere between points of at most so many degrees, with room to spare.
MAX_DEGREES, CHORD_SLACK = 1000.0, 1e-13


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2, cos1=None, cos2=None) -> Column:
    """Great-circle distance in km between two points given in degrees.

    The haversine term is clamped to 1 so rounding near antipodes cannot
    produce ``asin(1 + ulp) = NaN``.  ``cos1`` and ``cos2`` name the cosines of
    the latitudes (``cos_lat``) where they are at hand.
    """
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    cos1, cos2 = (cos_lat(lat) if cos is None else _c(cos) for lat, cos in ((lat1, cos1), (lat2, cos2)))
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + cos1 * cos2 * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def cos_lat(lat) -> Column:
    return F.cos(F.radians(_c(lat)))


def unit_vector(lat, lon) -> tuple[Column, Column, Column]:
    """Position on the unit sphere; NULLs for angles so large that rounding moves it."""
    lat, lon = _c(lat), _c(lon)
    phi, lam = F.radians(lat), F.radians(lon)
    plain = (F.abs(lat) <= MAX_DEGREES) & (F.abs(lon) <= MAX_DEGREES)
    return tuple(F.when(plain, axis) for axis in (F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)))


def within_km(vector1, vector2, distance: Column, max_km: float) -> Column:
    """``distance < max_km``, told by the squared chord between the points' ``unit_vector``s, without
    trigonometry, unless that is too near to the limit's for its rounding."""
    # from the limit of half the globe on, every pair is told by its distance
    half = float(max_km) / (2 * EARTH_RADIUS_KM)
    if not 0 < half < 1.5:
        return distance < F.lit(float(max_km))
    chord = 2 * math.sin(half)
    sure, off = (max(0.0, chord * (2 - CELL_WIDENING) - CHORD_SLACK) ** 2, (chord * CELL_WIDENING + CHORD_SLACK) ** 2)
    x, y, z = ((_c(a) - _c(b)) * (_c(a) - _c(b)) for a, b in zip(vector1, vector2, strict=True))
    squared = x + y + z
    return F.when(squared < F.lit(sure), True).when(squared > F.lit(off), False).otherwise(distance < F.lit(float(max_km)))


def grid_cell(lat, lon, cell_km: float) -> Column:
    """3-D cell of a point on the sphere: ``struct(cx, cy, cz)`` of longs.

    Cells tile Earth-centred Cartesian space with cubes of side ``cell_km``.
    The chord between two points never exceeds their arc, so two points closer
    than ``cell_km`` along the surface always fall in neighbouring cells --
    at any latitude, across the poles and the antimeridian.
    """
    phi = F.radians(_c(lat))
    lam = F.radians(_c(lon))
    r = F.lit(EARTH_RADIUS_KM)
    w = F.lit(float(cell_km))
    return F.struct(
        F.floor(r * F.cos(phi) * F.cos(lam) / w).alias("cx"),
        F.floor(r * F.cos(phi) * F.sin(lam) / w).alias("cy"),
        F.floor(r * F.sin(phi) / w).alias("cz"),
    )


def grid_position(lat, lon, cell_km: float) -> Column:
    """``struct(cx, cy, cz, fx, fy, fz)``: the point's cell (as ``grid_cell``)
    and its offset inside the cell along each axis, in km (0 <= f <= cell_km)."""
    phi = F.radians(_c(lat))
    lam = F.radians(_c(lon))
    r = F.lit(EARTH_RADIUS_KM)
    w = F.lit(float(cell_km))
    coords = (r * F.cos(phi) * F.cos(lam), r * F.cos(phi) * F.sin(lam), r * F.sin(phi))
    cells = [F.floor(v / w) for v in coords]
    offsets = [F.least(w, F.greatest(F.lit(0.0), v - c * w)) for v, c in zip(coords, cells)]
    return F.struct(
        *[c.alias(n) for c, n in zip(cells, ("cx", "cy", "cz"))],
        *[f.alias(n) for f, n in zip(offsets, ("fx", "fy", "fz"))],
    )


def forward_cells_within(pos: str, cell_km: float, reach_km: float) -> Column:
    """Own cell plus the forward neighbours of the ``grid_position`` column
    ``pos`` whose cube lies within ``reach_km`` of the point.

    The distance from the point to a neighbour cube is, per axis, ``w - f``
    (next cell up), ``f`` (next cell down) or 0: a partner within ``reach_km``
    (chord <= arc) can only sit in a cube that passes this test, so the probe
    stays exact while far cubes -- most of them when cells are wider than the
    radius -- are never copied.  One SQL expression, compiled with the stage.
    """
    ref = f"`{pos}`"
    w = float(cell_km)
    limit = float(reach_km) ** 2
    parts = [f"named_struct('cx', {ref}.cx, 'cy', {ref}.cy, 'cz', {ref}.cz, 'own', true)"]
    for dx, dy, dz in itertools.product((-1, 0, 1), repeat=3):
        if (dx, dy, dz) <= (0, 0, 0):
            continue
        gaps = []
        for d, f in zip((dx, dy, dz), ("fx", "fy", "fz")):
            if d == 1:
                gaps.append(f"({w!r} - {ref}.{f}) * ({w!r} - {ref}.{f})")
            elif d == -1:
                gaps.append(f"{ref}.{f} * {ref}.{f}")
        cell = (
            f"named_struct('cx', {ref}.cx + {dx}, 'cy', {ref}.cy + {dy}, 'cz', {ref}.cz + {dz}, 'own', false)"
        )
        parts.append(f"CASE WHEN {' + '.join(gaps)} <= {limit!r} THEN {cell} END")
    return F.expr("array_compact(array(" + ", ".join(parts) + "))")


def cell_width(max_km: float, cell_km: float | None = None) -> float:
    """Cell side for a search radius; ``cell_km`` may only widen it."""
    width = max_km if cell_km is None else max(cell_km, max_km)
    return width * CELL_WIDENING
