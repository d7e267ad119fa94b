"""Distances and areas: raw in EPSG:3857 units, true after moving to a UTM zone or without one.

Without a zone, sides are taken as straight in EPSG:3857, as they are drawn, and
integrated over the ellipsoid: area by the authalic function, which makes an
equal-area square of it, length by the two radii of curvature. That holds for
features of any width.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import arrow_udf

from terrafold.functions import mercator, wkb

# A zone is 6 degrees wide; a feature spanning more has no one zone to measure in.
ZONE_WIDTH = 6.0


def zone_of_box(bbox: str = "bbox") -> Column:
    """UTM zone of a box centre, NULL where the box is too wide for one zone."""
    lo = mercator.x_to_lon(F.col(f"{bbox}.xmin"))
    hi = mercator.x_to_lon(F.col(f"{bbox}.xmax"))
    return F.when(hi - lo <= F.lit(ZONE_WIDTH), mercator.utm_zone((lo + hi) / 2))


def polygon_to_utm(way: Column, zone: Column) -> Column:
    """Polygon re-projected vertex by vertex; NULL zone gives NULL."""
    moved = F.transform(wkb.ring_points(way), lambda ring: mercator.utm_points(ring, zone))
    return wkb.make_polygon_with_holes(F.when(zone.isNotNull(), moved))


def point_to_utm(x: Column, y: Column, zone: Column) -> Column:
    at = mercator.utm_points(F.array(F.struct(x.alias("x"), y.alias("y"))), zone)[0]
    return wkb.make_point(at["x"], at["y"])


# ---------------------------------------------------------------- without a zone

_E2 = mercator.FLATTENING * (2 - mercator.FLATTENING)
_E = math.sqrt(_E2)
# Places along a side and their weights; a polynomial of degree 15 is integrated exactly.
_AT, _WEIGHT = (v / 2 for v in np.polynomial.legendre.leggauss(8))
# Sides longer than this, in EPSG:3857 units, are integrated piece by piece.
_PIECE = 500_000.0


def _pieces(sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sides, long ones in pieces, and which side each piece is of."""
    size = np.hypot(sides[:, 2] - sides[:, 0], sides[:, 3] - sides[:, 1])
    n = np.maximum(1, np.ceil(size / _PIECE)).astype(np.int64)
    of = np.repeat(np.arange(len(sides)), n)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    step = (sides[:, 2:] - sides[:, :2])[of] / n[of, None]
    start = sides[of, :2] + step * nth[:, None]
    return np.hstack([start, start + step]), of


def _sines(sides: np.ndarray) -> np.ndarray:
    """Sine of the latitude at the places along each side."""
    y = sides[:, 1, None] + (sides[:, 3] - sides[:, 1])[:, None] * (_AT + 0.5)
    return np.tanh(y / mercator.EARTH_RADIUS)


def _swept(sides: np.ndarray) -> np.ndarray:
    """Square metres between each side and the equator, signed by its direction."""
    s = _sines(sides)
    q = (1 - _E2) * (s / (1 - _E2 * s * s) + np.arctanh(_E * s) / _E)
    return (sides[:, 2] - sides[:, 0]) * mercator.EARTH_RADIUS / 2 * (q * _WEIGHT).sum(axis=1)


def _metres(sides: np.ndarray) -> np.ndarray:
    s = _sines(sides)
    cosine, bent = np.sqrt(1 - s * s), 1 - _E2 * s * s
    east = cosine / np.sqrt(bent) * (sides[:, 2] - sides[:, 0])[:, None]
    north = cosine * (1 - _E2) / bent ** 1.5 * (sides[:, 3] - sides[:, 1])[:, None]
    return (np.hypot(east, north) * _WEIGHT).sum(axis=1)


@arrow_udf(T.DoubleType())
def true_area(way: pa.Array) -> pa.Array:
    """Square metres on the ellipsoid of EPSG:3857 polygons, holes taken off; 0 for points and lines."""
    rings = wkb.flatten(way)
    at = rings.ring_of_point()
    same = np.flatnonzero(at[1:] == at[:-1])
    pieces, of = _pieces(np.hstack([rings.xy[same], rings.xy[same + 1]]))
    swept = np.bincount(of, _swept(pieces), minlength=len(same))
    ring = np.abs(np.bincount(at[same], swept, minlength=len(rings.row)))
    size = ring * np.where(rings.ring == 0, 1, -1) * (rings.kind == wkb.POLYGON)
    return pa.array(np.bincount(rings.row, size, minlength=rings.rows), pa.float64(),
                    mask=np.asarray(way.is_null()))


@arrow_udf(T.DoubleType())
def true_length(way: pa.Array) -> pa.Array:
    """Metres on the ellipsoid of the lines and borders of EPSG:3857 geometries."""
    rings = wkb.flatten(way)
    seg = wkb.segments(rings)
    pieces, of = _pieces(seg.xyxy)
    return pa.array(np.bincount(seg.row[of], _metres(pieces), minlength=rings.rows), pa.float64(),
                    mask=np.asarray(way.is_null()))
