"""Coordinate transforms as plain column expressions (no UDF).

EPSG:4326 <-> EPSG:3857 is closed form. EPSG:4326 -> UTM uses the Krueger
series to fourth order in the third flattening, good to well under a
millimetre inside a zone.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS 84 ellipsoid and UTM parameters.
EARTH_RADIUS = 6378137.0
FLATTENING = 1 / 298.257223563
UTM_SCALE = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_SOUTH_OFFSET = 10000000.0

# Half the side of the EPSG:3857 square.
HALF_SIDE = math.pi * EARTH_RADIUS


def lon_to_x(lon: Column) -> Column:
    return F.radians(lon) * F.lit(EARTH_RADIUS)


def lat_to_y(lat: Column) -> Column:
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * F.lit(EARTH_RADIUS)


def x_to_lon(x: Column) -> Column:
    return F.degrees(x / F.lit(EARTH_RADIUS))


def y_to_lat(y: Column) -> Column:
    return F.degrees(F.atan(F.exp(y / F.lit(EARTH_RADIUS))) * 2 - F.lit(math.pi / 2))


def utm_zone(lon: Column) -> Column:
    """Zone number of a longitude; 180 falls back into zone 60."""
    return F.least(F.floor((lon + 180) / 6).cast("int") + 1, F.lit(60))


# Third flattening, rectifying radius and the series coefficients.
_N = FLATTENING / (2 - FLATTENING)
_E = math.sqrt(FLATTENING * (2 - FLATTENING))
_RADIUS = EARTH_RADIUS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
Step = Callable[[Callable[[str], Column]], dict[str, Column]]


def _utm_steps() -> list[Step]:
    """The projection as steps from named columns to named columns.

    Every intermediate is used many times in the next step; kept apart, each is
    computed once.
    """
    def angles(c):
        s = F.sin(F.radians(c("lat")))
        off = F.radians(c("lon") - (c("zone") * 6 - 183))
        return {"t": F.sinh(F.atanh(s) - F.atanh(s * F.lit(_E)) * F.lit(_E)), "off": off,
                "south": c("lat") < 0}

    def sphere(c):
        return {"xi": F.atan2(c("t"), F.cos(c("off"))),
                "eta": F.atanh(F.sin(c("off")) / F.sqrt(F.lit(1.0) + c("t") * c("t"))),
                "south": c("south"), "ok": F.abs(c("off")) <= F.lit(math.radians(30.0))}

    def series(c):
        east, north = c("eta"), c("xi")
        for j, a in enumerate(_ALPHA, start=1):
            east = east + F.cos(c("xi") * (2 * j)) * F.sinh(c("eta") * (2 * j)) * F.lit(a)
            north = north + F.sin(c("xi") * (2 * j)) * F.cosh(c("eta") * (2 * j)) * F.lit(a)
        k = F.lit(UTM_SCALE * _RADIUS)
        shift = F.when(c("south"), F.lit(UTM_SOUTH_OFFSET)).otherwise(F.lit(0.0))
        return {"x": F.when(c("ok"), east * k + F.lit(UTM_FALSE_EASTING)),
                "y": F.when(c("ok"), north * k + shift)}

    return [angles, sphere, series]


def with_utm(df: DataFrame, lon: Column, lat: Column, zone: int | Column, east: str,
             north: str) -> DataFrame:
    """Append easting and northing in metres for the given UTM zone.

    Wide of the zone (more than 30 degrees off its meridian) the series no
    longer holds; those rows give NULL rather than a wrong number.
    """
    keep = [F.col(f"`{c}`") for c in df.columns]
    zone = F.lit(zone) if isinstance(zone, int) else zone
    df = df.select(*keep, lon.alias("__u_lon"), lat.alias("__u_lat"), zone.alias("__u_zone"))
    for step in _utm_steps():
        out = step(lambda name: F.col(f"__u_{name}"))
        df = df.select(*keep, *[v.alias(f"__u_{k}") for k, v in out.items()])
    return df.select(*keep, F.col("__u_x").alias(east), F.col("__u_y").alias(north))


def utm_points(points: Column, zone: Column) -> Column:
    """An array<struct<x, y>> of EPSG:3857 positions moved to a UTM zone."""
    def unproject(p: Column) -> Column:
        return F.struct(x_to_lon(p["x"]).alias("lon"), y_to_lat(p["y"]).alias("lat"),
                        zone.alias("zone"))

    def apply(step: Step) -> Callable[[Column], Column]:
        return lambda p: F.struct(
            *[v.alias(k) for k, v in step(lambda name: p[name]).items()])

    points = F.transform(points, unproject)
    for step in _utm_steps():
        points = F.transform(points, apply(step))
    return points


def lonlat_measure_guard(crs: str) -> None:
    """Refuse a lon/lat measure on projected coordinates instead of answering wrongly."""
    if crs != "EPSG:4326":
        raise ValueError(f"only lon/lat coordinates can be measured this way, not {crs}")
