"""SQL text shared by several twins."""

from __future__ import annotations

import math

from terrafold.functions import mercator
from terrafold.functions.mercator import HALF_SIDE


def hilbert(source: str, x: str, y: str, keep: str, out: str = "hkey") -> str:
    """CTEs ending in ``curve`` with the Hilbert index of (x, y) per row.

    One level at a time: a row carries whether its quadrant is swapped and
    flipped, independent of the prefix scan the engine uses.
    """
    half = repr(HALF_SIDE)

    def cell(c: str) -> str:
        return (f"cast(floor(least(greatest(({c} + {half}) / (2 * {half}) * 65535e0, 0e0), 65535e0)) "
                "AS bigint)")

    steps = [f"h16 AS (SELECT {keep}, {cell(x)} AS hx, {cell(y)} AS hy, 0::bigint AS s, "
             f"0::bigint AS f, 0::bigint AS d FROM {source})"]
    for k in range(15, -1, -1):
        bit = f"(SELECT *, xor((CASE WHEN s = 1 THEN hy ELSE hx END >> {k}) & 1, f) AS rx, " \
              f"xor((CASE WHEN s = 1 THEN hx ELSE hy END >> {k}) & 1, f) AS ry FROM h{k + 1})"
        steps.append(
            f"h{k} AS (SELECT {keep}, hx, hy, "
            "CASE WHEN ry = 0 THEN 1 - s ELSE s END AS s, "
            "CASE WHEN ry = 0 AND rx = 1 THEN 1 - f ELSE f END AS f, "
            "d * 4 + xor(3 * rx, ry) AS d FROM "
            f"{bit} b{k})")
    return ", ".join(steps) + f", curve AS (SELECT {keep}, d AS {out} FROM h0)"


def utm(source: str, keep: str, lon: str, lat: str, meridian: str = "141", out: str = "utm") -> str:
    """CTEs ending in ``out``: east and north of the zone with that meridian, 54 by default.

    The conformal latitude comes from its tangent form here and from artanh in
    the engine; the series is the same.
    """
    n = mercator.FLATTENING / (2 - mercator.FLATTENING)
    e = repr(math.sqrt(mercator.FLATTENING * (2 - mercator.FLATTENING)))
    k = repr(0.9996 * mercator.EARTH_RADIUS / (1 + n) * (1 + n**2 / 4 + n**4 / 64))
    a = [repr(v) for v in (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280)]
    east = " + ".join(f"{v}::double * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, v in enumerate(a, 1))
    north = " + ".join(f"{v}::double * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, v in enumerate(a, 1))
    return f"""
{out}0 AS (SELECT {keep}, tan(radians({lat})) AS t, radians({lon} - ({meridian})) AS dl FROM {source}),
{out}1 AS (SELECT {keep}, t, dl, sinh({e}::double * atanh({e}::double * t / sqrt(1 + t * t))) AS sg FROM {out}0),
{out}2 AS (SELECT {keep}, dl, t * sqrt(1 + sg * sg) - sg * sqrt(1 + t * t) AS tc FROM {out}1),
{out}3 AS (SELECT {keep}, atan2(tc, cos(dl)) AS xi, asinh(sin(dl) / sqrt(tc * tc + cos(dl) * cos(dl))) AS eta FROM {out}2),
{out} AS (SELECT {keep}, 500000e0 + {k}::double * (eta + {east}) AS east, {k}::double * (xi + {north}) AS north FROM {out}3)"""
