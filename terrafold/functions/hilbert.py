"""Hilbert index of a covering box, as chained projections.

The curve covers the whole EPSG:3857 square at 16 bits an axis, so a key means
the same thing in every table. All 16 levels are resolved together by a prefix
scan over the level transforms (doubling the stride 1, 2, 4, 8), which needs a
handful of bitwise columns instead of one projection a level; everything stays
in whole-stage codegen. Each step is its own ``select`` so that Catalyst does
not inline the shared operands into an exponentially growing expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions.mercator import HALF_SIDE

BITS = 16
CELL_MAX = (1 << BITS) - 1


def axis_cell(centre: Column) -> Column:
    """Grid cell 0..65535 of one coordinate; outside the square clamps to its edge."""
    scaled = (centre + F.lit(HALF_SIDE)) / F.lit(2 * HALF_SIDE) * F.lit(float(CELL_MAX))
    # NULL has no cell; greatest and least alone would skip it.
    return F.when(scaled.isNotNull(), F.floor(
        F.least(F.greatest(scaled, F.lit(0.0)), F.lit(float(CELL_MAX)))).cast("bigint"))


def _shift(c: Column, by: int) -> Column:
    return F.shiftright(c, by)


def _inv(c: Column) -> Column:
    return c.bitwiseXOR(F.lit(CELL_MAX).cast("bigint"))


def with_cell_index(df: DataFrame, x: Column, y: Column, out: str) -> DataFrame:
    """Append the curve index of integer cell (x, y) as BIGINT column ``out``."""
    keep = [F.col(f"`{c}`") for c in df.columns]
    p = "__h_"

    def col(name: str) -> Column:
        return F.col(p + name)

    def step(frame: DataFrame, **cols: Column) -> DataFrame:
        return frame.select(*keep, *[c.alias(p + n) for n, c in cols.items()])

    df = step(df, x=x.cast("bigint"), y=y.cast("bigint"))
    xc, yc = col("x"), col("y")
    df = step(df, x=xc, y=yc, a=xc.bitwiseXOR(yc), b=_inv(xc.bitwiseXOR(yc)),
              c=_inv(xc.bitwiseOR(yc)), d=xc.bitwiseAND(_inv(yc)))
    a, b, c, d = col("a"), col("b"), col("c"), col("d")
    df = step(
        df, x=xc, y=yc,
        a=a.bitwiseOR(_shift(b, 1)),
        b=_shift(a, 1).bitwiseXOR(a),
        c=_shift(c, 1).bitwiseXOR(b.bitwiseAND(_shift(d, 1))).bitwiseXOR(c),
        d=a.bitwiseAND(_shift(c, 1)).bitwiseXOR(_shift(d, 1)).bitwiseXOR(d))
    for by in (2, 4, 8):
        df = step(
            df, x=xc, y=yc,
            a=a.bitwiseAND(_shift(a, by)).bitwiseXOR(b.bitwiseAND(_shift(b, by))),
            b=a.bitwiseAND(_shift(b, by)).bitwiseXOR(
                b.bitwiseAND(_shift(a.bitwiseXOR(b), by))),
            c=c.bitwiseXOR(a.bitwiseAND(_shift(c, by)).bitwiseXOR(
                b.bitwiseAND(_shift(d, by)))),
            d=d.bitwiseXOR(b.bitwiseAND(_shift(c, by)).bitwiseXOR(
                a.bitwiseXOR(b).bitwiseAND(_shift(d, by)))))
    low = xc.bitwiseXOR(yc)
    flip = c.bitwiseXOR(_shift(c, 1))
    swap = d.bitwiseXOR(_shift(d, 1))
    df = step(df, lo=low, hi=swap.bitwiseOR(_inv(low.bitwiseOR(flip))))
    # Spread 16 bits over the even positions of 32.
    for by, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        m = F.lit(mask).cast("bigint")
        df = step(df, **{
            n: col(n).bitwiseOR(F.shiftleft(col(n), by)).bitwiseAND(m) for n in ("lo", "hi")})
    return df.select(*keep, F.shiftleft(col("hi"), 1).bitwiseOR(col("lo")).alias(out))


def with_hilbert_key(df: DataFrame, out: str, bbox: str = "bbox") -> DataFrame:
    """Append the key of the box centre; NULL where there is no box."""
    cx = (F.col(f"{bbox}.xmin") + F.col(f"{bbox}.xmax")) / 2
    cy = (F.col(f"{bbox}.ymin") + F.col(f"{bbox}.ymax")) / 2
    return with_cell_index(df, axis_cell(cx), axis_cell(cy), out)
