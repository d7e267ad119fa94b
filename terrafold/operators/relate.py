"""How lines and areas lie to areas: corners inside, crossing borders, one around the other.

Three joins, each on cells, tell a pair apart. Corners are points in polygons.
Borders meet where two sides on one square of a grid do; the grid is as fine as
half the mean side, so that all sides together lie on about three times as many
squares as there are sides. An area holds another, or a hole of it, if a ring
of that begins inside it. Every join adds its findings up by pair before they
move, so a pair is one row whatever the number of cells it shares.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions import wkb
from terrafold.operators import grid, spatial
from terrafold.operators.skew import TASK_ROWS, even, join_spread
from terrafold.workspace import stored

# Bytes of a side on a square.
SIDE_BYTES = 80


def mean_level(*sides: DataFrame) -> int:
    """The level of squares about half as wide as a mean side is long."""
    length = F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1")))
    found = [s.agg(F.count("*").alias("n"), F.sum(length).alias("length")).first() for s in sides]
    n, total = sum(r["n"] for r in found), sum(r["length"] or 0.0 for r in found)
    return math.ceil(math.log2(total / (2 * n))) if total else 0


def crossings(sides: DataFrame, borders: DataFrame, key: str, area_key: str,
              broadcast_bytes: int = spatial.BROADCAST_BYTES,
              task_rows: int = TASK_ROWS) -> DataFrame:
    """(key, area_key) of which a side meets a border, each pair once.

    Both tables are stored ones of (key, x1, y1, x2, y2).
    """
    level = mean_level(sides, borders)
    low, high = F.least("x1", "x2"), F.greatest("x1", "x2")
    bounds = borders.agg(F.min(low).alias("x0"), F.max(high).alias("x1"),
                         F.min(F.least("y1", "y2")).alias("y0"),
                         F.max(F.greatest("y1", "y2")).alias("y1")).first()
    if bounds["x0"] is None:
        nobody = F.lit(None).cast(borders.schema[area_key].dataType)
        return sides.select(key, nobody.alias(area_key)).limit(0)
    near = sides.where((high >= bounds["x0"]) & (low <= bounds["x1"])
                       & (F.greatest("y1", "y2") >= bounds["y0"])
                       & (F.least("y1", "y2") <= bounds["y1"]))

    def squared(df: DataFrame, name: str, as_: str) -> DataFrame:
        return grid.on_squares(df, level).select(
            name, F.xxhash64("cx", "cy").alias("__square"),
            F.struct("cx", "cy", *grid.ENDS).alias(as_))

    many, few = squared(near, key, "__a"), stored(squared(borders, area_key, "__b"), "borders")
    if few.count() * SIDE_BYTES <= broadcast_bytes:
        met = many.join(F.broadcast(few), "__square")
    else:
        met = join_spread(stored(many, "sides"), few, "__square", spread_by=[key, "__a"],
                          task_rows=task_rows)
    same = (F.col("__a.cx") == F.col("__b.cx")) & (F.col("__a.cy") == F.col("__b.cy"))
    return met.where(same & grid.meets("__a", "__b")).select(key, area_key).distinct()


def relate(features: DataFrame, areas: DataFrame, key: str, area_key: str, way: str = "way",
           area_way: str = "way", broadcast_bytes: int = spatial.BROADCAST_BYTES,
           task_rows: int = TASK_ROWS) -> DataFrame:
    """(key, area_key, nodes, inside, crosses, holds) of every pair that meets, one row a pair.

    ``nodes`` are the feature's corners, ``inside`` those strictly inside the
    area; ``crosses`` says that borders meet, a touch included; ``holds`` that a
    ring of the area, its border or that of a hole, begins inside the feature.
    A feature may be several rows, points, lines and areas alike; an area may be
    several rows. Null geometries meet nothing.
    """
    size = {"broadcast_bytes": broadcast_bytes, "task_rows": task_rows}
    corners = stored(grid.nodes(features, key, way), "nodes")
    inside = spatial.within(corners, areas.select(area_key, area_way), area_key, x=F.col("x"),
                            y=F.col("y"), way=area_way, spread_by=[key, "x", "y"], **size)
    inside = inside.groupBy(key, area_key).agg(F.count("*").alias("inside"))
    crossed = crossings(stored(grid.segments(features, key, way), "sides"),
                        stored(grid.segments(areas, area_key, area_way, wkb.POLYGON), "borders"),
                        key, area_key, **size)
    starts = grid.ring_starts(areas, area_key, area_way)
    held = spatial.within(starts, features.select(key, way), key, x=F.col("x"), y=F.col("y"),
                          way=way, spread_by=[area_key, "x", "y"], **size)

    def found(df: DataFrame, inside: Column, crosses: bool, holds: bool) -> DataFrame:
        return df.select(key, area_key, inside.alias("inside"), F.lit(crosses).alias("crosses"),
                         F.lit(holds).alias("holds"))

    none = F.lit(0).cast("bigint")
    pairs = (found(inside, F.col("inside"), False, False)
             .unionAll(found(crossed, none, True, False))
             .unionAll(found(held.select(key, area_key), none, False, True))
             .groupBy(key, area_key).agg(F.max("inside").alias("inside"),
                                         F.max("crosses").alias("crosses"),
                                         F.max("holds").alias("holds")))
    total = corners.groupBy(key).agg(F.count("*").alias("nodes"))
    return pairs.join(even(total), key).select(
        key, area_key, "nodes", "inside", "crosses", "holds")


def any_node() -> Column:
    """Some corner lies strictly inside: the rule of counting ways by their nodes."""
    return F.col("inside") > 0


def wholly() -> Column:
    """All of the feature lies strictly inside, clear of holes."""
    return (F.col("inside") == F.col("nodes")) & ~F.col("crosses") & ~F.col("holds")


def counts(pairs: DataFrame, key: str, area_key: str) -> DataFrame:
    """Per area: the features with a node inside, those wholly inside, and all that meet it."""
    return pairs.groupBy(area_key).agg(
        F.count_if(any_node()).alias("any_node"), F.count_if(wholly()).alias("wholly"),
        F.count("*").alias("meeting"))
