"""Box filters, exact refinement and the point-in-polygon join.

The join never compares a point with a polygon it cannot meet. Each polygon is
cut into square cells, from a size of its own extent down: a cell is quartered
while more than CELL_SEGMENTS of the polygon's segments meet it, and while the
polygon's cells cover much more than the polygon, as each quarter that lies
outside spares its points a test. What remains of the test is one or two
comparisons: a cell that no side meets is inside as a whole, one or two
neighbouring sides make it a half plane or a wedge. Only crowded cells keep
their segments and one fact, whether their lower left corner lies inside; a
point lies on the corner's side unless the way between them crosses the border.

Points find their cells in two equi-joins. A coarse grid knows which sizes of
cells lie under each of its squares, so a point is looked up only at sizes that
are in use where it lies.

Where only the number of points is asked for, points are counted by cell first,
and a cell inside as a whole adds its count: pairs are made in border cells
alone. The more points a polygon holds, the finer its cells are cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions import wkb
from terrafold.operators.skew import TASK_ROWS, dealt, even, heavy_counted, join_spread
from terrafold.workspace import stored

# A cell is quartered while it holds more segments, at most this many times: where
# more of them meet at one point, quartering does not part them.
CELL_SEGMENTS, DEEPEST = 16, 24
# A polygon's cells are quartered on while they cover more than COVER times its area, unless
# that makes more than CELLS of them and one for each FEW_SIDES sides.
COVER, CELLS, FEW_SIDES = 2.2, 96, 4
# Cells along a border for counting, by the points a polygon holds: at the square root of a
# 64th of them, making cells costs about what testing the points in them does.
BORDER, POINTS_A_CELL = (8, 500), 64
# Sizes of cells that are told apart in a square of the coarse grid.
BITS = 62
# Where a point lies in more cells than this on average, few points are dealt out first.
MANY = 8
# Cells table up to this size goes to every executor, through the driver, a larger one is shuffled.
BROADCAST_BYTES = 32 * 1024 * 1024

# What a cell asks of a point: nothing, to lie in two half planes, in either, or the way to
# its corner.
WHOLE, BOTH, EITHER, CROSSINGS = range(4)

Box = tuple[float, float, float, float]


# ---------------------------------------------------------------- filters

def covering_meets(box: Box, bbox: str = "bbox") -> Column:
    """The covering test; its four comparisons reach the Parquet footer."""
    xmin, ymin, xmax, ymax = (float(v) for v in box)
    return ((F.col(f"{bbox}.xmin") <= xmax) & (F.col(f"{bbox}.xmax") >= xmin)
            & (F.col(f"{bbox}.ymin") <= ymax) & (F.col(f"{bbox}.ymax") >= ymin))


def intersects(df: DataFrame, box: Box, way: str = "way", bbox: str = "bbox") -> DataFrame:
    """Covering test first, so that only its survivors are parsed."""
    return df.where(covering_meets(box, bbox)).where(
        wkb.intersects_box(F.col(way), *[F.lit(float(v)) for v in box]))


def wider_than(metres: float, bbox: str = "bbox") -> Column:
    return F.greatest(F.col(f"{bbox}.xmax") - F.col(f"{bbox}.xmin"),
                      F.col(f"{bbox}.ymax") - F.col(f"{bbox}.ymin")) > metres


def append_bbox(df: DataFrame, way: str = "way", bbox: str = "bbox") -> DataFrame:
    """All columns unchanged and in order, then the extent struct, NULL without geometry."""
    return df.withColumn(bbox, wkb.envelope(F.col(way)))


# ---------------------------------------------------------------- point in polygon

def _cell(level: Column, cx: Column, cy: Column) -> Column:
    """A cell as one number to join by; the join compares its place as well."""
    return F.xxhash64(level.cast("int"), cx.cast("bigint"), cy.cast("bigint"))


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and place within the owner of ``counts[i]`` things each."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _side(seg: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x1, y1, x2, y2 = seg.T
    return (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)


def _right(seg: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Segments that a ray from (x, y) to larger x crosses; ends count half-open."""
    up, down = seg[:, 1] <= y, seg[:, 3] <= y
    side = _side(seg, x, y)
    return (up & ~down & (side > 0)) | (down & ~up & (side < 0))


def _above(seg: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether (x, y), moved a hair right and a hair of a hair up, lies above the segment's line."""
    turn = np.where(seg[:, 2] > seg[:, 0], 1.0, -1.0)
    side = _side(seg, x, y) * turn
    return (side > 0) | ((side == 0) & ((seg[:, 3] - seg[:, 1]) * turn <= 0))


def _flips(seg: np.ndarray, cx, cy, x, y) -> np.ndarray:
    """Whether the way from (cx, cy) up to (cx, y), then along to (x, y), crosses the segment oddly.

    Both legs see a corner they pass through as the ray test does, so the sum
    over a closed border is exact.
    """
    along = ((seg[:, 1] <= y) != (seg[:, 3] <= y)) & (_right(seg, cx, y) != _right(seg, x, y))
    up = ((seg[:, 0] <= cx) != (seg[:, 2] <= cx)) & (_above(seg, cx, cy) != _above(seg, cx, y))
    return along != up


@dataclass
class _Cells:
    """Cells of a run of polygons, and the segments of each in cell order."""

    polygon: np.ndarray
    level: np.ndarray
    cx: np.ndarray
    cy: np.ndarray
    inside: np.ndarray
    counts: np.ndarray
    segments: np.ndarray


def _boxes(cx: np.ndarray, cy: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Cells as boxes, grown a little so that rounding never loses a touching segment."""
    slack = side * 1e-6
    return np.column_stack([cx * side - slack, cy * side - slack, (cx + 1) * side + slack,
                            (cy + 1) * side + slack])


def _odd(cell: np.ndarray, flips: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(cell, flips, minlength=n) % 2 == 1


def _cut(segments: np.ndarray, first: np.ndarray, counts: np.ndarray,
         most: int | None = None, cover: float = COVER, cells: int = CELLS) -> Iterator[_Cells]:
    """Cells of polygons given as runs ``first, counts`` of ``segments``, size by size.

    All polygons of the run are quartered together; what is held at once is the
    pairs of a cell with a segment that meets it.
    """
    most = CELL_SEGMENTS if most is None else most
    lo = np.minimum(segments[:, :2], segments[:, 2:])
    hi = np.maximum(segments[:, :2], segments[:, 2:])
    low, high = np.minimum.reduceat(lo, first), np.maximum.reduceat(hi, first)
    # Cells of the first size cover a polygon's box two across at most.
    extent = np.maximum((high - low).max(axis=1), 1e-300)
    level = np.ceil(np.log2(extent)).astype(np.int64)
    # Finer than the coordinates themselves a cell cannot be told from its neighbour.
    finest = np.ceil(np.log2(np.maximum(np.abs(np.hstack([low, high])).max(axis=1), 1e-300))
                     ).astype(np.int64) - 50
    level = np.maximum(level, finest)
    size = np.exp2(level)
    start = np.floor(low / size[:, None]).astype(np.int64)
    across = np.floor(high / size[:, None]).astype(np.int64) - start + 1
    polygon, nth = _spread(across[:, 0] * across[:, 1])
    cx = start[polygon, 0] + nth % across[polygon, 0]
    cy = start[polygon, 1] + nth // across[polygon, 0]
    cell, nth = _spread(counts[polygon])
    seg = first[polygon][cell] + nth
    side = size[polygon]
    level = level[polygon]
    corner = _odd(cell, _right(segments[seg], (cx * side)[cell], (cy * side)[cell]), len(cx))
    n = len(first)
    at = segments - np.tile(segments[first, :2], 2)[np.repeat(np.arange(n), counts)]
    area = np.abs(np.add.reduceat(at[:, 0] * at[:, 3] - at[:, 2] * at[:, 1], first)) / 2
    covered, made = np.zeros(n), np.zeros(n)
    for depth in range(DEEPEST + 1):
        near = wkb.segments_meet_box(segments[seg], _boxes(cx, cy, side)[cell])
        cell, seg = cell[near], seg[near]
        held = np.bincount(cell, minlength=len(cx))
        here = (held > 0) | corner
        wide = covered + np.bincount(polygon[here], (side * side)[here], n) > cover * area
        many = made + 4 * np.bincount(polygon[here], held[here] > 0, n) > cells + counts / FEW_SIDES
        more = (held > most) | ((held > 0) & (wide & ~many)[polygon])
        split = more & (level > finest[polygon]) if depth < DEEPEST else held < 0
        # Cells that nothing meets are on one side as a whole; outside ones are left out.
        keep = ~split & ((held > 0) | corner)
        used = keep[cell]
        yield _Cells(polygon[keep], level[keep], cx[keep], cy[keep], corner[keep], held[keep],
                     segments[seg[used]])
        if not split.any():
            return
        covered += np.bincount(polygon[keep], (side * side)[keep], n)
        made += np.bincount(polygon[keep], minlength=n)
        parent = np.flatnonzero(split)
        number = np.full(len(cx), -1)
        number[parent] = np.arange(len(parent))
        mine = split[cell]
        pairs, seg = number[cell[mine]], seg[mine]
        # Four children a parent; each gets all of the parent's segments to choose from.
        old = len(parent)
        child = np.arange(4 * old)
        up, quarter = child % old, child // old
        x0, y0 = (cx * side)[parent], (cy * side)[parent]
        polygon, level = polygon[parent][up], level[parent][up] - 1
        side = np.exp2(level)
        cx, cy = cx[parent][up] * 2 + quarter % 2, cy[parent][up] * 2 + quarter // 2
        cell = np.concatenate([pairs + q * old for q in range(4)])
        seg = np.tile(seg, 4)
        at = up[cell]
        flips = _flips(segments[seg], x0[at], y0[at], (cx * side)[cell], (cy * side)[cell])
        corner = corner[parent][up] != _odd(cell, flips, 4 * old)


# (cell, segment) pairs a run of small polygons begins with.
PAIRS_AT_ONCE = 60_000


def _cut_batch(segments: np.ndarray, first: np.ndarray, counts: np.ndarray,
               cover: float = COVER, cells: int = CELLS) -> Iterator[_Cells]:
    run = np.cumsum(counts * 4) // PAIRS_AT_ONCE
    for r in np.unique(run):
        some = np.flatnonzero(run == r)
        a, b = first[some[0]], first[some[-1]] + counts[some[-1]]
        for found in _cut(segments[a:b], first[some] - a, counts[some], None, cover, cells):
            found.polygon = some[found.polygon]
            yield found


def _half_planes(c: _Cells) -> tuple[np.ndarray, np.ndarray]:
    """What each cell asks of a point, and two directed lines with the asked side on their left.

    A cell that one segment meets is parted by its line. Two that share an end
    make a wedge; inside is the wedge or what lies outside it, told by a corner
    of the cell that is on neither line.
    """
    n, start = len(c.cx), np.cumsum(c.counts) - c.counts
    kind = np.where(c.counts == 0, WHOLE, CROSSINGS)
    lines = np.zeros((n, 8))
    one = np.flatnonzero(c.counts == 1)
    two = np.flatnonzero(c.counts == 2)
    p, q = c.segments[start[two]], c.segments[start[two] + 1]
    # Both from the shared end outwards.
    joined = [(p[:, i:i + 2] == q[:, j:j + 2]).all(axis=1) for i in (0, 2) for j in (0, 2)]
    fits = np.sum(joined, axis=0) == 1
    turn_p, turn_q = joined[2] | joined[3], joined[1] | joined[3]
    p = np.where(turn_p[:, None], p[:, [2, 3, 0, 1]], p)
    q = np.where(turn_q[:, None], q[:, [2, 3, 0, 1]], q)
    bend = _side(p, q[:, 2], q[:, 3])
    fits &= bend != 0
    # The other arm to the left of each.
    left = bend > 0
    p = np.where(left[:, None], p, p[:, [2, 3, 0, 1]])
    q = np.where(left[:, None], q[:, [2, 3, 0, 1]], q)
    two, p, q = two[fits], p[fits], q[fits]
    cells = np.r_[one, two]
    a = np.concatenate([c.segments[start[one]], p])
    b = np.concatenate([c.segments[start[one]], q])
    size = np.exp2(c.level[cells])
    x0, y0 = c.cx[cells] * size, c.cy[cells] * size
    known = np.zeros(len(cells), bool)
    for dx, dy in ((0, 0), (1, 0), (0, 1), (1, 1), (0.5, 0.5), (0.25, 0.5)):
        x, y = x0 + dx * size, y0 + dy * size
        sa, sb = _side(a, x, y), _side(b, x, y)
        now = ~known & (sa != 0) & (sb != 0)
        odd = _flips(a, x0, y0, x, y)
        odd[len(one):] ^= _flips(b, x0, y0, x, y)[len(one):]
        inside = c.inside[cells] != odd
        same = inside == ((sa > 0) & (sb > 0))
        kind[cells[now]] = np.where(same, BOTH, EITHER)[now]
        turned = np.hstack([a[:, [2, 3, 0, 1]], b[:, [2, 3, 0, 1]]])
        lines[cells[now]] = np.where(same[:, None], np.hstack([a, b]), turned)[now]
        known |= now
    return kind, lines


def _some_inside(c: _Cells, kind: np.ndarray, lines: np.ndarray):
    """Without the cells that the border only touches, so that no point in them is inside."""
    size = np.exp2(c.level)
    left = [np.zeros(len(kind), bool), np.zeros(len(kind), bool)]
    for dx, dy in ((0, 0), (1, 0), (0, 1), (1, 1)):
        x, y = (c.cx + dx) * size, (c.cy + dy) * size
        for i in (0, 1):
            left[i] |= _side(lines[:, 4 * i:4 * i + 4], x, y) > 0
    keep = (kind == WHOLE) | (kind == CROSSINGS) | np.where(
        kind == BOTH, left[0] & left[1], left[0] | left[1])
    return _Cells(c.polygon[keep], c.level[keep], c.cx[keep], c.cy[keep], c.inside[keep],
                  c.counts[keep], c.segments[np.repeat(keep, c.counts)]), kind[keep], lines[keep]


def polygon_cells(polygons: DataFrame, key: str, way: str = "way", cover: float = COVER,
                  cells: int = CELLS) -> DataFrame:
    """(key, level, cx, cy, cell, kind, a1..b4, inside, segments) for every polygon.

    ``kind`` says what a cell asks of a point, ``a1`` to ``b4`` the two lines it
    is asked of. ``inside`` is the side of the cell's lower left corner.
    """
    schema = (f"`{key}` {polygons.schema[key].dataType.simpleString()}, level int, cx bigint, "
              f"cy bigint, kind int, {', '.join(f'{c} double' for c in _LINES)}, inside boolean, "
              "segments array<struct<x1:double,y1:double,x2:double,y2:double>>")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wkb.sliced(batches, 1):
            keys = batch.column(0)
            segs = wkb.segments(wkb.flatten(batch.column(1)))
            closed = segs.where(segs.kind == wkb.POLYGON)
            rows, xyxy = closed.row, closed.xyxy
            if not len(rows):
                continue
            first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            counts = np.diff(np.r_[first, len(rows)])
            for c in _cut_batch(xyxy, first, counts, cover, cells):
                kind, lines = _half_planes(c)
                c, kind, lines = _some_inside(c, kind, lines)
                # Only cells whose lines do not settle it keep their segments.
                kept = np.where(kind == CROSSINGS, c.counts, 0)
                segments = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(kept)], pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(x) for x in c.segments[np.repeat(kept > 0, c.counts)].T],
                        names=list(wkb.SEGMENT_FIELDS)))
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(rows[first][c.polygon])), pa.array(c.level, pa.int32()),
                     pa.array(c.cx, pa.int64()), pa.array(c.cy, pa.int64()),
                     pa.array(kind, pa.int32()), *[pa.array(x) for x in lines.T],
                     pa.array(c.inside, pa.bool_()), segments],
                    names=[key, "level", "cx", "cy", "kind", *_LINES, "inside", "segments"])

    shapes = dealt(polygons.select(key, way).where(F.col(way).isNotNull()))
    found = shapes.mapInArrow(cut, schema)
    return found.select(key, "level", "cx", "cy", _cell(F.col("level"), F.col("cx"), F.col("cy"))
                        .alias("cell"), "kind", *_LINES, "inside", "segments")


_LINES = [f"{line}{i}" for line in "ab" for i in range(1, 5)]

# What a segment through the point adds to a count of crossings.
_THROUGH = 1 << 20


def _crossed(s: Column, x0: Column, y0: Column, x: Column, y: Column) -> Column:
    """1 for a segment the way from the corner (x0, y0) to (x, y) crosses; _THROUGH if (x, y) is on it.

    The same two legs as in ``_flips``.
    """
    x1, y1, x2, y2 = (s[f] for f in wkb.SEGMENT_FIELDS)

    def side(px: Column, py: Column) -> Column:
        return (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)

    straddles = (y1 <= y) != (y2 <= y)
    rises = F.when(y1 <= y, 1).otherwise(-1)
    right = ((side(x0, y) * rises) > 0) != ((side(x, y) * rises) > 0)
    turn = F.when(x2 > x1, 1.0).otherwise(-1.0)

    def above(py: Column) -> Column:
        here = side(x0, py) * turn
        return (here > 0) | ((here == 0) & ((y2 - y1) * turn <= 0))

    along = straddles & right
    up = ((x1 <= x0) != (x2 <= x0)) & (above(y0) != above(y))
    through = ((side(x, y) == 0) & (F.least(x1, x2) <= x) & (x <= F.greatest(x1, x2))
               & (F.least(y1, y2) <= y) & (y <= F.greatest(y1, y2)))
    return F.when(through, _THROUGH).when(along != up, 1).otherwise(0)


def _strictly_within(x: Column, y: Column) -> Column:
    """On the corner's side unless the way crosses oddly, and no segment through the point."""
    size = F.pow(F.lit(2.0), F.col("__c.level"))
    x0, y0 = F.col("__c.cx") * size, F.col("__c.cy") * size
    n = F.aggregate("__c.segments", F.lit(0), lambda total, s: total + _crossed(s, x0, y0, x, y))
    return (n < _THROUGH) & (F.col("__c.inside") != (n % 2 == 1))


def _within_lines(x: Column, y: Column) -> Column:
    """Left of both lines of the cell, or of either, as it asks."""
    def left(line: str) -> Column:
        x1, y1, x2, y2 = (F.col(f"__c.{line}{i}") for i in range(1, 5))
        return (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1) > 0

    kind = F.col("__c.kind")
    return (kind == WHOLE) | (left("a") & ((kind == EITHER) | left("b"))) | (
        (kind == EITHER) & left("b"))


def _routes(cells: DataFrame, sizes: dict[int, int]) -> tuple[int, DataFrame]:
    """A level, and (rx, ry, levels): the sizes of cells in use under each square of it.

    ``sizes`` has the number of cells by level. The level is the finest whose
    squares are not many more than the cells: larger cells count once for each
    square under them. ``levels`` has a bit for each size, in ascending order.
    """
    most = 2 * sum(sizes.values()) + 1000
    level = min(n for n in sizes if sum(
        k * 4 ** max(0, m - n) for m, k in sizes.items()) <= most)
    up = F.greatest(F.lit(level) - F.col("level"), F.lit(0))
    down = F.pow(F.lit(2.0), F.greatest(F.col("level") - level, F.lit(0))).cast("bigint")

    def squares(c: str) -> Column:
        first = F.floor(F.col(c) / F.pow(F.lit(2.0), up)).cast("bigint") * down
        return F.sequence(first, first + down - 1)

    place = (F.array_position(F.array(*[F.lit(n) for n in sorted(sizes)]), F.col("level")) - 1) % BITS
    squared = (cells.select("level", "cx", "cy")
               .select("level", "cy", F.explode(squares("cx")).alias("rx"))
               .select("level", "rx", F.explode(squares("cy")).alias("ry"))
               .select("rx", "ry", F.call_function(
                   "shiftleft", F.lit(1).cast("bigint"), place.cast("int")).alias("bit")))
    return level, squared.groupBy("rx", "ry").agg(F.bit_or("bit").alias("levels"))


def _cell_at(level: int | Column, c: Column) -> Column:
    side = F.pow(F.lit(2.0), level if isinstance(level, Column) else F.lit(level))
    return F.floor(c / side).cast("bigint")


def within(points: DataFrame, polygons: DataFrame, key: str, *, x: Column, y: Column,
           spread_by: list[str], way: str = "way", broadcast_bytes: int = BROADCAST_BYTES,
           task_rows: int = TASK_ROWS, same: tuple[str, str] | None = None) -> DataFrame:
    """Point columns and the key of each polygon strictly containing the point.

    ``same`` names a column of the points and a field of a struct key that must
    agree; it is part of the join key.

    Points on an edge are in no polygon. The cells table is measured once: up
    to ``broadcast_bytes`` it is broadcast, beyond that both sides are shuffled
    by cell with crowded cells salted.
    """
    near = candidates(points, polygons, key, x=x, y=y, spread_by=spread_by, way=way,
                      broadcast_bytes=broadcast_bytes, task_rows=task_rows, same=same)
    if near is None:
        return points.withColumn(key, F.lit(None).cast(polygons.schema[key].dataType)).limit(0)
    plain, crowded = near
    here = F.col("__x"), F.col("__y")
    found = plain.where(_within_lines(*here)).select(*[F.col(f"`{c}`") for c in points.columns], key)
    if crowded is None:
        return found
    return found.unionAll(crowded.where(_strictly_within(*here)).select(
        *[F.col(f"`{c}`") for c in points.columns], key))


def candidates(points: DataFrame, polygons: DataFrame, key: str, *, x: Column, y: Column,
               spread_by: list[str], way: str = "way", broadcast_bytes: int = BROADCAST_BYTES,
               task_rows: int = TASK_ROWS, same: tuple[str, str] | None = None,
               ) -> tuple[DataFrame, DataFrame | None] | None:
    """Pairs of a point and a polygon's cell around it, by what the cell asks of the point.

    Pairs that two lines settle, and pairs that need the cell's segments, if any
    cell does. None without a cell.
    """
    near = _near(stored(polygon_cells(polygons, key, way), "cells"), points, key, x, y, spread_by,
                 broadcast_bytes, task_rows, same)
    return None if near is None else near[:2]


def _near(cells: DataFrame, points: DataFrame, key: str, x: Column, y: Column,
          spread_by: list[str], broadcast_bytes: int, task_rows: int,
          same: tuple[str, str] | None = None, count: bool = False,
          ) -> tuple[DataFrame, DataFrame | None, DataFrame | None] | None:
    """``candidates`` by stored cells.

    With ``count`` the pairs leave out cells inside as a whole; these come third,
    as (key, n) with the number of points in the cell.
    """
    side = F.pow(F.lit(2.0), F.col("level"))
    # Powers of two as a cell's side: some hundred levels at the very most.
    sizes = cells.groupBy("level").agg(
        F.count("*").alias("n"), F.sum(F.lit(160) + F.size("segments") * 48).alias("bytes"),
        F.count_if(F.col("kind") == CROSSINGS).alias("crowded"),
        F.min(F.col("cx") * side).alias("xmin"), F.max((F.col("cx") + 1) * side).alias("xmax"),
        F.min(F.col("cy") * side).alias("ymin"), F.max((F.col("cy") + 1) * side).alias("ymax"),
    ).collect()
    if not sizes:
        return None
    # Where x and y are covering columns, these bounds reach the Parquet footer.
    x0, x1 = min(r["xmin"] for r in sizes), max(r["xmax"] for r in sizes)
    y0, y1 = min(r["ymin"] for r in sizes), max(r["ymax"] for r in sizes)
    located = points.withColumn("__x", x).withColumn("__y", y).where(
        F.col("__x").between(x0, x1) & F.col("__y").between(y0, y1))
    if sum(r["n"] * 4.0 ** r["level"] for r in sizes) > MANY * (x1 - x0) * (y1 - y0):
        located = dealt(located)
    small = sum(r["bytes"] for r in sizes) <= broadcast_bytes
    if len(sizes) == 1:
        located = located.withColumn("__level", F.lit(sizes[0]["level"]))
    else:
        level, routes = _routes(cells, {r["level"]: r["n"] for r in sizes})
        routes = routes.select(F.xxhash64("rx", "ry").alias("__route"),
                               F.struct("rx", "ry", "levels").alias("__r"))
        located = located.withColumn("__rx", _cell_at(level, F.col("__x"))).withColumn(
            "__ry", _cell_at(level, F.col("__y"))).withColumn(
            "__route", F.xxhash64("__rx", "__ry"))
        if small:  # there are not many more squares than cells
            located = located.join(F.broadcast(routes), "__route")
        else:
            located = join_spread(located, stored(routes, "routes"), "__route",
                                  spread_by=spread_by, task_rows=task_rows)
        located = located.where((F.col("__rx") == F.col("__r.rx"))
                                & (F.col("__ry") == F.col("__r.ry")))
        in_use = F.filter(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(n).alias("n"))
                                    for i, n in enumerate(sorted(r["level"] for r in sizes))]),
                          lambda s: F.getbit(F.col("__r.levels"), s["i"] % BITS) == 1)
        located = located.withColumn("__level", F.explode(
            F.transform(in_use, lambda s: s["n"]))).drop("__r", "__rx", "__ry", "__route")
    located = (located.withColumn("__px", _cell_at(F.col("__level"), F.col("__x")))
               .withColumn("__py", _cell_at(F.col("__level"), F.col("__y")))
               .withColumn("__cell", _cell(*[F.col(f"__{c}") for c in ("level", "px", "py")])))
    if same is not None:
        located = located.withColumn("__cell", F.struct("__cell", F.col(same[0]).alias("same")))

    heavy = None
    if count:
        held = stored(located.groupBy("__cell", "__level", "__px", "__py").agg(
            F.count("*").alias("__n")), "held")
        if not small:  # the counts tell which cells are crowded
            heavy = heavy_counted(held.select("__cell", "__n"), "__cell", task_rows)

    def met(kinds: Column, *fields: str) -> DataFrame:
        # What cells say stands in one column, so that no name of the points is taken twice.
        some = cells.where(kinds).select(key, F.col("cell").alias("__cell"), F.struct(
            "level", "cx", "cy", *fields).alias("__c"))
        if same is not None:
            some = some.withColumn("__cell", F.struct("__cell", F.col(key)[same[1]].alias("same")))
        if small:
            near = located.join(F.broadcast(some), "__cell")
        else:
            near = join_spread(located, some, "__cell", spread_by=spread_by, heavy=heavy,
                               task_rows=task_rows)
        return near.where((F.col("__px") == F.col("__c.cx")) & (F.col("__py") == F.col("__c.cy"))
                          & (F.col("__level") == F.col("__c.level")))

    crowded = F.col("kind") == CROSSINGS
    parted = ~crowded & (F.col("kind") != WHOLE) if count else ~crowded
    plain = met(parted, "kind", *_LINES)
    pairs = met(crowded, "inside", "segments") if any(r["crowded"] for r in sizes) else None
    if not count:
        return plain, pairs, None
    whole = cells.where(F.col("kind") == WHOLE).select(key, "level", "cx", "cy",
                                                       F.col("cell").alias("__cell"))
    if small:
        whole = held.join(F.broadcast(whole), "__cell")
    else:
        whole = join_spread(whole, held, "__cell", spread_by=[key], task_rows=task_rows)
    whole = whole.where((F.col("__px") == F.col("cx")) & (F.col("__py") == F.col("cy"))
                        & (F.col("__level") == F.col("level")))
    return plain, pairs, whole.select(key, F.col("__n").alias("n"))


def _fineness(points: DataFrame, polygons: DataFrame, way: str, x: Column,
              y: Column) -> tuple[float, int]:
    """How closely cells for counting cover a polygon, and about how many of them it may have.

    By the points that a polygon would hold if all lay evenly.
    """
    spread = points.select(x.alias("x"), y.alias("y")).agg(
        F.count("*").alias("n"), ((F.max("x") - F.min("x")) * (F.max("y") - F.min("y")))
        .alias("area")).first()
    boxes = append_bbox(polygons.select(way), way, "__box").agg(F.avg(
        (F.col("__box.xmax") - F.col("__box.xmin")) * (F.col("__box.ymax") - F.col("__box.ymin")))
        .alias("area")).first()
    area, box = spread["area"] or 0.0, boxes["area"] or 0.0
    if not (0 < area < math.inf and 0 <= box < math.inf):
        return COVER, CELLS
    border = math.sqrt(spread["n"] * min(1.0, box / area) / POINTS_A_CELL)
    border = max(BORDER[0], min(BORDER[1], border))
    return min(COVER, 1 + 6.5 / border), math.ceil(8 * border)


def tally(points: DataFrame, polygons: DataFrame, key: str, *, x: Column, y: Column,
          spread_by: list[str], way: str = "way", broadcast_bytes: int = BROADCAST_BYTES,
          task_rows: int = TASK_ROWS) -> DataFrame:
    """(key, n): the rows of ``within`` counted by key, without making those of whole cells."""
    cover, most = _fineness(points, polygons, way, x, y)
    cells = stored(polygon_cells(polygons, key, way, cover, most), "cells")
    near = _near(cells, points, key, x, y, spread_by, broadcast_bytes, task_rows, count=True)
    if near is None:
        return polygons.select(key, F.lit(0).cast("bigint").alias("n")).limit(0)
    plain, crowded, whole = near
    here, one = (F.col("__x"), F.col("__y")), F.lit(1).cast("bigint").alias("n")
    found = whole.unionAll(plain.where(_within_lines(*here)).select(key, one))
    if crowded is not None:
        found = found.unionAll(crowded.where(_strictly_within(*here)).select(key, one))
    return found.groupBy(key).agg(F.sum("n").alias("n"))


def counts_within(points: DataFrame, polygons: DataFrame, key: str, **kw) -> DataFrame:
    """Points per polygon, zeros included; one polygon may come as several rows."""
    n = tally(points, polygons, key, **kw)
    return (polygons.select(key).distinct().join(even(n), key, "left")
            .select(key, F.coalesce("n", F.lit(0)).alias("n")))
