"""Features against areas, nearest features, and the cells of polygons, by brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import shapes as g
from terrafold.operators import grid, nearest, relate, spatial


def shapes_of(spark, shapes, key="k"):
    return spark.createDataFrame([(k, bytearray(w) if w is not None else None) for k, w in shapes],
                                 f"{key} int, way binary")


# ---------------------------------------------------------------- cells

def diamonds(spark, n):
    rng = np.random.default_rng(7)
    rows = []
    for k in range(n):
        cx, cy = (int(v) for v in rng.integers(0, 63000, 2))
        h = int(rng.integers(20, 50)) * 60
        rows.append((k, g.polygon([[(cx + h, cy), (cx, cy + h), (cx - h, cy), (cx, cy - h), (cx + h, cy)]])))
    return shapes_of(spark, rows)


def scattered(spark, n):
    return spark.range(n).select(
        F.col("id").alias("osm_id"), (F.col("id") * 7919 % 63000).cast("double").alias("x"),
        (F.col("id") * 104729 % 63000).cast("double").alias("y"))


@pytest.mark.parametrize("broadcast", [0, 1 << 30])
def test_candidates_are_at_most_three_times_the_hits(spark, broadcast):
    points, polygons = scattered(spark, 3000), diamonds(spark, 400)
    kw = {"x": F.col("x"), "y": F.col("y"), "spread_by": ["osm_id"], "broadcast_bytes": broadcast}
    hits = spatial.within(points, polygons, "k", **kw).count()
    plain, crowded = spatial.candidates(points, polygons, "k", **kw)
    assert crowded is None  # a diamond's cells are half planes and wedges
    assert hits > 1000 and plain.count() <= 3 * hits


def test_points_are_looked_up_only_at_sizes_in_use_where_they_lie(spark):
    tiny = [(k, g.polygon([g.square(1000 + 3 * k, 1000, 1)])) for k in range(50)]
    huge = [(100 + k, g.polygon([g.square(1e6 + 1e5 * k, 1e6, 5e5)])) for k in range(3)]
    polygons = shapes_of(spark, tiny + huge)
    cells = spatial.polygon_cells(polygons, "k")
    sizes = {r["level"]: r["count"] for r in cells.groupBy("level").count().collect()}
    level, routes = spatial._routes(cells, sizes)
    assert len(sizes) > 2
    by_route = {(r["rx"], r["ry"]): {n for i, n in enumerate(sorted(sizes)) if r["levels"] >> i & 1}
                for r in routes.collect()}
    assert len(by_route) <= 2 * sum(sizes.values()) + 1000
    near_tiny = by_route[int(1000 // 2.0 ** level), int(1000 // 2.0 ** level)]
    far = by_route[int(9e5 // 2.0 ** level), int(9e5 // 2.0 ** level)]
    assert near_tiny & far == set() and near_tiny | far <= set(sizes)
    # Every cell is found by way of the square it lies in, or by all the squares in it.
    for r in cells.collect():
        at = (r["cx"] * 2.0 ** r["level"], r["cy"] * 2.0 ** r["level"])
        assert r["level"] in by_route[tuple(int(v // 2.0 ** level) for v in at)]


@pytest.mark.parametrize("ring", [
    [(0, 0), (10, 0), (10, 10), (5, 2), (0, 10), (0, 0)],       # a reflex corner
    [(0, 0), (5, 0), (10, 0), (10, 10), (0, 10), (0, 0)],       # a corner on a straight side
    [(0, 0), (16, 0), (16, 1), (0, 1), (0, 0)],                 # a strip
    [(0, 0), (12, 3), (3, 12), (0, 0)], [(0, 0), (8, 0), (4, 0.25), (0, 0)]])
def test_wedges_and_half_planes_are_exact(spark, ring):
    from test_spatial import brute

    xy = [(x / 4, y / 4) for x in range(-4, 70) for y in range(-4, 56)]
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)],
                                   "osm_id int, x double, y double")
    found = spatial.within(points, shapes_of(spark, [(1, g.polygon([ring]))]), "k", x=F.col("x"),
                           y=F.col("y"), spread_by=["osm_id"])
    assert sorted(r["osm_id"] for r in found.collect()) == brute(xy, [ring])


# ---------------------------------------------------------------- squares

def test_sides_lie_on_every_square_they_pass(spark):
    rng = np.random.default_rng(3)
    ends = [tuple(float(v) for v in rng.integers(-40, 40, 4)) for _ in range(300)]
    ends += [(0.0, 0.0, 0.0, 0.0), (8.0, 8.0, 8.0, -8.0), (-8.0, 4.0, 16.0, 4.0), (0.0, 0.0, 16.0, 16.0)]
    sides = spark.createDataFrame([(i, *e) for i, e in enumerate(ends)],
                                  "k int, x1 double, y1 double, x2 double, y2 double")
    got = {}
    rows = grid.on_squares(sides, 2).collect()
    for r in rows:
        got.setdefault(r["k"], set()).add((r["cx"], r["cy"]))
    assert sum(map(len, got.values())) == len(rows)  # each square once
    for i, (x1, y1, x2, y2) in enumerate(ends):
        t = np.linspace(0, 1, 2001)
        passed = set(zip(np.floor((x1 + t * (x2 - x1)) / 4).astype(int).tolist(),
                         np.floor((y1 + t * (y2 - y1)) / 4).astype(int).tolist()))
        assert passed <= got[i] and len(got[i]) <= 3 * len(passed) + 3


# ---------------------------------------------------------------- features and areas

def rings_of(shape):
    kind, rings = shape
    return rings if kind == "area" else [rings]


def sides_of(shape):
    return [(*a, *b) for ring in rings_of(shape) for a, b in zip(ring, ring[1:])]


def inside(x, y, sides):
    """1 strictly inside, 0 on the border, -1 outside, by a ray."""
    odd = False
    for x1, y1, x2, y2 in sides:
        cross = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
        if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return 0
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return 1 if odd else -1


def share_a_point(a, b):
    def turn(p, q, r):
        return np.sign((q[0] - p[0]) * (r[1] - p[1]) - (r[0] - p[0]) * (q[1] - p[1]))

    a1, a2, b1, b2 = a[:2], a[2:], b[:2], b[2:]
    boxes = all(max(a1[i], a2[i]) >= min(b1[i], b2[i]) and max(b1[i], b2[i]) >= min(a1[i], a2[i])
                for i in (0, 1))
    return boxes and turn(a1, a2, b1) * turn(a1, a2, b2) <= 0 and turn(b1, b2, a1) * turn(b1, b2, a2) <= 0


def brute_relate(features, areas):
    out = {}
    for k, f in features.items():
        nodes = [p for ring in rings_of(f) for p in (ring[:-1] if f[0] == "area" else ring)]
        for w, a in areas.items():
            own = sides_of(a)
            n = sum(inside(*p, own) == 1 for p in nodes)
            crosses = any(share_a_point(s, t) for s in sides_of(f) for t in own)
            holds = f[0] == "area" and any(inside(*ring[0], sides_of(f)) == 1 for ring in a[1])
            if n or crosses or holds:
                out[k, w] = (len(nodes), n, crosses, holds)
    return out


@pytest.mark.parametrize("broadcast, task_rows", [(1 << 30, 10**6), (0, 5)])
def test_relations_match_brute_force(spark, broadcast, task_rows):
    rng = np.random.default_rng(2)
    areas = {0: ("area", [g.square(0, 0, 40), g.square(0, 0, 12)]), 1: ("area", [g.square(60, 0, 20)]),
             2: ("area", [[(0, 50), (30, 90), (-30, 90), (0, 50)]]), 3: ("area", [g.square(5, 5, 1)])}
    features = {}
    for k in range(120):
        x, y = (int(v) for v in rng.integers(-70, 100, 2))
        if k % 3:
            features[k] = ("area", [g.square(x, y, int(rng.choice([1, 5, 30, 90])))])
        else:
            steps = rng.integers(-40, 40, (int(rng.integers(1, 5)), 2)).cumsum(0) + (x, y)
            features[k] = ("line", [(x, y), *(tuple(int(v) for v in p) for p in steps)])
    features[200] = ("area", [g.square(0, 0, 40)])                         # the border itself
    features[201] = ("area", [g.square(0, 0, 30), g.square(0, 0, 15)])     # round the hole
    features[202] = ("area", [g.square(0, 0, 5)])                          # in the hole
    features[203] = ("line", [(40, -100), (40, 100)])                      # along an edge

    def packed(shape):
        pts = [[(float(a), float(b)) for a, b in ring] for ring in rings_of(shape)]
        return g.polygon(pts) if shape[0] == "area" else g.line(pts[0])

    f = shapes_of(spark, [(k, packed(s)) for k, s in features.items()] + [(999, None)], "f")
    a = shapes_of(spark, [(k, packed(s)) for k, s in areas.items()] + [(99, None)], "a")
    pairs = relate.relate(f, a, "f", "a", broadcast_bytes=broadcast, task_rows=task_rows)
    got = {(r["f"], r["a"]): (r["nodes"], r["inside"], r["crosses"], r["holds"])
           for r in pairs.collect()}
    want = brute_relate(features, areas)
    assert got == want and len(got) == pairs.count()
    counts = {r["a"]: (r["any_node"], r["wholly"], r["meeting"])
              for r in relate.counts(pairs, "f", "a").collect()}
    assert counts == {w: (sum(v[1] > 0 for v in mine), sum(v[1] == v[0] and not v[2] and not v[3]
                                                           for v in mine), len(mine))
                      for w in {w for _, w in want} for mine in [[v for (_, x), v in want.items() if x == w]]}
    assert want[200, 0][1:] == (0, True, True) and (202, 0) not in want


def test_nothing_meets_nothing(spark):
    f = shapes_of(spark, [(1, g.line([(0.0, 0.0), (1.0, 1.0)]))], "f")
    none = shapes_of(spark, [(1, g.polygon([g.square(0, 0, 1)]))], "a")
    assert relate.relate(f, none.where("a < 0"), "f", "a").count() == 0
    assert relate.relate(f.where("f < 0"), none, "f", "a").count() == 0


# ---------------------------------------------------------------- nearest

def brute_nearest(points, features):
    out = {}
    for i, (x, y) in enumerate(points):
        best = []
        for k, sides in features:
            for x1, y1, x2, y2 in sides:
                dx, dy = x2 - x1, y2 - y1
                size, along = dx * dx + dy * dy, (x - x1) * dx + (y - y1) * dy
                if along <= 0:
                    d2 = (x - x1) ** 2 + (y - y1) ** 2
                elif along >= size:
                    d2 = (x - x2) ** 2 + (y - y2) ** 2
                else:
                    d2 = (dx * (y - y1) - dy * (x - x1)) ** 2 / size
                best.append((d2, k))
        out[i] = min(best)
    return out


def found_nearest(df):
    return {r["i"]: (r["distance"], r["k"], r["near_x"], r["near_y"]) for r in df.collect()}


@pytest.mark.parametrize("level, broadcast, task_rows", [(None, 10**6, 10**6), (4, 0, 50)])
def test_nearest_matches_brute_force(spark, level, broadcast, task_rows):
    rng = np.random.default_rng(9)
    features = []
    for k in range(60):  # a crowded corner, and a few far out
        x, y = (int(v) for v in (rng.integers(0, 300, 2) if k < 50 else rng.integers(-9000, 9000, 2)))
        if k % 3 == 0:
            features.append((k, g.point(float(x), float(y)), [(x, y, x, y)]))
        elif k % 3 == 1:
            ring = g.square(float(x), float(y), 4.0)
            features.append((k, g.polygon([ring]), [(*a, *b) for a, b in zip(ring, ring[1:])]))
        else:
            line = [(float(x), float(y)), (float(x + 200), float(y + 50)), (float(x), float(y + 90))]
            features.append((k, g.line(line), [(*a, *b) for a, b in zip(line, line[1:])]))
    features.append((3, *features[5][1:]))  # a feature of two rows
    points = [tuple(float(v) for v in p) for p in rng.integers(-50, 350, (150, 2))]
    points += [tuple(float(v) for v in p) for p in rng.integers(-20000, 20000, (60, 2))]
    points += [points[0], points[1], (1e6, -1e6)]
    table = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)]
                                  + [(-1, None, 1.0), (-2, float("nan"), 0.0), (-3, float("inf"), 0.0)],
                                  "i int, x double, y double")
    found = found_nearest(nearest.nearest(
        table, shapes_of(spark, [(k, w) for k, w, _ in features] + [(77, None)]), "k", x=F.col("x"),
        y=F.col("y"), level=level, broadcast=broadcast, task_rows=task_rows))
    want = brute_nearest(points, [(k, s) for k, _, s in features])
    assert set(found) == set(want)
    for i, (d2, k) in want.items():
        assert found[i][1] == k
        assert found[i][0] == pytest.approx(math.sqrt(d2), rel=1e-12, abs=1e-9)
        assert math.dist(points[i], found[i][2:]) == pytest.approx(found[i][0], rel=1e-9, abs=1e-9)


def test_ties_go_to_the_smaller_key(spark):
    features = shapes_of(spark, [(5, g.point(10.0, 0.0)), (2, g.point(-10.0, 0.0)), (9, g.point(0.0, 10.0))])
    points = spark.createDataFrame([(0, 0.0, 0.0)], "i int, x double, y double")
    for level in (None, 2):
        assert found_nearest(nearest.nearest(points, features, "k", x=F.col("x"), y=F.col("y"),
                                             level=level))[0][:2] == (10.0, 2)


def test_nearest_of_nothing(spark):
    features = shapes_of(spark, [(5, g.point(10.0, 0.0))])
    points = spark.createDataFrame([(0, 0.0, 0.0)], "i int, x double, y double")
    for p, f in ((points, features.where("k < 0")), (points.where("i > 0"), features)):
        none = nearest.nearest(p, f, "k", x=F.col("x"), y=F.col("y"))
        assert none.columns == ["i", "x", "y", "k", "distance", "near_x", "near_y"]
        assert none.count() == 0
