import numpy as np
import pytest
from pyspark.sql import functions as F

import shapes as g
from terrafold.operators import spatial
from terrafold.operators.skew import heavy_keys, join_spread


def polygons_of(spark, shapes):
    return spark.createDataFrame([(k, bytearray(w)) for k, w in shapes], "k int, way binary")


def points_of(spark, xy):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)],
                                 "osm_id bigint, x double, y double")


def found(df):
    return sorted((r["osm_id"], r["k"]) for r in df.collect())


def within(points, polygons, **kw):
    return spatial.within(points, polygons, "k", x=F.col("x"), y=F.col("y"),
                          spread_by=["osm_id"], **kw)


def brute(xy, rings):
    """Strictly inside by angle sum over whole rings, no cells."""
    out = []
    for i, (x, y) in enumerate(xy):
        odd = on = False
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                cross = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
                if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                    on = True
                if (y1 > y) != (y2 > y) and (x < x1 + (y - y1) * (x2 - x1) / (y2 - y1)):
                    odd = not odd
        if odd and not on:
            out.append(i)
    return out


def test_edges_vertices_and_holes_are_outside(spark):
    shapes = [(1, g.polygon([g.square(0, 0, 100), g.square(0, 0, 50)]))]
    xy = [(75, 0), (0, 0), (50, 0), (100, 0), (100, 100), (-100, -100), (75, 50), (101, 0), (-75, -75)]
    assert found(within(points_of(spark, xy), polygons_of(spark, shapes))) == [(0, 1), (6, 1), (8, 1)]


@pytest.mark.parametrize("segments, radius", [(7, 40), (60, 3000), (400, 120000)])
def test_stars_against_brute_force(spark, segments, radius):
    rng = np.random.default_rng(segments)
    angle = np.linspace(0, 2 * np.pi, segments, endpoint=False)
    r = radius * rng.uniform(0.3, 1.0, segments)
    ring = [(float(int(x)), float(int(y))) for x, y in zip(r * np.cos(angle), r * np.sin(angle))]
    ring.append(ring[0])
    hole = g.square(0, 0, radius // 10)
    xy = [(float(int(x)), float(int(y))) for x, y in rng.uniform(-radius, radius, (600, 2))]
    xy += ring + hole
    want = [(i, 5) for i in brute(xy, [ring, hole])]
    got = found(within(points_of(spark, xy), polygons_of(spark, [(5, g.polygon([ring, hole]))])))
    assert got == want
    assert len(want) > 50


def test_stars_in_degrees(spark):
    """The same in lon/lat, where a polygon is a fraction of a unit wide."""
    rng = np.random.default_rng(5)
    angle = np.linspace(0, 2 * np.pi, 300, endpoint=False)
    r = 0.2 * rng.uniform(0.3, 1.0, 300)
    ring = [(139.7 + float(x), 35.6 + float(y)) for x, y in zip(r * np.cos(angle), r * np.sin(angle))]
    ring.append(ring[0])
    xy = [(139.7 + float(x), 35.6 + float(y)) for x, y in rng.uniform(-0.2, 0.2, (600, 2))] + ring
    polygons = polygons_of(spark, [(5, g.polygon([ring]))])
    assert found(within(points_of(spark, xy), polygons)) == [(i, 5) for i in brute(xy, [ring])]
    cells = spatial.polygon_cells(polygons, "k").collect()
    assert max(len(c["segments"]) for c in cells) <= spatial.CELL_SEGMENTS


def comb(n):
    """A closed border of about n whole-numbered sides, many through cell corners."""
    rng = np.random.default_rng(n)
    x = np.arange(n // 2)
    top, low = rng.integers(1, 64, n // 2) * 8, -rng.integers(0, 64, n // 2) * 8
    ring = [(float(a * 4), float(b)) for a, b in zip(x, top)]
    ring += [(float(a * 4), float(b)) for a, b in zip(x[::-1], low[::-1])]
    return [*ring, ring[0]]


@pytest.mark.parametrize("most", [1, 3, 16])
def test_every_cell_knows_its_corner(most):
    ring = comb(200)
    seg = np.array([(*a, *b) for a, b in zip(ring, ring[1:])])
    rng = np.random.default_rng(most)
    xy = [(float(x), float(y)) for x, y in rng.integers([0, -512], [400, 512], (3000, 2))]
    want, got = set(brute(xy, [ring])), set()
    for c in spatial._cut(seg, np.array([0]), np.array([len(seg)]), most):
        ends = np.cumsum(c.counts)
        for i in range(len(c.cx)):
            size = 2.0 ** c.level[i]
            own = c.segments[ends[i] - c.counts[i]:ends[i]]
            for k, (x, y) in enumerate(xy):
                if (x // size, y // size) != (c.cx[i], c.cy[i]):
                    continue
                lo, hi = np.minimum(own[:, :2], own[:, 2:]), np.maximum(own[:, :2], own[:, 2:])
                on = (spatial._side(own, x, y) == 0) & (lo <= (x, y)).all(1) & ((x, y) <= hi).all(1)
                flips = spatial._flips(own, c.cx[i] * size, c.cy[i] * size, x, y).sum()
                if not on.any() and c.inside[i] != (flips % 2 == 1):
                    got.add(k)
    assert got == want and len(want) > 500


def test_cells_of_a_large_border_stay_small():
    ring = np.array(comb(100_000))
    seg = np.hstack([ring[:-1], ring[1:]])
    held = [c.counts for c in spatial._cut(seg, np.array([0]), np.array([len(seg)]))]
    assert max(h.max(initial=0) for h in held) <= spatial.CELL_SEGMENTS
    assert sum(len(h) for h in held) < len(seg)  # about as many cells as sides, not their square


def test_overlaps_levels_and_parts(spark):
    shapes = [(1, g.polygon([g.square(0, 0, 10)])), (2, g.polygon([g.square(0, 0, 50000)])),
              (3, g.multi(6, [g.polygon([g.square(0, 0, 5)]), g.polygon([g.square(100, 100, 5)])]))]
    xy = [(1, 1), (8, 8), (101, 101), (40000, -40000), (1e12, 0)]
    want = [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (2, 2), (2, 3), (3, 2)]
    assert found(within(points_of(spark, xy), polygons_of(spark, shapes))) == want


def test_shuffled_and_salted_join_gives_the_same_pairs(spark):
    rng = np.random.default_rng(11)
    crowd = [(500 + float(x), 500 + float(y)) for x, y in rng.integers(0, 60, (900, 2))]
    rest = [(float(x), float(y)) for x, y in rng.integers(-5000, 5000, (900, 2))]
    shapes = [(k, g.polygon([g.square(500 + 10 * k, 500, 40 + k)])) for k in range(12)]
    points, polygons = points_of(spark, crowd + rest), polygons_of(spark, shapes)
    plain = found(within(points, polygons))
    assert found(within(points, polygons, broadcast_bytes=0)) == plain
    assert found(within(points, polygons, broadcast_bytes=0, task_rows=20)) == plain
    assert len(plain) > 900


def test_no_polygon_and_zero_counts(spark):
    none = polygons_of(spark, [(1, g.polygon([g.square(0, 0, 1)]))]).where("k < 0")
    assert within(points_of(spark, [(0, 0)]), none).count() == 0
    shapes = [(1, g.polygon([g.square(0, 0, 10)])), (2, g.polygon([g.square(1000, 0, 10)]))]
    got = spatial.counts_within(points_of(spark, [(0, 0), (1, 1)]), polygons_of(spark, shapes), "k",
                                x=F.col("x"), y=F.col("y"), spread_by=["osm_id"])
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2), (2, 0)]


# ---------------------------------------------------------------- skew

@pytest.fixture
def lopsided(spark):
    """A third of the rows under one key, the rest under one each."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("key"),
        F.col("id").alias("row"))


def test_heavy_keys_are_counted_exactly(lopsided):
    heavy = heavy_keys(lopsided, ["key", "row"], task_rows=150)
    assert [tuple(r) for r in heavy["key"].collect()] == [(7, 7)]
    assert heavy["row"].isEmpty()
    assert heavy_keys(lopsided, ["key"])["key"].isEmpty()  # small groups are left alone
    twice = heavy_keys(lopsided.unionAll(lopsided), ["key"], task_rows=1)["key"]
    assert twice.count() == 2001  # no limit on keys


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_one(spark, lopsided, how):
    few = spark.createDataFrame([(7, "a"), (7, "b"), (101, "c"), (5, "d")], "key bigint, v string")
    salted = join_spread(lopsided, few, "key", how, spread_by=["row"], task_rows=10)
    plain = lopsided.join(few, "key", how)
    def rows(df):
        return sorted(str(r) for r in df.select(*plain.columns).collect())
    assert rows(salted) == rows(plain)


def test_salts_spread_the_heavy_key(spark, lopsided):
    few = spark.createDataFrame([(7, "a")], "key bigint, v string")
    joined = join_spread(lopsided, few, "key", spread_by=["row"], task_rows=10)
    assert "__salt" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" not in joined.columns
    with pytest.raises(ValueError, match="full"):
        join_spread(lopsided, few, "key", "full", spread_by=["row"])
