"""Rings that touch, long rings, and unions by sides."""

import math
import random

import pytest
from pyspark.sql import functions as F

import shapes as g
from terrafold.functions import wkb
from terrafold.operators import load, rings, tagload

POINTS = "way_id bigint, points array<struct<x:double,y:double>>"


def relation(spark, ways):
    """Edges and points of ways given as (rel, way, role, corners)."""
    def node(p):
        return int(p[0] * 1000 + p[1])

    edges = spark.createDataFrame(
        [(r, w, role, node(p[0]), node(p[-1])) for r, w, role, p in ways],
        "rel_id bigint, way_id bigint, role string, first bigint, last bigint")
    points = spark.createDataFrame(
        [(w, [{"x": float(x), "y": float(y)} for x, y in p]) for _, w, _, p in ways], POINTS)
    return edges, points


def shapes(spark, ways):
    edges, points = relation(spark, ways)
    found = rings.polygons_of(rings.assemble(edges, points))
    return sorted((r["rel_id"], r["a"], r["orphan"]) for r in found.select(
        "rel_id", "orphan", wkb.planar_area("way").alias("a")).collect())


def closure(spark, ways):
    return {r["rel_id"]: (r["open_ends"], r["branches"], r["crossings"], r["touches"], r["closed"])
            for r in rings.ring_closure(*relation(spark, ways)).collect()}


EIGHT = [(1, 1, "outer", [(2, 2), (0, 2), (0, 0)]), (1, 2, "outer", [(2, 2), (2, 0), (0, 0)]),
         (1, 3, "outer", [(2, 2), (4, 2), (4, 4)]), (1, 4, "outer", [(4, 4), (2, 4), (2, 2)])]
SHELL = [(2, 5, "outer", [(2, 0), (4, 0), (4, 4)]), (2, 6, "outer", [(4, 4), (0, 4), (0, 0), (2, 0)])]
HOLE = [(2, 7, "inner", [(2, 0), (3, 1), (2, 2)]), (2, 8, "inner", [(2, 2), (1, 1), (2, 0)])]


def square_ways(rel, k, x, y):
    c = [(x - 1, y - 1), (x + 1, y - 1), (x + 1, y + 1), (x - 1, y + 1)]
    return [(rel, 1000 * rel + 10 * k + i, "outer", [c[i], c[(i + 1) % 4]]) for i in range(4)]


def moved(ways, rel, role="as it is"):
    return [(rel, 1000 * rel + w, r if role == "as it is" else role, p) for _, w, r, p in ways]


def touching():
    """By relation: its ways, the areas of its polygons, and what its closure says."""
    frame = [(1, 40, "outer", [(-9, -9), (9, -9), (9, 9), (-9, 9), (-9, -9)])]
    gap = [w for k, (x, y) in enumerate([(0, 2), (2, 0), (4, 2), (2, 4)])
           for w in square_ways(0, k, x, y)]
    lone = [(1, 20, "outer", [(50, 50), (60, 50)]), (1, 21, "outer", [(60, 50), (60, 60), (50, 50)])]
    across = [(2, 7, "inner", [(2, 0), (2, 2), (6, 2), (6, -2)]),
              (2, 8, "inner", [(6, -2), (2, -2), (2, 0)])]
    same = [(3, 1, "outer", [(0, 0), (4, 0), (4, 4)]), (3, 2, "outer", [(4, 4), (0, 0)]),
            (3, 3, "outer", [(0, 0), (2, 0), (2, -2)]), (3, 4, "outer", [(2, -2), (0, 0)])]
    odd = [(4, 11, "outer", [(0, 0), (4, 0)]), (4, 12, "outer", [(4, 0), (0, 0)]),
           (4, 13, "outer", [(0, 0), (0, 4)]), (4, 14, "inner", [(0, 0), (-4, 0)])]
    touch, closed = (0, 0, 0, 1, True), (0, 0, 0, 0, True)
    return {
        1: (moved(EIGHT, 1), [4.0, 4.0], touch),
        2: (moved(SHELL + HOLE, 2), [14.0], touch),
        3: (moved(SHELL + HOLE, 3, "outer"), [14.0], touch),       # the hole without its role
        4: (moved(SHELL + HOLE, 4, None), [14.0], touch),
        5: (moved(frame, 5) + moved(EIGHT, 5, "inner"), [18.0 ** 2 - 8.0], touch),
        6: (moved(gap, 6), [4.0] * 4, (0, 0, 0, 4, True)),         # the gap is no polygon
        7: (moved(SHELL + across, 7), [], (0, 0, 1, 0, False)),
        8: (moved(same, 8), [], (0, 1, 0, 0, False)),              # two leave in one direction
        9: (moved(odd, 9), [], (2, 1, 0, 0, False)),               # sides with odd numbers of ends
        10: (moved(EIGHT + lone, 10), [4.0, 4.0, 50.0], touch),
        11: (moved(lone, 11), [50.0], closed),
    }


def test_rings_that_touch_cross_and_branch(spark):
    cases = touching()
    ways = [w for case, _, _ in cases.values() for w in case]
    want = sorted((rel, a, False) for rel, (_, areas, _) in cases.items() for a in areas)
    assert shapes(spark, ways) == want
    assert closure(spark, ways) == {rel: said for rel, (_, _, said) in cases.items()}
    assert rings.ring_closure(relation(spark, EIGHT)[0]).first()["branches"] == 1  # no turns known


# ---------------------------------------------------------------- long rings

def circle(rel, n, first):
    """A ring of n short ways that run either way round, after a shuffle of their numbers."""
    rows = []
    for i in range(n):
        way = first + (i * 7919) % n
        a, b = rel * 10**6 + i, rel * 10**6 + (i + 1) % n
        rows.append((rel, way, "outer", *((a, b) if i % 3 else (b, a))))
    return rows


def links_of(rows):
    ends = {(r, w): (a, b) for r, w, _, a, b in rows}
    return ends


@pytest.mark.parametrize("long, kept", [(10, 10**6), (2, 8)])
def test_long_rings_are_contracted(spark, monkeypatch, long, kept):
    monkeypatch.setattr(rings, "LONG", long)
    monkeypatch.setattr(rings, "KEPT", kept)
    written = []
    plain = rings.stored

    def counted(df, name="step"):
        out = plain(df, name)
        if name in ("ring", "taken", "placed"):
            written.append((name, out.count()))
        return out

    monkeypatch.setattr(rings, "stored", counted)
    sizes = {1: 400, 2: 2, 3: 3, 4: 37, 5: 5}
    rows = [e for rel, n in sizes.items() for e in circle(rel, n, 10_000 * rel)]
    rows += [(1, 99_000 + i, "outer", 10**8 + i, 10**8 + i + 1) for i in range(50)]  # an open chain
    edges = spark.createDataFrame(
        rows, "rel_id bigint, way_id bigint, role string, first bigint, last bigint")
    placed = rings.ordered_rings(edges).collect()
    ends, by_ring = links_of(rows), {}
    for r in placed:
        by_ring.setdefault((r["rel_id"], r["ring"]), []).append(r)
    assert {rel: len(v) for (rel, _), v in by_ring.items()} == sizes
    for (rel, ring), ways in by_ring.items():
        ways.sort(key=lambda r: r["pos"])
        assert [r["pos"] for r in ways] == list(range(len(ways)))
        assert (ways[0]["way_id"], ways[0]["dir"]) == (ring, 0) and ring == min(r["way_id"] for r in ways)
        for here, there in zip(ways, ways[1:] + ways[:1]):
            assert ends[rel, here["way_id"]][1 - here["dir"]] == ends[rel, there["way_id"]][there["dir"]]
    if kept < 100 and long < 10:
        shrinking = [n for name, n in written if name == "ring"]
        assert all(b < a * 0.85 for a, b in zip(shrinking, shrinking[1:]) if a > 60)
        # A few rows a link, where doubling writes one for each of nine rounds.
        assert sum(n for _, n in written) < 9 * 2 * len(rows)
        assert sum(n for _, n in written) > 0


def test_a_short_relation_leaves_after_its_own_rounds(spark, monkeypatch):
    written = []
    plain = rings.stored

    def counted(df, name="step"):
        out = plain(df, name)
        if name == "links":
            written.append(out.count())
        return out

    monkeypatch.setattr(rings, "stored", counted)
    rows = circle(1, 64, 1000) + [e for rel in range(2, 40) for e in circle(rel, 4, 1000 * rel)]
    edges = spark.createDataFrame(
        rows, "rel_id bigint, way_id bigint, role string, first bigint, last bigint")
    rings.ordered_rings(edges).count()
    # Two rounds for the squares, six for the long ring, whose links alone go on.
    rounds = written[-6:]
    assert rounds[:2] == [2 * len(rows)] * 2 and rounds[2:] == [2 * 64] * 4


# ---------------------------------------------------------------- unions by sides

def union(spark, polygons):
    table = spark.createDataFrame([(r, bytearray(g.polygon(p))) for r, p in polygons],
                                  "region string, way binary")
    return {r["region"]: r.asDict() for r in rings.dissolve_sides(table, "region").collect()}


def test_neighbours_may_break_their_border_anywhere(spark):
    left = [(0, 0), (4, 0), (4, 1), (4, 4), (0, 4), (0, 0)]
    right = [(4, 0), (8, 0), (8, 4), (4, 4), (4, 3), (4, 2), (4, 0)]
    got = union(spark, [("r", [left]), ("r", [right]), ("s", [left])])
    assert (got["r"]["area"], got["r"]["n_parts"], got["r"]["closed"]) == (32.0, 1, True)
    assert got["s"]["area"] == 16.0


def test_a_union_keeps_its_holes_and_touching_parts(spark):
    frame = [[(0, 0), (3, 0), (3, 1), (0, 1), (0, 0)], [(0, 1), (1, 1), (1, 3), (0, 3), (0, 1)],
             [(2, 1), (3, 1), (3, 3), (2, 3), (2, 1)], [(1, 2), (2, 2), (2, 3), (1, 3), (1, 2)]]
    corner = [(3, 3), (4, 3), (4, 4), (3, 4), (3, 3)]
    got = union(spark, [("r", [p]) for p in frame] + [("r", [corner])])["r"]
    assert got["area"] == 9.0 and got["closed"] and got["touches"] == 1 and got["n_parts"] == 2
    assert math.isclose(got["bbox"]["xmax"], 4.0)


def test_sides_on_a_slant_are_parted_where_they_are_met(spark):
    big = [(0, 0), (6, 6), (0, 6), (0, 0)]
    small = [[(2, 2), (4, 4), (4, 2), (2, 2)], [(0, 0), (2, 2), (2, 0), (0, 0)]]
    got = union(spark, [("r", [big]), *(("r", [p]) for p in small)])["r"]
    assert got["area"] == 18.0 + 2.0 + 2.0 and got["closed"]
    assert union(spark, [("r", [big])])["r"]["ways"] == 3


def test_signed_area_tells_the_turn(spark):
    ring = [{"x": x, "y": y} for x, y in ((0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 0.0))]
    df = spark.createDataFrame([(1, ring), (2, ring[::-1])], POINTS)
    assert [r[0] for r in df.orderBy("way_id").select(rings.signed_area(F.col("points"))).collect()] == [
        2.0, -2.0]


def test_any_number_of_ends_at_a_node(spark):
    # Spokes round the middle by their roles: touching if neighbours of one side cancel out.
    rng = random.Random(7)
    words = ["oi" * 50, "oi" * 33 + "io" * 33, "o" * 40 + "i" * 40, "oo", "oioi", "oiio"]
    for n in (8, 30, 70, 120):
        for _ in range(3):  # pairs put in anywhere cancel out; two ends swapped may not
            word = ""
            while len(word) < n:
                at = rng.randrange(len(word) + 1)
                word = word[:at] + rng.choice(["oo", "ii"]) + word[at:]
            swapped = list(word)
            a, b = rng.sample(range(n), 2)
            swapped[a], swapped[b] = swapped[b], swapped[a]
            words += [word, "".join(swapped)]

    def left(word):
        out = []
        for side in word:
            out = out[:-1] if out and out[-1] == side else [*out, side]
        return out

    edges, points, want = [], [], {}
    for rel, word in enumerate(words):
        start = 2 * math.pi * rng.random()
        for k, side in enumerate(word):
            way, turn = 1000 * rel + k, start + 2 * math.pi * k / len(word)
            edges.append((rel, way, "inner" if side == "i" else "outer", -1, way))
            points.append((way, [{"x": 0.0, "y": 0.0}, {"x": math.cos(turn), "y": math.sin(turn)}]))
        crossed = 1 if left(word) else 0
        want[rel] = (0, crossed, 0 if crossed or len(word) < 3 else 1)
    found = rings.ring_closure(
        spark.createDataFrame(edges, "rel_id bigint, way_id bigint, role string, first bigint, last bigint"),
        spark.createDataFrame(points, POINTS)).collect()
    assert {r["rel_id"]: (r["branches"], r["crossings"], r["touches"]) for r in found} == want
    assert {v[1] for r, v in want.items() if len(words[r]) > 64} == {0, 1}


def test_forty_rings_that_touch_at_one_node(spark):
    # Wedges round the middle, two ways each: 80 ends meet there.
    def at(r, turn):
        return {"x": r * math.cos(turn), "y": r * math.sin(turn)}

    edges, points = [], []
    for k in range(40):
        a, b = (2 * math.pi * (k + f) / 40 for f in (0.0, 0.5))
        for i, (turn, way) in enumerate(((a, 2 * k), (b, 2 * k + 1))):
            edges.append((1, way, "outer", 0, 100 + k))
            middle = [at(1.0, turn)] if i else []
            points.append((way, [{"x": 0.0, "y": 0.0}, *middle, at(1.0, a)]))
    edges, points = spark.createDataFrame(
        edges, "rel_id bigint, way_id bigint, role string, first bigint, last bigint"), \
        spark.createDataFrame(points, POINTS)
    closed = rings.ring_closure(edges, points).first()
    assert (closed["branches"], closed["touches"], closed["closed"]) == (0, 1, True)
    found = rings.relation_rows(rings.polygons_of(rings.assemble(edges, points)))
    sizes = [r["a"] for r in found.select(wkb.planar_area("way").alias("a")).collect()]
    assert len(sizes) == 40
    assert sum(sizes) == pytest.approx(40 * math.sin(math.pi / 40) / 2)


def test_areas_of_a_relation_with_eighty_ends_at_a_node_are_loaded(spark):
    xy, members = {0: (0.0, 0.0)}, []
    refs, ways = [], []
    for k in range(40):
        for i in (0, 1):
            turn = 2 * math.pi * (k + i / 2) / 40
            xy[2 * k + i + 1] = (math.cos(turn), math.sin(turn))
        a, b = 2 * k + 1, 2 * k + 2
        for way, nodes in ((a, [0, a]), (b, [0, b, a])):
            ways.append(way)
            members.append((7, way, way, "w", "outer"))
            refs += [(way, i, n) for i, n in enumerate(nodes)]
    none = "map<string,string>"
    tables = load.load(
        spark.createDataFrame([(n, x, y, None) for n, (x, y) in xy.items()],
                              f"id bigint, x double, y double, tags {none}"),
        spark.createDataFrame([(w, None) for w in ways], f"id bigint, tags {none}"),
        spark.createDataFrame(refs, "way_id bigint, pos int, node_id bigint"),
        spark.createDataFrame([(7, {"type": "multipolygon", "amenity": "cafe"})],
                              f"id bigint, tags {none}"),
        spark.createDataFrame(members, "rel_id bigint, ref bigint, pos bigint, type string, role string"),
        [tagload.Rule(("node", "way"), "amenity", frozenset({"polygon"}))], {}, {})
    rows = tables["polygon"].select("osm_id", "amenity", "way_area").collect()
    assert [(r["osm_id"], r["amenity"]) for r in rows] == [(-7, "cafe")] * 40
    assert sum(r["way_area"] for r in rows) == pytest.approx(40 * math.sin(math.pi / 40) / 2, rel=1e-6)
