"""What must hold whatever size Spark takes a table for."""

import re

import numpy as np
from pyspark.sql import functions as F

import shapes as g
from terrafold.operators import layout, nearest, rings, spatial
from terrafold.plans import aggregates, scans
from terrafold.plans import inputs as I
from terrafold.sources import footer


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_of_rings_are_not_broadcast_by_file_size(spark):
    edges = spark.createDataFrame(
        [(r, r * 4 + k, "outer", r * 4 + k, r * 4 + (k + 1) % 4) for r in range(3) for k in range(4)],
        "rel_id bigint, way_id bigint, role string, first bigint, last bigint")
    xy = {0: (0.0, 0.0), 1: (1.0, 0.0), 2: (1.0, 1.0), 3: (0.0, 1.0)}
    points = spark.createDataFrame(
        [(r * 4 + k, [xy[k], xy[(k + 1) % 4]]) for r in range(3) for k in range(4)],
        "way_id bigint, points array<struct<x:double,y:double>>")
    made = rings.assemble(edges, points)
    closed = rings.ring_closure(edges, points)
    for df in (made, closed, rings.polygons_of(made)):
        assert "SortMergeJoin" in plan_of(df)
        assert "BroadcastHashJoin" not in plan_of(df)
    assert made.count() == 3
    assert closed.where("closed").count() == 3


def test_nearest_broadcasts_few_squares_only():
    # Widened ninefold, a level's squares stay some ten megabytes on the driver.
    assert 9 * nearest.BROADCAST_SQUARES * 24 < 16 << 20


def point_events(spark, path, n):
    spark.range(n).select(
        F.col("id").alias("event_id"), (F.col("id") % 97).alias("user_id"),
        F.when(F.col("id") % 2 == 0, "click").otherwise("view").alias("event_type"),
        F.lit("{}").alias("props")).coalesce(2).write.parquet(f"{path}/events.parquet")


def test_a_file_holds_a_bounded_number_of_rows_and_groups_go_on(spark, tmp_path, monkeypatch):
    n, one, many = 3 * I.ROWS_PER_GROUP + 500, str(tmp_path / "one"), str(tmp_path / "many")
    point_events(spark, one, n)
    point_events(spark, many, n)

    def seen(path):
        columns = ["row_group", "xmin", "ymin", "xmax", "ymax"]
        groups = aggregates._point_groups(spark, path).select("rows", *columns).orderBy(
            "row_group").collect()
        files = footer.files(footer.chunks(spark, I.staged(spark, path, "points")[1])).count()
        rows = I.laid_out(spark, path, "points").orderBy("osm_id").collect()
        return groups, rows, scans.geo_footer(spark, path).collect(), files

    whole = seen(one)
    monkeypatch.setattr(layout, "FILE_ROWS", I.ROWS_PER_GROUP)
    parted = seen(many)
    assert (whole[3], parted[3]) == (1, 4)
    assert parted[:3] == whole[:3]
    assert len(parted[2]) == 1
    laid = I.staged(spark, many, "points")[1]
    assert layout.order_violations(spark, laid).first()["violations"] == 0


def test_evened_files_keep_the_order_of_repeated_rows(spark, tmp_path):
    rows = spark.range(50).select(
        F.lit(7).cast("bigint").alias("osm_id"),
        F.unhex(F.lit("0101000000" + np.array([1.0, 2.0]).tobytes().hex())).alias("way"))
    plain, laid = str(tmp_path / "plain"), str(tmp_path / "laid")
    rows.write.parquet(plain)
    layout.write_ordered(layout.append_bbox(spark.read.parquet(plain)), laid, "{}", 10, 3, even=True)
    sizes = footer.groups(footer.chunks(spark, laid)).select("rows").collect()
    assert sorted(r["rows"] for r in sizes) == [10] * 5


def test_counting_makes_no_pairs_of_points_and_whole_cells(spark):
    n, side = 4000, 1000.0
    rng = np.random.default_rng(3)
    points = spark.createDataFrame(
        [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.integers(0, int(side), (n, 2)))]
        + [(None, 500.0, 500.0), (1, None, 2.0)], "osm_id bigint, x double, y double")

    def diamond(x, y, a):
        return [(x + a, y), (x, y + a), (x - a, y), (x, y - a), (x + a, y)]

    hole = [[(100, 100), (900, 100), (900, 900), (100, 900), (100, 100)], diamond(500, 500, 200)[::-1]]
    shapes = [(k, bytearray(g.polygon([diamond(500 + 7 * k, 480, 300 + k)]))) for k in range(6)] + [
        (6, bytearray(g.polygon(hole))), (0, bytearray(g.polygon([diamond(200, 200, 50)]))),
        (8, bytearray(g.polygon([diamond(5000, 5000, 5)]))), (9, None),
        (None, bytearray(g.polygon([diamond(300, 300, 100)])))]
    areas = spark.createDataFrame(shapes, "k int, way binary")
    at = {"x": F.col("x"), "y": F.col("y"), "spread_by": ["osm_id"]}
    pairs = spatial.within(points, areas, "k", **at)
    want = {r["k"]: r["count"] for r in pairs.groupBy("k").count().collect()}
    for size in ({}, {"broadcast_bytes": 0, "task_rows": 50}):
        got = spatial.tally(points, areas, "k", **at, **size).collect()
        assert {r["k"]: r["n"] for r in got} == want
        assert len(got) == len(want)
    cells = spatial.polygon_cells(areas, "k", "way", 1.15, 400).localCheckpoint()
    tested, crowded, whole = spatial._near(cells, points, "k", F.col("x"), F.col("y"), ["osm_id"],
                                           1 << 25, 1000, count=True)
    plain, more = spatial.candidates(points, areas, "k", **at)

    def rows(*found):
        return sum(df.count() for df in found if df is not None)
    assert whole.count() > 0
    assert rows(tested, crowded) < 0.6 * rows(plain, more)


def test_nearest_chooses_among_the_sides_at_the_least_distance(spark):
    rng = np.random.default_rng(5)
    ends = rng.integers(0, 64, (60, 4)).astype(float)
    sides = spark.createDataFrame([(k, *map(float, e)) for k, e in enumerate(ends)],
                                  "k int, x1 double, y1 double, x2 double, y2 double")
    places = [(float(x), float(y)) for x, y in rng.integers(0, 64, (40, 2))]
    pyramid = nearest.Pyramid(sides, "k", 64.0, level=2, broadcast=0)
    top = pyramid.levels[-1]
    assert top > pyramid.bottom
    found = pyramid.search({top: spark.createDataFrame(
        [((x, y), float("inf"), 0, 0) for x, y in places],
        "__point struct<x:double,y:double>, bound double, cx bigint, cy bigint")})
    plan = plan_of(found)
    # Only pairs at the least distance are sorted by point.
    assert re.search(r"Filter .*d2\S* <=> least", plan)

    def d2(x, y, x1, y1, x2, y2):
        size = (x2 - x1) ** 2 + (y2 - y1) ** 2
        t = min(1.0, max(0.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / size)) if size else 0
        return (x - x1 - t * (x2 - x1)) ** 2 + (y - y1 - t * (y2 - y1)) ** 2
    got = {(r["__point"]["x"], r["__point"]["y"]): r["d2"] for r in found.collect()}
    assert set(got) == set(places)
    for at, best in got.items():
        assert abs(best - min(d2(*at, *e) for e in ends)) < 1e-9
