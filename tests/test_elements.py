import pytest
from pyspark.sql import functions as F

from terrafold.functions import wkb
from terrafold.operators import elements, features, rings, tagload
from terrafold.operators.elements import Elements


def snapshot(spark):
    """Way 1 crosses the box, way 2 passes over it without a node inside, way 3 is far."""
    nodes = spark.createDataFrame(
        [(1, 0.5, 0.5), (2, 5.0, 5.0), (3, -1.0, 0.5), (4, 2.0, 0.5), (5, 9.0, 9.0), (6, 0.2, 0.2)],
        "id bigint, lon double, lat double")
    ways = spark.createDataFrame([(1, [1, 2]), (2, [3, 4]), (3, [5, 2]), (4, [1, 1, 99])],
                                 "id bigint, nodes array<bigint>")
    relations = spark.createDataFrame(
        [(10, [("w", 1, "outer"), ("w", 3, "outer")]), (11, [("w", 2, "outer")]),
         (12, [("n", 6, "label")]), (13, [("n", 3, ""), ("w", 77, "")]), (14, [])],
        "id bigint, members array<struct<type:string,ref:bigint,role:string>>")
    return Elements.from_arrays(nodes, ways, relations)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


@pytest.mark.parametrize("task_rows", [1, 10**6])
def test_whole_ways_cut(spark, task_rows):
    cut = elements.cut_box(snapshot(spark), 0.0, 0.0, 1.0, 1.0, task_rows=task_rows)
    assert ids(cut.ways) == [1, 4]           # 2 has no node inside
    assert ids(cut.nodes) == [1, 2, 6]       # 2 comes with way 1; 99 is not in the snapshot
    assert ids(cut.relations) == [10, 12]
    assert cut.way_refs.count() == 5         # way 4 names node 1 twice
    assert cut.member_refs.count() == 3


def test_polygon_cut_equals_box_cut(spark):
    el = snapshot(spark)
    mask = spark.range(1).select(F.lit(1).alias("k"), wkb.make_box(
        F.lit(-0.001), F.lit(-0.001), F.lit(1.001), F.lit(1.001)).alias("way"))
    cut = elements.cut_polygon(el, mask, "k", x=F.col("lon"), y=F.col("lat"))
    assert (ids(cut.ways), ids(cut.nodes)) == ([1, 4], [1, 2, 6])


def test_closure_with_and_without_references(spark):
    el = snapshot(spark)
    some = el.relations.where("id = 10")
    full = elements.closure(el, some)
    assert (ids(full.ways), ids(full.nodes)) == ([1, 3], [1, 2, 5])
    bare = elements.closure(el, some, with_refs=False)
    assert (ids(bare.ways), ids(bare.nodes), ids(bare.relations)) == ([], [], [10])


def test_counts_include_relations_without_members(spark):
    info = {r["type"]: r for r in elements.element_info(snapshot(spark)).collect()}
    assert {k: v["n"] for k, v in info.items()} == {"node": 6, "way": 4, "relation": 5}
    assert (info["node"]["lon_min"], info["node"]["lat_max"]) == (-1.0, 9.0)


def test_coverage_drift_and_agreement(spark):
    want = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    have = spark.createDataFrame([("b",), ("b",), ("x",)], "name string")
    row = elements.coverage(want, have, "name").first()
    assert (row["n_found"], row["n_expected"], row["missing"]) == (1, 3, "a,c")
    drift = elements.id_drift(want, have, "name").first()
    assert (drift["n_ids"], drift["n_gone"]) == (3, 2)
    left = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("b", None), ("d", 3)], "k string, v int")
    assert sorted(r["k"] for r in elements.agreement(left, right, "k", "v").collect()) == ["c", "d"]


# ---------------------------------------------------------------- rings

def edges_of(spark, rows):
    return spark.createDataFrame(rows, "rel_id bigint, way_id bigint, role string, first bigint, last bigint")


def test_completeness_names_the_first_missing_in_member_order(spark):
    members = spark.createDataFrame(
        [(1, p, r) for p, r in enumerate([50, 9, 8, 7, 6, 5, 4, 3])] + [(2, 0, 50)],
        "rel_id bigint, pos int, ref bigint")
    ways = spark.createDataFrame([(50,)], "id bigint")
    for task_rows in (1, 10**6):
        got = {r["rel_id"]: r for r in rings.completeness(members, ways, task_rows=task_rows).collect()}
        assert (got[1]["missing"], got[1]["total"], got[1]["first_missing"]) == (7, 8, "9,8,7,6,5")
        assert (got[2]["missing"], got[2]["first_missing"]) == (0, "")
    totals = rings.completeness_totals(members, ways).first()
    assert (totals["present"], totals["wanted"]) == (1, 8)


def test_closure_sees_open_and_branching_rings(spark):
    edges = edges_of(spark, [
        (1, 1, "outer", 1, 2), (1, 2, "outer", 2, 1),                              # closed
        (2, 1, "outer", 1, 2), (2, 3, "outer", 2, 3),                              # open
        (3, 4, "outer", 1, 2), (3, 5, "outer", 2, 1), (3, 6, "outer", 2, 3), (3, 7, "outer", 3, 2),
        (4, 8, "outer", 5, 5)])                                                    # closed way
    got = {r["rel_id"]: (r["open_ends"], r["branches"], r["closed"])
           for r in rings.ring_closure(edges).collect()}
    assert got == {1: (0, 0, True), 2: (2, 0, False), 3: (0, 1, False), 4: (0, 0, True)}


@pytest.mark.parametrize("length", [2, 3, 7, 64, 100])
def test_rings_of_any_length_and_direction(spark, length):
    rows = []
    for i in range(length):
        a, b = i, (i + 1) % length
        rows.append((1, 1000 + (i * 37) % length if length not in (37, 74) else 1000 + i, "outer",
                     *((a, b) if i % 3 else (b, a))))
    rows.append((1, 5000, "outer", 900, 901))  # an open chain beside it
    placed = rings.ordered_rings(edges_of(spark, rows)).orderBy("pos").collect()
    assert len(placed) == length
    assert {r["ring"] for r in placed} == {1000}
    assert [r["pos"] for r in placed] == list(range(length))
    assert (placed[0]["way_id"], placed[0]["dir"]) == (1000, 0)
    ends = {r[1]: (r[3], r[4]) for r in rows}
    for here, there in zip(placed, placed[1:] + placed[:1]):
        out = ends[here["way_id"]][1 - here["dir"]]
        assert out == ends[there["way_id"]][there["dir"]]


def test_a_figure_eight_without_points_is_left_alone(spark):
    edges = edges_of(spark, [(1, 1, "outer", 1, 2), (1, 2, "outer", 2, 1),
                             (1, 3, "outer", 1, 4), (1, 4, "outer", 4, 1)])
    assert rings.ordered_rings(edges).count() == 0
    assert rings.ring_closure(edges).first()["branches"] == 1


def test_holes_go_to_the_smallest_shell_around_them(spark):
    def ring(c, half):
        return [(c - half, -half), (c + half, -half), (c + half, half), (c - half, half), (c - half, -half)]

    shapes = {1: ("outer", ring(0.0, 100.0)), 2: ("inner", ring(0.0, 60.0)), 3: ("outer", ring(0.0, 30.0)),
              4: ("inner", ring(0.0, 10.0)), 5: ("outer", ring(500.0, 10.0))}
    rows = [(1, k, role, 1, [{"x": x, "y": y} for x, y in pts]) for k, (role, pts) in shapes.items()]
    rows += [(2, 6, "outer", 1, [{"x": x, "y": y} for x, y in ring(0.0, 200.0)])]
    table = spark.createDataFrame(
        rows, "rel_id bigint, ring bigint, role string, ways int, points array<struct<x:double,y:double>>")
    got = rings.polygons_of(table).select("rel_id", "ring", wkb.planar_area("way").alias("a")).collect()
    assert {(r["rel_id"], r["ring"]): r["a"] for r in got} == {
        (1, 1): 200.0**2 - 120.0**2, (1, 3): 60.0**2 - 20.0**2, (1, 5): 400.0, (2, 6): 400.0**2}


def test_dissolve_keeps_the_outline_only(spark):
    ways = spark.createDataFrame([("r", 1, 10), ("r", 1, 11), ("r", 2, 11), ("r", 2, 12), ("s", 3, 12)],
                                 "region string, area_id int, way_id int")
    got = sorted((r["region"], r["way_id"]) for r in rings.outer_ways(ways, "region").collect())
    assert got == [("r", 10), ("r", 12), ("s", 12)]


def test_rings_without_a_role_and_orphaned_holes_are_not_lost(spark):
    def box(x1, y1, x2, y2):
        return [{"x": x, "y": y} for x, y in ((x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1))]

    rows = [(1, 1, None, 1, box(0.0, 0.0, 10.0, 10.0)), (1, 2, "inner", 1, box(0.0, 2.0, 4.0, 4.0)),
            (1, 3, "inner", 1, box(50.0, 50.0, 51.0, 51.0)), (2, 4, "outer", 1, box(40.0, 40.0, 60.0, 60.0))]
    table = spark.createDataFrame(
        rows, "rel_id bigint, ring bigint, role string, ways int, points array<struct<x:double,y:double>>")
    got = {(r["rel_id"], r["ring"]): (r["a"], r["orphan"]) for r in rings.polygons_of(table).select(
        "rel_id", "ring", "orphan", wkb.planar_area("way").alias("a")).collect()}
    # Hole 2 begins on the shell's edge; hole 3 lies only in a shell of another relation.
    assert got == {(1, 1): (92.0, False), (1, 3): (1.0, True), (2, 4): (400.0, False)}
    kept = rings.relation_rows(rings.polygons_of(table)).select("osm_id", "ring").collect()
    assert sorted(map(tuple, kept)) == [(-2, 4), (-1, 1)]


# ---------------------------------------------------------------- features

@pytest.mark.parametrize("salts", [1, 3, 64])
def test_regroup_gives_one_row_an_id_however_it_is_salted(spark, monkeypatch, salts):
    monkeypatch.setattr(features, "SALTS", salts)
    df = spark.range(10).select(F.lit(-7).cast("bigint").alias("osm_id"), wkb.make_box(
        F.col("id") * 10.0, F.lit(0.0), F.col("id") * 10.0 + 5, F.lit(5.0)).alias("way"))
    df = df.unionAll(df.limit(1).withColumn("way", F.lit(None).cast("binary")))
    whole = features.regroup(df).select("*", wkb.planar_area("way").alias("here"),
                                        wkb.envelope("way").alias("box")).collect()
    assert len(whole) == 1 and (whole[0]["n_parts"], whole[0]["area"]) == (10, 250.0)
    assert whole[0]["here"] == 250 and whole[0]["box"] == whole[0]["bbox"]
    monkeypatch.setattr(features, "VALUE_BYTES", 100)
    with pytest.raises(Exception, match="too large for one value: feature -7"):
        features.regroup(df).collect()


@pytest.mark.parametrize("partitions", [1, 7])
def test_parts_are_numbered_across_ranges(spark, partitions):
    df = spark.range(500).select(F.when(F.col("id") % 5 > 0, 1).otherwise(F.col("id")).alias("k"),
                                 (1000 - F.col("id")).alias("part"))
    df = df.unionAll(spark.createDataFrame([(None, 3), (None, 1)], "k bigint, part bigint"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = features.collect_parts(df, "k", "part").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    groups = {}
    for r in df.collect():
        groups.setdefault(r["k"], []).append(r["part"])
    want = [(k, i, len(v), p) for k, v in groups.items() for i, p in enumerate(sorted(v))]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


# ---------------------------------------------------------------- tag load

RULES = [("node,way", "amenity", "text", "polygon"), ("node,way", "natural", "text", "polygon"),
         ("way", "building", "text", "polygon"), ("node", "ele", "text", "linear"),
         ("way", "abandoned:building", "text", "polygon,nocolumn"), ("node,way", "note:*", "text", "delete"),
         ("node,way", "source", "text", "delete")]


def tag_rows(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                 "id int, kind string, is_closed boolean, tags map<string,string>")


def rules(spark):
    return tagload.rules_from(spark.createDataFrame(RULES, "kind string, pattern string, type string, flags string"))


def test_area_rules(spark):
    df = tag_rows(spark, ("way", True, {"amenity": "x"}), ("way", False, {"amenity": "x"}),
                  ("way", True, {"amenity": "x", "area": "no"}), ("way", True, {"foo": "x", "area": "yes"}),
                  ("way", True, {"natural": "coastline"}), ("way", True, {"natural": "wood"}),
                  ("way", True, {"abandoned:building": "yes"}), ("node", True, {"amenity": "x"}),
                  ("relation", True, {"building": "yes"}), ("way", True, {}))
    got = [r["shape"] for r in tagload.classify(df, rules(spark)).orderBy("id").collect()]
    assert got == ["polygon", "line", "line", "polygon", "line", "polygon", "polygon", "point",
                   "polygon", "line"]


def test_promotion_deletion_and_variants(spark):
    df = tag_rows(spark, ("node", False, {"ele": "5", "building": "yes", "note:ja": "n", "k:x": "1"}),
                  ("way", False, {"ele": "5", "building": "yes", "source": "s"}),
                  ("way", False, {"other": "1"}), ("way", False, {"source": "s"}))
    full = tagload.load_tags(df, rules(spark)).orderBy("id").collect()
    assert [r["id"] for r in full] == [0, 1, 2]      # nothing is left of the last one
    assert (full[0]["ele"], full[0]["building"]) == ("5", None)
    assert (full[1]["ele"], full[1]["building"]) == (None, "yes")
    assert full[0]["tags"] == {"building": "yes", "k:x": "1"}
    assert full[1]["tags"] == {"ele": "5"}
    matched = tagload.load_tags(df, rules(spark), keep="matched").collect()
    assert sorted(r["id"] for r in matched) == [0, 1]
    both = tagload.load_tags(df, rules(spark), tags="all").orderBy("id").collect()
    assert both[1]["tags"] == {"ele": "5", "building": "yes"}


def test_export_keeps_order_and_awkward_names(spark):
    df = spark.createDataFrame([(1, "7", {"b": "2", "a": 'q"1'}, bytearray(b"\x01"))],
                               "osm_id bigint, `addr:housenumber` string, tags map<string,string>, way binary")
    out = tagload.export_projection(df)
    assert out.columns == df.columns
    assert out.first()["tags"] == '{"a":"q\\"1","b":"2"}'
    with pytest.raises(ValueError, match="WKB"):
        tagload.export_projection(df.withColumn("way", F.lit("POINT")))


def test_tag_lookup_by_awkward_key(spark):
    df = spark.createDataFrame([('{"operator:en":"X","it\'s":"y"}',)], "tags string")
    row = df.select(features.tag("operator:en").alias("a"), features.tag("it's").alias("b")).first()
    assert (row["a"], row["b"]) == ("X", "y")
