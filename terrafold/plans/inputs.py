"""Spatial inputs derived from the given tables by integer arithmetic.

The given tables hold no geometry. Every input here is a projection of one of
them, so it grows with it. The SQL texts are read by both engines; geometry
bytes exist on the Spark side only, and the SQL twins use the integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions import wkb
from terrafold.operators import layout
from terrafold.operators.elements import Elements, way_points
from terrafold.operators.skew import dealt, even
from terrafold.workspace import new_path, stored

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# A query box in EPSG:3857 metres, and one in 1e-5 degrees for the elements.
BOX = (15540000, 4225000, 15550000, 4240000)
BOX5 = (13960000, 3555000, 13980000, 3575000)
# A diamond in the same 1e-5 degrees: centre and half axes.
DIAMOND5 = (13970000, 3565000, 15000, 12000)
ROWS_PER_GROUP = 2048

POINTS = """
SELECT event_id + 1 AS osm_id, concat('p', cast(user_id AS varchar(20))) AS name,
       CASE event_type WHEN 'click' THEN 'cafe' WHEN 'purchase' THEN 'restaurant'
                       WHEN 'view' THEN 'bank' WHEN 'signup' THEN 'school' END AS amenity,
       props AS tags,
       15523000 + (event_id * 7919 + user_id * 104729) % 63000 AS xi,
       4214000 + (event_id * 15485863 + user_id * 31) % 60000 AS yi
FROM {events}"""

WARDS = """
SELECT n_nationkey AS ward_id, concat(n_name, '区') AS name,
       15529300 + 12600 * (n_nationkey % 5) AS cx,
       4220000 + 12000 * cast(floor(n_nationkey / 5e0) AS int) AS cy, 6300 AS a, 6000 AS b
FROM {nation}"""

PARTS = """
SELECT -(1 + cast(floor(s_suppkey / 2e0) AS bigint)) AS osm_id, s_suppkey AS part_no,
       15523000 + s_suppkey % 1000 * 500 AS x1, 4214000 + (s_suppkey * 7919) % 50000 AS y1,
       15523000 + s_suppkey % 1000 * 500 + 200 + (s_suppkey % 7) * 10 AS x2,
       4214000 + (s_suppkey * 7919) % 50000
         + CASE WHEN s_suppkey % 50 = 7 THEN 15000 ELSE 300 END AS y2,
       CASE WHEN s_suppkey % 10 = 3 THEN cast('-0.0' AS float)
            WHEN s_suppkey % 10 = 4 THEN cast(NULL AS float)
            WHEN s_suppkey % 10 = 5 THEN cast('NaN' AS float)
            ELSE cast((200 + (s_suppkey % 7) * 10) * 300 AS float) END AS way_area
FROM {supplier}"""

# Admin areas: a box round each customer, with the tags of a boundary.
AREAS = """
SELECT -(c_custkey + 1) AS osm_id,
       concat(c_name, CASE c_custkey % 3 WHEN 0 THEN '区' WHEN 1 THEN '市' ELSE '町' END) AS name,
       CASE WHEN c_custkey % 7 = 3 THEN NULL ELSE 'administrative' END AS boundary,
       cast(5 + c_custkey % 4 AS varchar(4)) AS admin_level,
       CASE WHEN c_custkey % 2 = 0 THEN 'cafe' END AS amenity,
       15523000 + (c_custkey * 7919) % 63000 AS cx, 4214000 + (c_custkey * 104729) % 60000 AS cy,
       20 + c_custkey % 30 AS s
FROM {customer}"""

# Ways and areas of all sizes: a line of three nodes or a box round each customer, a tenth of
# them wider than a ward.
FEATURES = """
SELECT -(c_custkey + 1) AS osm_id, c_custkey % 3 = 0 AS is_line,
       CASE WHEN c_custkey % 2 = 0 THEN 'cafe' END AS amenity,
       15523000 + (c_custkey * 7919) % 63000 AS cx, 4214000 + (c_custkey * 104729) % 60000 AS cy,
       (20 + c_custkey % 30) * CASE c_custkey % 10 WHEN 0 THEN 300 WHEN 1 THEN 40
                                    WHEN 2 THEN 40 ELSE 1 END AS hx,
       (20 + c_custkey % 30) * CASE c_custkey % 10 WHEN 0 THEN 290 WHEN 1 THEN 9
                                    WHEN 2 THEN 60 ELSE 1 END AS hy
FROM {customer}"""

NODES = """
SELECT DISTINCT l_orderkey * 10 + l_linenumber AS node_id,
       13945000 + (l_orderkey * 7919 + l_linenumber * 977) % 57000 AS lon5,
       3538000 + (l_orderkey * 15485863 + l_linenumber * 613) % 54000 AS lat5
FROM {lineitem}"""

WAY_REFS = """
SELECT DISTINCT l_orderkey AS way_id, l_linenumber AS pos,
       l_orderkey * 10 + l_linenumber AS node_id
FROM {lineitem}"""

MEMBERS = """
SELECT o_custkey AS rel_id, o_orderkey AS pos, 'w' AS type, o_orderkey AS ref, 'outer' AS role
FROM {orders}"""

TAGGED = """
SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'node' ELSE 'way' END AS kind,
       p_partkey % 2 = 0 AS is_closed,
       concat(chr(123), '"name":"', p_name, '"',
         CASE WHEN p_size % 4 = 0 THEN ',"amenity":"cafe"' WHEN p_size % 4 = 1 THEN ',"highway":"service"'
              WHEN p_size % 4 = 2 THEN ',"building":"yes"' ELSE '' END,
         ',"operator:en":"', p_brand, '"',
         CASE WHEN p_size % 5 = 0 THEN ',"note:ja":"x"' ELSE '' END,
         CASE WHEN p_size % 7 = 0 THEN ',"source":"y"' ELSE '' END,
         CASE WHEN p_size % 6 = 0 THEN ',"area":"no"' ELSE '' END, chr(125)) AS tags
FROM {part}"""

# Ring members of a relation per customer: four sides of a square, a closed
# inner ring for every third, a second closed outer ring for every fifth; one
# side is missing from the snapshot for every fiftieth.
RING_MEMBERS = """
SELECT c_custkey + 1 AS rel_id, c_custkey * 10 + k AS ref, k AS pos, 'w' AS type,
       CASE WHEN k = 4 THEN 'inner' ELSE 'outer' END AS role, c_custkey AS c, k,
       20 + c_custkey % 30 AS s
FROM {customer_k}
WHERE k < 4 OR (k = 4 AND c_custkey % 3 = 0) OR (k = 5 AND c_custkey % 5 = 0)"""

# Areas on a grid 40 wide that share whole border ways with their neighbours.
GRID = """
SELECT c_custkey AS area_id, c_custkey % 40 AS i, cast(floor(c_custkey / 4e1) AS bigint) AS j
FROM {customer}"""
GRID_WAYS = """
SELECT area_id,
       cast(floor(i / 5e0) AS bigint) + 8 * cast(floor(j / 5e0) AS bigint) AS region,
       CASE k WHEN 0 THEN 2 * (j * 41 + i) WHEN 1 THEN 2 * ((j + 1) * 41 + i)
              WHEN 2 THEN 2 * (j * 41 + i) + 1 ELSE 2 * (j * 41 + i + 1) + 1 END AS way_id
FROM {grid_k}"""

# (kind, pattern, type, flags): a small rule set in the style of a tag load.
RULES = [
    ("node,way", "amenity", "text", "polygon"),
    ("node,way", "area", "text", "polygon"),
    ("way", "building", "text", "polygon"),
    ("node,way", "highway", "text", "linear"),
    ("node,way", "name", "text", "linear"),
    ("node", "ele", "text", "linear"),
    ("way", "tracktype", "text", "linear"),
    ("way", "abandoned:building", "text", "polygon,nocolumn"),
    ("node,way", "note:*", "text", "delete"),
    ("node,way", "source", "text", "delete"),
]

ALL = {"points": POINTS, "wards": WARDS, "parts": PARTS, "areas": AREAS, "nodes": NODES,
       "features": FEATURES, "way_refs": WAY_REFS, "members": MEMBERS, "tagged": TAGGED,
       "grid": GRID}
_NAMES = {t: t for t in TABLES}
_CUSTOMER_K = "(SELECT *, unnest(range(6)) AS k FROM customer) ck"
_GRID_K = "(SELECT *, unnest(range(4)) AS k FROM grid) gk"


def twin(name: str) -> str:
    """The SQL of an input, for the other engine."""
    if name == "ring_members":
        return RING_MEMBERS.format(customer_k=_CUSTOMER_K)
    if name == "grid_ways":
        return GRID_WAYS.format(grid_k=_GRID_K)
    return ALL[name].format(**_NAMES)


def with_inputs(*names: str) -> str:
    """WITH clause defining the named inputs."""
    return "WITH " + ", ".join(f"{n} AS ({twin(n)})" for n in names) + "\n"


# ---------------------------------------------------------------- Spark side

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = ALL[name]
    used = [t for t in TABLES if "{" + t + "}" in text]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})


def _each(df: DataFrame, n: int) -> DataFrame:
    # A row becomes many, so the few splits of a small table are dealt out first.
    return dealt(df).withColumn("k", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(n)])))


def ring_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RING_MEMBERS, customer_k=_each(table(spark, sf_dir, "customer"), 6))


def grid_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(GRID_WAYS, grid_k=_each(load(spark, sf_dir, "grid"), 4))


def point_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point feature table in its plain export form."""
    p = load(spark, sf_dir, "points")
    return p.select("osm_id", "name", "amenity", "tags",
                    wkb.make_point(F.col("xi").cast("double"), F.col("yi").cast("double"))
                    .alias("way"))


def ward_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = load(spark, sf_dir, "wards")
    return w.select("ward_id", "name", diamond("cx", "cy", "a", "b").alias("way"))


def holed_wards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wards, every third with a diamond a third as wide cut out of its middle."""
    def ring(part: int) -> Column:
        return diamond_ring("cx", "cy", f"a{part}", f"b{part}")

    w = load(spark, sf_dir, "wards").select("*", *[
        (F.col(c) / n).alias(f"{c}{n}") for c in "ab" for n in (1, 3)])
    rings = F.when(F.col("ward_id") % 3 == 0, F.array(ring(1), ring(3))).otherwise(F.array(ring(1)))
    return w.select("ward_id", "name", wkb.make_polygon_with_holes(rings).alias("way"))


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and boxes of all sizes."""
    f = load(spark, sf_dir, "features")

    def at(dx: int, dy: int) -> Column:
        return F.struct((F.col("cx") + F.col("hx") * dx).cast("double").alias("x"),
                        (F.col("cy") + F.col("hy") * dy).cast("double").alias("y"))

    line = wkb.make_line(F.array(at(-1, 0), at(0, 0), at(1, 0)))
    box = wkb.make_polygon(F.array(at(-1, -1), at(1, -1), at(1, 1), at(-1, 1), at(-1, -1)))
    return f.select("osm_id", "amenity", "is_line", line.alias("line"), box.alias("box")).select(
        "osm_id", "amenity", F.when(F.col("is_line"), F.col("line")).otherwise(F.col("box"))
        .alias("way"))


def diamond(cx: str, cy: str, a: str, b: str) -> Column:
    """Diamond polygon from centre and half axes, as the SQL twins assume it."""
    return wkb.make_polygon(diamond_ring(cx, cy, a, b))


def diamond_ring(cx: str, cy: str, a: str, b: str) -> Column:
    def corner(dx: Column, dy: Column) -> Column:
        return F.struct((F.col(cx) + dx).cast("double").alias("x"),
                        (F.col(cy) + dy).cast("double").alias("y"))

    zero = F.lit(0)
    east = corner(F.col(a), zero)
    return F.array(east, corner(zero, F.col(b)), corner(-F.col(a), zero),
                   corner(zero, -F.col(b)), east)


def part_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A polygon feature table: several rows per negated id, special float values."""
    p = load(spark, sf_dir, "parts")
    box = wkb.make_box(*[F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2")])
    return p.select("osm_id", "part_no", "way_area", box.alias("way"))


def area_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = load(spark, sf_dir, "areas")
    box = wkb.make_box(*[c.cast("double") for c in (
        F.col("cx") - F.col("s"), F.col("cy") - F.col("s"),
        F.col("cx") + F.col("s"), F.col("cy") + F.col("s"))])
    return a.select("osm_id", "name", "boundary", "admin_level", "amenity", "cx", "cy",
                    box.alias("way"))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load(spark, sf_dir, "tagged")
    return t.withColumn("tags", F.from_json("tags", "map<string,string>"))


_ELEMENTS: dict[tuple[str, str], Elements] = {}


def elements(spark: SparkSession, sf_dir: str) -> Elements:
    """The snapshot, its distinct rows worked out once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ELEMENTS:
        nodes = load(spark, sf_dir, "nodes").select(
            F.col("node_id").alias("id"), (F.col("lon5") / 1e5).alias("lon"),
            (F.col("lat5") / 1e5).alias("lat"), "lon5", "lat5")
        refs = load(spark, sf_dir, "way_refs")
        members = load(spark, sf_dir, "members")
        _ELEMENTS[key] = Elements(*[stored(df, "elements") for df in (
            nodes, refs.select(F.col("way_id").alias("id")).distinct(),
            members.select(F.col("rel_id").alias("id")).distinct(), refs, members)])
    return _ELEMENTS[key]


# Node numbers of the ring ways: three along each side, then the closed rings.
_RING_NODES = {0: [0, 12, 1], 1: [2, 13, 1], 2: [2, 14, 3], 3: [0, 15, 3],
               4: [4, 5, 6, 7, 4], 5: [8, 9, 10, 11, 8]}
# (x, y) of each node in units of (half side, fixed metres) round the centre.
_RING_XY = {0: (-1, -1), 1: (1, -1), 2: (1, 1), 3: (-1, 1),
            12: (0, -1), 13: (1, 0), 14: (0, 1), 15: (-1, 0)}
_INNER_XY = {4: (-5, -5), 5: (5, -5), 6: (5, 5), 7: (-5, 5)}
_SECOND_XY = {8: (190, -10), 9: (210, -10), 10: (210, 10), 11: (190, 10)}


def ring_way_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = ring_members(spark, sf_dir).where(~((F.col("k") == 2) & (F.col("c") % 50 == 7)))
    idx = F.lit(None).cast("array<int>")
    for k, nodes in _RING_NODES.items():
        idx = F.when(F.col("k") == k, F.array(*[F.lit(n) for n in nodes])).otherwise(idx)
    return m.select(F.col("ref").alias("way_id"), "c", F.posexplode(idx).alias("pos", "i")).select(
        "way_id", "pos", (F.col("c") * 20 + F.col("i")).alias("node_id"))


def ring_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = load(spark, sf_dir, "areas").select((-F.col("osm_id") - 1).alias("c"), "cx", "cy", "s")
    a = dealt(a).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(15))))
    x = y = F.lit(None).cast("double")
    for i, (dx, dy) in _RING_XY.items():
        x = F.when(F.col("i") == i, F.col("cx") + F.col("s") * dx).otherwise(x)
        y = F.when(F.col("i") == i, F.col("cy") + F.col("s") * dy).otherwise(y)
    for i, (dx, dy) in {**_INNER_XY, **_SECOND_XY}.items():
        x = F.when(F.col("i") == i, F.col("cx") + dx).otherwise(x)
        y = F.when(F.col("i") == i, F.col("cy") + dy).otherwise(y)
    return a.select((F.col("c") * 20 + F.col("i")).alias("id"), x.alias("x"), y.alias("y"))


# Corners of the ways of touching rings, in half units; a relation's kind is its number modulo 4.
_TOUCH = {
    0: [("outer", [(2, 2), (0, 2), (0, 0)]), ("outer", [(0, 0), (2, 0), (2, 2)]),
        ("outer", [(2, 2), (4, 2), (4, 4)]), ("outer", [(4, 4), (2, 4), (2, 2)])],
    1: [("outer", [(2, 0), (4, 0), (4, 4)]), ("outer", [(4, 4), (0, 4), (0, 0), (2, 0)]),
        ("inner", [(2, 0), (3, 1), (2, 2)]), ("inner", [(2, 2), (1, 1), (2, 0)])],
    3: [("outer", [(2, 0), (4, 0), (4, 4)]), ("outer", [(4, 4), (0, 4), (0, 0), (2, 0)]),
        ("inner", [(2, 0), (2, 2), (6, 2), (6, -2)]), ("inner", [(6, -2), (2, -2), (2, 0)])],
}
_TOUCH[2] = [("outer", way) for _, way in _TOUCH[1]]


def touching_rings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Edges and points of relations whose rings meet at a node, one per customer."""
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("rel_id"), (20 + F.col("c_custkey") % 30).alias("s"))
    ways = F.lit(None).cast("array<struct<role:string,xy:array<array<int>>>>")
    for kind, members in _TOUCH.items():
        ways = F.when(F.col("rel_id") % 4 == kind, F.array(*[
            F.struct(F.lit(role).alias("role"), F.array(*[
                F.array(F.lit(x), F.lit(y)) for x, y in way]).alias("xy"))
            for role, way in members])).otherwise(ways)
    w = dealt(c).select("rel_id", "s", F.posexplode(ways).alias("k", "w")).select(
        "rel_id", (F.col("rel_id") * 10 + F.col("k")).alias("way_id"), "w.role",
        F.transform("w.xy", lambda p: F.struct((p[0] * F.col("s")).cast("double").alias("x"),
                                               (p[1] * F.col("s")).cast("double").alias("y")))
        .alias("points"))
    edges = w.select("rel_id", "way_id", "role", F.element_at("points", 1).alias("first"),
                     F.element_at("points", -1).alias("last"))
    return edges, w.select("way_id", "points")


def grid_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid's areas as polygons by region; every second one has a corner amid each side."""
    g = load(spark, sf_dir, "grid").join(even(
        grid_ways(spark, sf_dir).select("area_id", "region").distinct()), "area_id")

    def at(dx: int, dy: int) -> Column:
        return F.struct((F.col("i") * 100 + dx).cast("double").alias("x"),
                        (F.col("j") * 100 + dy).cast("double").alias("y"))

    corners = [at(0, 0), at(100, 0), at(100, 100), at(0, 100), at(0, 0)]
    middles = [at(50, 0), at(100, 50), at(50, 100), at(0, 50)]
    more = F.array(*[p for pair in zip(corners, middles) for p in pair], corners[-1])
    plain, broken = wkb.make_polygon(F.array(*corners)), wkb.make_polygon(more)
    return g.select("region", "area_id", plain.alias("plain"), broken.alias("broken")).select(
        "region", F.when(F.col("area_id") % 2 == 0, F.col("broken")).otherwise(F.col("plain"))
        .alias("way"))


# ---------------------------------------------------------------- written tables

def line_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ways of the snapshot as lines, in the nodes' integer coordinates."""
    el = elements(spark, sf_dir)
    return way_points(el.way_refs, el.nodes, "lon5", "lat5").select(
        F.col("way_id").alias("osm_id"), wkb.make_line("points").alias("way"))


_PLAIN = {"points": point_table, "parts": part_table, "lines": line_table,
          "areas": lambda spark, sf_dir: area_table(spark, sf_dir).drop("cx", "cy")}
_STAGED: dict[tuple[str, str, str], tuple[str, str]] = {}


def staged(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str]:
    """Folders of the plain and the laid-out table, written once a session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        plain, laid = new_path(spark, f"{name}-plain"), new_path(spark, f"{name}-laid")
        _PLAIN[name](spark, sf_dir).write.option("compression", "zstd").parquet(plain)
        layout.relayout(spark, plain, laid, rows_per_group=ROWS_PER_GROUP)
        _STAGED[key] = (plain, laid)
    return _STAGED[key]


def laid_out(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(staged(spark, sf_dir, name)[1])
