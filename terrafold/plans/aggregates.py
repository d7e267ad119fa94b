"""Aggregations over features, elements, rings and footers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrafold.functions import wkb
from terrafold.operators import digest, elements, features, layout, relate, rings, spatial
from terrafold.operators.skew import even
from terrafold.plans import inputs as I
from terrafold.plans.joins import WITHIN
from terrafold.plans.registry import query
from terrafold.plans.scans import CHECKED_DIR
from terrafold.sources import footer


@query("element_info", I.with_inputs("nodes", "way_refs", "members") + """
SELECT 'node' AS type, count(*) AS n, min(lon5 / 1e5) AS lon_min, min(lat5 / 1e5) AS lat_min,
       max(lon5 / 1e5) AS lon_max, max(lat5 / 1e5) AS lat_max FROM nodes UNION ALL
SELECT 'way', count(DISTINCT way_id), NULL, NULL, NULL, NULL FROM way_refs UNION ALL
SELECT 'relation', count(DISTINCT rel_id), NULL, NULL, NULL, NULL FROM members""")
def element_info(spark, sf):
    return elements.element_info(I.elements(spark, sf))


@query("table_extent", I.with_inputs("parts") + """
SELECT min(x1)::double AS xmin, min(y1)::double AS ymin, max(x2)::double AS xmax, max(y2)::double AS ymax
FROM parts""")
def table_extent(spark, sf):
    return layout.table_extent(I.laid_out(spark, sf, "parts"))


@query("geometry_types", """
SELECT 'Point' AS geometry_type, count(*) AS n FROM events UNION ALL
SELECT 'Polygon', count(*) FROM supplier""")
def geometry_types(spark, sf):
    both = I.point_table(spark, sf).select("way").union(I.part_table(spark, sf).select("way"))
    return layout.geometry_types(both)


@query("table_digest")
def table_digest(spark, sf):
    """The digest of a table and of its relayout; equal rows mean equal tables."""
    plain, laid = I.staged(spark, sf, "parts")
    old = spark.read.parquet(plain)
    new = spark.read.parquet(laid).select(*old.columns)
    return digest.table_digest(old).select(F.lit("plain").alias("source"), "*").union(
        digest.table_digest(new).select(F.lit("laid out"), "*"))


@query("digest_outcomes", """
SELECT 'relayout' AS change, true AS same UNION ALL SELECT 'absolute area', false UNION ALL
SELECT 'one row twice', false UNION ALL SELECT 'nulls moved', false""")
def digest_outcomes(spark, sf):
    """Whether the digest tells a changed table from the original."""
    plain, laid = I.staged(spark, sf, "parts")
    old = spark.read.parquet(plain)
    last = old.agg(F.max("part_no")).first()[0]
    changed = {
        "relayout": spark.read.parquet(laid).select(*old.columns),
        "absolute area": old.withColumn("way_area", F.abs("way_area")),
        "one row twice": old.withColumn("part_no", F.when(F.col("part_no") == last, 0)
                                        .otherwise(F.col("part_no"))),
        "nulls moved": old.withColumn("osm_id", F.when(F.col("way_area").isNotNull(), F.col("osm_id"))),
    }
    base = digest.table_digest(old)
    out = None
    for name, df in changed.items():
        both = base.union(digest.table_digest(df))
        row = both.agg((F.count_distinct("n_rows", "hash_sum", "hash_xor") == 1).alias("same")).select(
            F.lit(name).alias("change"), "same")
        out = row if out is None else out.union(row)
    return out


@query("float_specials", I.with_inputs("parts") + """
SELECT 'way_area' AS "column", count(*) FILTER (WHERE cast(way_area AS varchar) = '-0.0') AS minus_zero,
       count(*) FILTER (WHERE isnan(way_area)) AS nan FROM parts""")
def float_specials(spark, sf):
    return digest.float_specials(spark.read.parquet(I.staged(spark, sf, "parts")[0]))


def laid_groups_twin() -> str:
    """CTEs ending in ``grp``: the row groups a one-file layout of the points must have."""
    from terrafold.plans.oracle import hilbert

    return (I.with_inputs("points") + ", "
            + hilbert("points", "xi", "yi", "osm_id, xi, yi, amenity") + f""",
placed AS (SELECT *, row_number() OVER (ORDER BY hkey, osm_id) - 1 AS pos FROM curve),
grp AS (SELECT cast(floor(pos / {I.ROWS_PER_GROUP}e0) AS int) AS row_group, count(*) AS "rows",
          min(xi)::double AS xmin, min(yi)::double AS ymin, max(xi)::double AS xmax, max(yi)::double AS ymax,
          min(amenity) AS lo, max(amenity) AS hi FROM placed GROUP BY 1)
""")


def _point_groups(spark, sf):
    """Row groups, numbered through the files in table order."""
    chunks = footer.chunks(spark, I.staged(spark, sf, "points")[1])
    upto = F.sum("num_row_groups").over(Window.orderBy("path"))  # one row a file
    starts = footer.files(chunks).select("path", (upto - F.col("num_row_groups")).alias("start"))
    return footer.groups(chunks).join(F.broadcast(starts), "path").withColumn(
        "row_group", (F.col("row_group") + F.col("start")).cast("int"))


@query("rowgroup_bbox", laid_groups_twin() + "SELECT row_group, xmin, ymin, xmax, ymax FROM grp")
def rowgroup_bbox(spark, sf):
    return _point_groups(spark, sf).select("row_group", "xmin", "ymin", "xmax", "ymax")


@query("rowgroup_sizes", laid_groups_twin() + 'SELECT row_group, "rows", true AS has_bytes FROM grp')
def rowgroup_sizes(spark, sf):
    return _point_groups(spark, sf).select("row_group", "rows", (F.col("bytes") > 0).alias("has_bytes"))


@query("rows_per_group", " UNION ALL ".join(f"""
SELECT '{t}' AS "table", sum(total_uncompressed_size)::bigint AS uncompressed, max(n)::bigint AS "rows",
  greatest(cast(floor(floor(4194304 / (sum(total_uncompressed_size) / max(n)::double + 32)) / 2048) * 2048
    AS bigint), 2048) AS rows_per_group
FROM parquet_metadata('{CHECKED_DIR}/{t}.parquet'),
     (SELECT num_rows AS n FROM parquet_file_metadata('{CHECKED_DIR}/{t}.parquet')) f"""
    for t in I.TABLES))
def rows_per_group(spark, sf):
    out = None
    for t in I.TABLES:
        row = footer.planned_rows(footer.chunks(spark, f"{sf}/{t}.parquet")).select(
            F.lit(t).alias("table"), "*")
        out = row if out is None else out.union(row)
    return out


@query("cardinality_gate", I.with_inputs("areas") + """
SELECT count(DISTINCT name) AS found, count(*) AS expected, count(DISTINCT name) = count(*) AS ok
FROM areas WHERE boundary = 'administrative'""")
def cardinality_gate(spark, sf):
    """As many distinct admin areas as area rows."""
    a = I.load(spark, sf, "areas").where(F.col("boundary") == "administrative")
    return elements.cardinality_gate(a, "name", F.count("*"))


@query("collect_parts", I.with_inputs("parts") + """
SELECT osm_id, row_number() OVER (PARTITION BY osm_id ORDER BY part_no) - 1 AS place,
       count(*) OVER (PARTITION BY osm_id) AS n_parts, part_no FROM parts""")
def collect_parts(spark, sf):
    """The parts of each id in order, a row each."""
    return features.collect_parts(I.load(spark, sf, "parts"), "osm_id", "part_no")


@query("multipolygon_regroup", I.with_inputs("parts") + """
SELECT osm_id, count(*) AS n_parts, sum((x2 - x1)::double * (y2 - y1)) AS area, min(x1)::double AS xmin,
       min(y1)::double AS ymin, max(x2)::double AS xmax, max(y2)::double AS ymax, 'MultiPolygon' AS kind,
       true AS box_agrees, true AS area_agrees
FROM parts GROUP BY osm_id""")
def multipolygon_regroup(spark, sf):
    """One feature per id: its own figures, and whether the regrouped geometry agrees."""
    m = features.regroup(I.laid_out(spark, sf, "parts"))
    return m.select("osm_id", "n_parts", "area", "bbox.*",
                    wkb.geometry_kind(F.col("way")).alias("kind"),
                    (wkb.envelope("way") == F.col("bbox")).alias("box_agrees"),
                    (F.abs(wkb.planar_area("way") - F.col("area")) < 1e-6).alias("area_agrees"))


# g grows from 0 in a ward's middle to top on its border; a hole ends at a third of that.
_IN_WARD = "abs({x} - w.cx) * w.b + abs({y} - w.cy) * w.a"


@query("nwr_counts", I.with_inputs("points", "features", "wards") + f""",
w AS (SELECT *, a * b AS top, CASE WHEN ward_id % 3 = 0 THEN a * b / 3e0 ELSE -1 END AS hole FROM wards),
n AS (SELECT w.ward_id, count(*) AS n FROM points p JOIN w
      ON {_IN_WARD.format(x='p.xi', y='p.yi')} < w.top AND {_IN_WARD.format(x='p.xi', y='p.yi')} > w.hole
      WHERE p.amenity = 'cafe' GROUP BY 1),
f AS (SELECT osm_id, cx - hx AS x1, cx + hx AS x2, CASE WHEN is_line THEN cy ELSE cy - hy END AS y1,
             CASE WHEN is_line THEN cy ELSE cy + hy END AS y2, is_line, cx AS mx
      FROM features WHERE amenity = 'cafe'),
g AS (SELECT w.ward_id, w.top, w.hole, is_line,
        {_IN_WARD.format(x='least(greatest(w.cx, x1), x2)', y='least(greatest(w.cy, y1), y2)')} AS low,
        [{', '.join(_IN_WARD.format(x=x, y=y) for x in ('x1', 'x2') for y in ('y1', 'y2'))}] AS corners,
        {_IN_WARD.format(x='mx', y='y1')} AS middle
      FROM f, w),
j AS (SELECT *, CASE WHEN is_line THEN list_append(corners, middle) ELSE corners END AS vals FROM g),
r AS (SELECT ward_id,
        count(*) FILTER (len(list_filter(vals, lambda v: v > hole AND v < top)) > 0) AS any_node,
        count(*) FILTER (low > hole AND list_max(vals) < top) AS wholly,
        count(*) FILTER (low <= top AND list_max(vals) >= hole) AS meeting
      FROM j GROUP BY ward_id)
SELECT ward_id, coalesce(n, 0) AS nodes, coalesce(n, 0) + any_node AS all_elements,
       coalesce(n, 0) + wholly AS inside_elements, coalesce(n, 0) + meeting AS meeting_elements
FROM r LEFT JOIN n USING (ward_id)""")
def nwr_counts(spark, sf):
    """Cafes per ward: as points, with the lines and areas that have a node inside, with those
    wholly inside, and with all that meet it. Some wards have holes, some areas hold wards."""
    wards = I.holed_wards(spark, sf)
    cafe = F.col("amenity") == "cafe"
    points = I.laid_out(spark, sf, "points").where(cafe).select(
        "osm_id", F.col("bbox.xmin").alias("x"), F.col("bbox.ymin").alias("y"))
    nodes = spatial.counts_within(points, wards, "ward_id", x=F.col("x"), y=F.col("y"),
                                  spread_by=["osm_id"])
    pairs = relate.relate(I.feature_table(spark, sf).where(cafe), wards, "osm_id", "ward_id")
    found = nodes.join(relate.counts(pairs, "osm_id", "ward_id"), "ward_id", "left").na.fill(0)
    return found.select("ward_id", F.col("n").alias("nodes"),
                        (F.col("n") + F.col("any_node")).alias("all_elements"),
                        (F.col("n") + F.col("wholly")).alias("inside_elements"),
                        (F.col("n") + F.col("meeting")).alias("meeting_elements"))


@query("place_coverage", I.with_inputs("areas", "tagged") + """,
want AS (SELECT DISTINCT n_name AS name FROM nation),
have AS (SELECT DISTINCT concat('NATION_', p_size) AS name FROM part WHERE p_size % 4 = 0)
SELECT count(*) FILTER (WHERE h.name IS NOT NULL) AS n_found, count(*) AS n_expected,
       coalesce(string_agg(CASE WHEN h.name IS NULL THEN w.name END, ',' ORDER BY w.name), '') AS missing
FROM want w LEFT JOIN have h ON w.name = h.name""")
def place_coverage(spark, sf):
    """How many expected places are named by some tagged element, and which are not."""
    want = I.table(spark, sf, "nation").select(F.col("n_name").alias("name"))
    tagged = I.tagged(spark, sf).where(elements.tag_in("tags", "amenity", "cafe"))
    size = I.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_size")
    have = tagged.join(even(size), "id").select(
        F.concat(F.lit("NATION_"), F.col("p_size").cast("string")).alias("name"))
    return elements.coverage(want, have, "name")


# ---------------------------------------------------------------- rings

@query("ring_completeness", I.with_inputs("members", "way_refs") + """,
m AS (SELECT rel_id, pos, ref, ref NOT IN (SELECT way_id FROM way_refs) AS gone FROM members),
f AS (SELECT rel_id, string_agg(ref::varchar, ',' ORDER BY pos, ref) AS first_missing FROM (
  SELECT *, row_number() OVER (PARTITION BY rel_id ORDER BY pos, ref) AS k FROM m WHERE gone) g
  WHERE k <= 5 GROUP BY rel_id)
SELECT m.rel_id, count(*) FILTER (WHERE gone) AS missing, count(*) AS total,
       coalesce(any_value(first_missing), '') AS first_missing
FROM m LEFT JOIN f ON m.rel_id = f.rel_id GROUP BY m.rel_id""")
def ring_completeness(spark, sf):
    el = I.elements(spark, sf)
    return rings.completeness(el.member_refs, el.ways)


@query("ring_totals", I.with_inputs("members", "way_refs") + """
SELECT count(DISTINCT ref) FILTER (WHERE ref IN (SELECT way_id FROM way_refs)) AS present,
       count(DISTINCT ref) AS wanted FROM members""")
def ring_totals(spark, sf):
    el = I.elements(spark, sf)
    return rings.completeness_totals(el.member_refs, el.ways)


def _edges(spark, sf):
    return rings.member_edges(I.ring_members(spark, sf), I.ring_way_refs(spark, sf))


@query("ring_closure", """
SELECT c_custkey + 1 AS rel_id,
  (4 - (CASE WHEN c_custkey % 50 = 7 THEN 1 ELSE 0 END) + (CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END)
    + (CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END))::bigint AS ways,
  (CASE WHEN c_custkey % 50 = 7 THEN 2 ELSE 0 END)::bigint AS open_ends, 0::bigint AS branches,
  0::bigint AS crossings, 0::bigint AS touches, c_custkey % 50 <> 7 AS closed FROM customer""")
def ring_closure(spark, sf):
    return rings.ring_closure(_edges(spark, sf), _ring_points(spark, sf))


@query("ring_touching", """
SELECT c_custkey AS rel_id, c_custkey % 4 AS kind, (CASE WHEN c_custkey % 4 = 3 THEN 1 ELSE 0 END)::bigint AS crossings,
  (CASE WHEN c_custkey % 4 = 3 THEN 0 ELSE 1 END)::bigint AS touches, c_custkey % 4 <> 3 AS closed,
  (CASE c_custkey % 4 WHEN 0 THEN 2 WHEN 3 THEN 0 ELSE 1 END)::bigint AS polygons,
  pow(20 + c_custkey % 30, 2) * CASE c_custkey % 4 WHEN 0 THEN 8 WHEN 3 THEN 0 ELSE 14 END AS area
FROM customer""")
def ring_touching(spark, sf):
    """Rings that meet at a node: two squares, a hole in a shell, the same without its role,
    and a hole that crosses the shell, which is reported and yields nothing."""
    edges, points = I.touching_rings(spark, sf)
    found = rings.polygons_of(rings.assemble(edges, points)).where(~F.col("orphan"))
    sizes = found.groupBy("rel_id").agg(F.count("*").alias("polygons"),
                                        F.sum(wkb.planar_area("way")).alias("area"))
    return rings.ring_closure(edges, points).join(even(sizes), "rel_id", "left").select(
        "rel_id", (F.col("rel_id") % 4).alias("kind"), "crossings", "touches", "closed",
        F.coalesce("polygons", F.lit(0)).alias("polygons"),
        F.coalesce("area", F.lit(0.0)).alias("area"))


@query("ring_assembly", I.with_inputs("ring_members") + """
SELECT rel_id, ref AS ring, role, (CASE WHEN k = 0 THEN 4 ELSE 1 END)::bigint AS ways,
  CASE WHEN k = 0 THEN 9 ELSE 5 END AS points,
  CASE k WHEN 0 THEN 4e0 * s * s WHEN 4 THEN 100e0 ELSE 400e0 END AS area
FROM ring_members WHERE k IN (4, 5) OR (k = 0 AND c % 50 <> 7)""")
def ring_assembly(spark, sf):
    """Closed rings stitched from member ways that run either way round."""
    r = rings.assemble(_edges(spark, sf), _ring_points(spark, sf))
    return r.select("rel_id", "ring", "role", "ways", F.size("points").alias("points"),
                    wkb.planar_area(wkb.make_polygon("points")).alias("area"))


def _ring_points(spark, sf):
    return elements.way_points(I.ring_way_refs(spark, sf), I.ring_nodes(spark, sf), "x", "y")


@query("relation_rows", I.with_inputs("ring_members") + """
SELECT -rel_id AS osm_id, ref AS ring,
  CASE k WHEN 0 THEN 4e0 * s * s - CASE WHEN c % 3 = 0 THEN 100 ELSE 0 END ELSE 400e0 END AS area
FROM ring_members WHERE k = 5 OR (k = 0 AND c % 50 <> 7)""")
def relation_rows(spark, sf):
    """One polygon row per outer ring under the negated id, holes cut out."""
    polygons = rings.polygons_of(rings.assemble(_edges(spark, sf), _ring_points(spark, sf)))
    return rings.relation_rows(polygons).select("osm_id", "ring", wkb.planar_area("way").alias("area"))


@query("dissolve_outer_ways", I.with_inputs("grid", "grid_ways") + """
SELECT region, min(area_id) AS area_id, way_id FROM grid_ways GROUP BY region, way_id HAVING count(*) = 1""")
def dissolve_outer_ways(spark, sf):
    return rings.outer_ways(I.grid_ways(spark, sf), "region")


def _dissolved(spark, sf):
    """The regions of the grid: way 2n runs east from corner n, 2n+1 north; 41 corners a row."""
    area_ways = I.grid_ways(spark, sf)
    corner = F.floor(F.col("way_id") / 2)
    ends = area_ways.select("way_id").distinct().select(
        "way_id", corner.alias("first"),
        (corner + F.when(F.col("way_id") % 2 == 0, 1).otherwise(41)).alias("last"))

    def at(node):
        return F.struct(((node % 41) * 100).cast("double").alias("x"),
                        (F.floor(node / 41) * 100).cast("double").alias("y"))
    points = ends.select("way_id", F.array(at(F.col("first")), at(F.col("last"))).alias("points"))
    return rings.dissolve(area_ways, ends, points, "region")


@query("dissolve_area", I.with_inputs("grid", "grid_ways") + """
SELECT region, count(DISTINCT area_id) * 1e4 AS area, 1 AS n_parts, true AS closed
FROM grid_ways GROUP BY region""")
def dissolve_area(spark, sf):
    """The union of each region: its border closes, its area is the areas' sum."""
    return _dissolved(spark, sf).select("region", "area", "n_parts", "closed")


@query("dissolve_sides", I.with_inputs("grid", "grid_ways") + """
SELECT region, count(DISTINCT area_id) * 1e4 AS area, 1 AS n_parts, true AS closed
FROM grid_ways GROUP BY region""")
def dissolve_sides(spark, sf):
    """The same unions from the areas' sides, which neighbours break at different places."""
    return rings.dissolve_sides(I.grid_boxes(spark, sf), "region").select(
        "region", "area", "n_parts", "closed")


@query("dissolve_cut", I.with_inputs("grid", "grid_ways") + """
SELECT DISTINCT area_id, region FROM grid_ways""")
def dissolve_cut(spark, sf):
    """The middles of all areas cut by the dissolved regions: each lies in its own."""
    middles = I.load(spark, sf, "grid").select("area_id", (F.col("i") * 100.0 + 50).alias("x"),
                                               (F.col("j") * 100.0 + 50).alias("y"))
    masks = _dissolved(spark, sf).where("closed").select("region", "way")
    return spatial.within(middles, masks, "region", x=F.col("x"), y=F.col("y"),
                          spread_by=["area_id"]).select("area_id", "region")

