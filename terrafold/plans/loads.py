"""The tag load: from tagged elements to feature-table rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrafold.functions import wkb
from terrafold.operators import elements, tagload
from terrafold.operators.skew import even
from terrafold.plans import inputs as I
from terrafold.plans.registry import query

ROADS = {"highway": ["service", "primary"], "railway": None}
RANKS = {("highway", "service"): 15, ("amenity", "cafe"): 3, ("building", "yes"): 1}


def _rules(spark):
    return tagload.rules_from(spark.createDataFrame(
        I.RULES, "kind string, pattern string, type string, flags string"))


# Which tags of an input row survive the delete rules, as a JSON key list.
_KEPT = """list_sort(list_filter(json_keys(tags), lambda k: k <> 'source' AND NOT starts_with(k, 'note:')))"""
_AREA = """coalesce(CASE WHEN tags->>'area' = 'no' THEN false ELSE
  (tags->>'amenity') IS NOT NULL OR (tags->>'building') IS NOT NULL END, false)"""


def _keys(c):
    return F.array_join(F.sort_array(F.map_keys(c)), ",")


@query("promote_tags", I.with_inputs("tagged") + """
SELECT id, kind, tags->>'amenity' AS amenity, tags->>'area' AS area,
  CASE WHEN kind <> 'node' THEN tags->>'building' END AS building, tags->>'highway' AS highway,
  tags->>'name' AS name, CASE WHEN kind = 'node' THEN tags->>'ele' END AS ele,
  CASE WHEN kind <> 'node' THEN tags->>'tracktype' END AS tracktype FROM tagged""")
def promote_tags(spark, sf):
    t = tagload.promote_tags(I.tagged(spark, sf), _rules(spark))
    return t.drop("tags", "is_closed")


@query("delete_tags", I.with_inputs("tagged") + f"""
SELECT id, array_to_string({_KEPT}, ',') AS keys FROM tagged""")
def delete_tags(spark, sf):
    return tagload.delete_tags(I.tagged(spark, sf), _rules(spark)).select("id", _keys("tags").alias("keys"))


_LEFT = f"""array_to_string(list_filter({_KEPT}, lambda k: k NOT IN ('amenity', 'area', 'highway', 'name')
  AND NOT (kind <> 'node' AND k IN ('building', 'tracktype')) AND NOT (kind = 'node' AND k = 'ele')), ',')"""


@query("leftover_tags", I.with_inputs("tagged") + f"SELECT id, {_LEFT} AS keys FROM tagged")
def leftover_tags(spark, sf):
    return tagload.load_tags(I.tagged(spark, sf), _rules(spark)).select("id", _keys("tags").alias("keys"))


@query("leftover_variants", I.with_inputs("tagged") + f"""
SELECT 'matched' AS variant, id, {_LEFT} AS keys FROM (SELECT id, kind, json_merge_patch(tags, '{{"name":null}}') AS tags FROM tagged) t
WHERE coalesce(tags->>'amenity', tags->>'area', tags->>'highway', CASE WHEN kind <> 'node' THEN tags->>'building' END) IS NOT NULL
UNION ALL SELECT 'all tags', id, array_to_string({_KEPT}, ',') FROM tagged""")
def leftover_variants(spark, sf):
    """Objects kept only for a promoted column (names set aside), and all tags repeated."""
    rules = _rules(spark)
    unnamed = I.tagged(spark, sf).withColumn("tags", F.map_filter("tags", lambda k, _: k != "name"))
    matched = tagload.load_tags(unnamed, rules, keep="matched")
    repeated = tagload.load_tags(I.tagged(spark, sf), rules, tags="all")
    def rows(df, variant):
        return df.select(F.lit(variant).alias("variant"), "id", _keys("tags").alias("keys"))
    return rows(matched, "matched").union(rows(repeated, "all tags"))


@query("classify_area", I.with_inputs("tagged") + f"""
SELECT id, CASE WHEN kind = 'node' THEN 'point' WHEN is_closed AND {_AREA} THEN 'polygon' ELSE 'line' END AS shape
FROM tagged""")
def classify_area(spark, sf):
    return tagload.classify(I.tagged(spark, sf), _rules(spark)).select("id", "shape")


@query("route_tables", I.with_inputs("tagged") + f""",
s AS (SELECT *, CASE WHEN kind = 'node' THEN 'point' WHEN is_closed AND {_AREA} THEN 'polygon' ELSE 'line' END AS shape
      FROM tagged)
SELECT id, shape AS "table" FROM s UNION ALL
SELECT id, 'roads' FROM s WHERE shape = 'line' AND tags->>'highway' IN ('service', 'primary')""")
def route_tables(spark, sf):
    t = tagload.classify(I.tagged(spark, sf), _rules(spark))
    return tagload.route(t, ROADS).select("id", "table")


@query("z_order", I.with_inputs("tagged") + """
SELECT id, (CASE WHEN tags->>'highway' = 'service' THEN 15 ELSE 0 END)
  + (CASE WHEN tags->>'amenity' = 'cafe' THEN 3 ELSE 0 END)
  + (CASE WHEN tags->>'building' = 'yes' THEN 1 ELSE 0 END) AS z_order FROM tagged""")
def z_order(spark, sf):
    return I.tagged(spark, sf).select("id", tagload.z_order(RANKS).alias("z_order"))


@query("way_geometry", I.with_inputs("nodes", "way_refs") + """,
w AS (SELECT way_id, pos, lon5, lat5 FROM way_refs JOIN nodes USING (node_id))
SELECT way_id, count(*) AS n, min(lon5)::double AS xmin, min(lat5)::double AS ymin, max(lon5)::double AS xmax,
  max(lat5)::double AS ymax, string_agg(lon5::varchar, ',' ORDER BY pos) AS xs FROM w GROUP BY way_id""")
def way_geometry(spark, sf):
    """Lines from node references, written as WKB and read back."""
    el = I.elements(spark, sf)
    lines = elements.way_points(el.way_refs, el.nodes, "lon5", "lat5").withColumn("way", wkb.make_line("points"))
    xs = F.transform(wkb.ring_points("way")[0], lambda p: p["x"].cast("bigint").cast("string"))
    return lines.select("way_id", F.size("points").alias("n"), wkb.envelope("way").alias("e"),
                        F.array_join(xs, ",").alias("xs")).select("way_id", "n", "e.*", "xs")


@query("way_area", I.with_inputs("tagged", "areas") + f"""
SELECT id, shape, CASE WHEN shape = 'polygon' THEN cast(4e0 * s * s AS float) END AS way_area
FROM (SELECT id, CASE WHEN kind = 'node' THEN 'point' WHEN is_closed AND {_AREA} THEN 'polygon'
                      ELSE 'line' END AS shape FROM tagged) t
JOIN areas a ON a.osm_id = -(t.id + 1)""")
def way_area(spark, sf):
    """32-bit planar area in squared map units, for polygon rows only."""
    t = tagload.classify(I.tagged(spark, sf), _rules(spark)).select("id", "shape")
    a = I.area_table(spark, sf).select((-F.col("osm_id") - 1).alias("id"), "way")
    area = F.when(F.col("shape") == "polygon", wkb.planar_area("way")).cast("float")
    return t.join(even(a), "id").select("id", "shape", area.alias("way_area"))


@query("feature_tables", I.with_inputs("tagged") + f""",
s AS (SELECT *, CASE WHEN kind = 'node' THEN 'point' WHEN is_closed AND {_AREA} THEN 'polygon' ELSE 'line' END AS shape
      FROM tagged),
r AS (SELECT shape AS "table", * FROM s UNION ALL
      SELECT 'roads', * FROM s WHERE shape = 'line' AND tags->>'highway' IN ('service', 'primary'))
SELECT "table", count(*) AS "rows", count(tags->>'amenity') AS amenity, count(tags->>'highway') AS highway,
       count(DISTINCT id) AS ids FROM r GROUP BY "table" """)
def feature_tables(spark, sf):
    """The whole load in one plan: delete, classify, route, promote; summed per table."""
    rules = _rules(spark)
    t = tagload.classify(I.tagged(spark, sf), rules)
    loaded = tagload.load_tags(tagload.route(t, ROADS), rules)
    return loaded.groupBy("table").agg(
        F.count("*").alias("rows"), F.count("amenity").alias("amenity"),
        F.count("highway").alias("highway"), F.count_distinct("id").alias("ids"))


# Tags of the ring fixture: every twelfth node of a square, its sides and its relation.
def _load(spark, sf):
    def tags(*when):
        out = F.lit(None).cast("map<string,string>")
        for test, pairs in when:
            out = F.when(test, F.create_map(*[F.lit(x) for p in pairs.items() for x in p])).otherwise(out)
        return out.alias("tags")

    i, k = F.col("id") % 20, F.col("id") % 10
    nodes = I.ring_nodes(spark, sf)
    nodes = nodes.select("*", tags((i == 12, {"amenity": "cafe", "source": "survey"}),
                                   (i == 13, {"note:ja": "x"})))
    refs = I.ring_way_refs(spark, sf)
    ways = refs.select(F.col("way_id").alias("id")).distinct().select("id", tags(
        (k == 0, {"highway": "primary"}), (k == 2, {"tracktype": "grade1", "surface": "mud"}),
        (k == 4, {"highway": "service"}), (k == 5, {"building": "yes", "name": "B"})))
    members = I.ring_members(spark, sf)
    relations = members.select(F.col("rel_id").alias("id")).distinct().select(
        "id", F.create_map(F.lit("type"), F.lit("multipolygon"), F.lit("amenity"), F.lit("cafe")).alias("tags"))
    from terrafold.operators import load

    return load.load(nodes, ways, refs, relations, members, _rules(spark), ROADS, {
        **RANKS, ("highway", "primary"): 30})


@query("load_point", I.with_inputs("areas") + """
SELECT (-osm_id - 1) * 20 + 12 AS osm_id, 'cafe' AS amenity, NULL::varchar AS ele, '' AS keys, 3 AS z_order,
       cx::double AS xmin, (cy - s)::double AS ymin FROM areas""")
def load_point(spark, sf):
    """Tagged nodes with their own columns; deleted tags alone keep no node."""
    t = _load(spark, sf)["point"]
    return t.select("osm_id", "amenity", "ele", _keys("tags").alias("keys"), "z_order",
                    wkb.envelope("way").alias("e")).select(
        "osm_id", "amenity", "ele", "keys", "z_order", "e.xmin", "e.ymin")


_LINE_TWIN = """
SELECT ref AS osm_id, CASE k WHEN 0 THEN 'primary' WHEN 4 THEN 'service' END AS highway,
       CASE WHEN k = 2 THEN 'grade1' END AS tracktype, CASE WHEN k = 2 THEN 'surface' ELSE '' END AS keys,
       CASE k WHEN 0 THEN 30 WHEN 4 THEN 15 ELSE 0 END AS z_order,
       (CASE WHEN k = 4 THEN 40 ELSE 2 * s END)::double AS length
FROM ring_members WHERE """


def _lines(t):
    return t.select("osm_id", "highway", "tracktype", _keys("tags").alias("keys"), "z_order",
                    wkb.planar_length("way").alias("length"))


@query("load_line", I.with_inputs("ring_members") + _LINE_TWIN + "k IN (0, 4) OR (k = 2 AND c % 50 <> 7)")
def load_line(spark, sf):
    """Ways that are no areas, with geometry; untagged sides are left out."""
    return _lines(_load(spark, sf)["line"])


@query("load_roads", I.with_inputs("ring_members") + _LINE_TWIN + "k IN (0, 4)")
def load_roads(spark, sf):
    return _lines(_load(spark, sf)["roads"])


@query("load_polygon", I.with_inputs("ring_members") + """
SELECT ref AS osm_id, NULL::varchar AS amenity, 'yes' AS building, 'B' AS name, 1 AS z_order, 400e0 AS way_area
FROM ring_members WHERE k = 5
UNION ALL SELECT -rel_id, 'cafe', NULL, NULL, 3,
  CASE k WHEN 0 THEN 4e0 * s * s - CASE WHEN c % 3 = 0 THEN 100 ELSE 0 END ELSE 400e0 END
FROM ring_members WHERE k = 5 OR (k = 0 AND c % 50 <> 7)""")
def load_polygon(spark, sf):
    """Areas from closed ways and, under negated ids, from relations, with their size."""
    return _load(spark, sf)["polygon"].select(
        "osm_id", "amenity", "building", "name", "z_order", F.col("way_area").cast("double").alias("way_area"))
