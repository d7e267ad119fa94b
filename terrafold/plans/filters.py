"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrafold.operators import elements, features, layout, spatial, tagload
from terrafold.operators.digest import null_safe_diff
from terrafold.plans import inputs as I
from terrafold.plans.registry import query

X1, Y1, X2, Y2 = I.BOX
IN_BOX = f"xi BETWEEN {X1} AND {X2} AND yi BETWEEN {Y1} AND {Y2}"


@query("bbox_filter", I.with_inputs("points") + f"""
SELECT osm_id, name, amenity FROM points WHERE {IN_BOX}""")
def bbox_filter(spark, sf):
    return I.laid_out(spark, sf, "points").where(spatial.covering_meets(I.BOX)).select(
        "osm_id", "name", "amenity")


@query("attr_filter", I.with_inputs("points") + """
SELECT osm_id, name, amenity FROM points WHERE amenity = 'cafe'""")
def attr_filter(spark, sf):
    return I.laid_out(spark, sf, "points").where(F.col("amenity") == "cafe").select(
        "osm_id", "name", "amenity")


@query("bbox_attr_filter", I.with_inputs("points") + f"""
SELECT osm_id, name FROM points WHERE amenity = 'cafe' AND {IN_BOX}""")
def bbox_attr_filter(spark, sf):
    return I.laid_out(spark, sf, "points").where(
        spatial.covering_meets(I.BOX) & (F.col("amenity") == "cafe")).select("osm_id", "name")


# Diamonds, not boxes, so that the covering test alone keeps too much: one on
# each admin area, its half axes 60 times the area's size.
@query("bbox_refine", I.with_inputs("areas") + f"""
SELECT osm_id FROM areas
WHERE greatest(0, {X1} - cx, cx - {X2}) + greatest(0, {Y1} - cy, cy - {Y2}) <= 60 * s""")
def bbox_refine(spark, sf):
    a = I.load(spark, sf, "areas").withColumn("half", F.col("s") * 60)
    shapes = spatial.append_bbox(a.select("osm_id", I.diamond("cx", "cy", "half", "half").alias("way")))
    return spatial.intersects(shapes, I.BOX).select("osm_id")


@query("admin_filter", I.with_inputs("areas") + """
SELECT osm_id, name FROM areas
WHERE boundary = 'administrative' AND admin_level = '7' AND name LIKE '%区'""")
def admin_filter(spark, sf):
    return I.load(spark, sf, "areas").where(elements.is_admin_area("7", "区")).select("osm_id", "name")


@query("admin_guard", I.with_inputs("areas", "wards") + """
SELECT a.osm_id, a.name FROM areas a JOIN wards w ON w.ward_id = 6
 AND abs(a.cx - w.cx) * w.b + abs(a.cy - w.cy) * w.a < w.a * w.b
WHERE boundary = 'administrative' AND admin_level = '7' AND a.name LIKE '%区'""")
def admin_guard(spark, sf):
    """Areas of the right level and suffix that also lie in the one parent area."""
    a = I.area_table(spark, sf).where(elements.is_admin_area("7", "区"))
    parent = I.ward_table(spark, sf).where(F.col("ward_id") == 6)
    return spatial.within(a, parent, "ward_id", x=F.col("cx").cast("double"),
                          y=F.col("cy").cast("double"), spread_by=["osm_id"]).select("osm_id", "name")


@query("tags_filter", I.with_inputs("tagged") + """
SELECT kind, id FROM tagged
WHERE (kind = 'node' AND tags->>'amenity' IN ('cafe', 'bar')) OR (kind = 'way' AND tags->>'highway' IS NOT NULL)""")
def tags_filter(spark, sf):
    t = I.tagged(spark, sf)
    wanted = ((F.col("kind") == "node") & elements.tag_in("tags", "amenity", "cafe", "bar")) | (
        (F.col("kind") == "way") & elements.tag_in("tags", "highway"))
    return t.where(wanted).select("kind", "id")


@query("tag_lookup", I.with_inputs("tagged") + """
SELECT id, tags->>'name' AS name, tags->>'$."operator:en"' AS operator_en FROM tagged
WHERE tags->>'$."operator:en"' = 'Brand#2'""")
def tag_lookup(spark, sf):
    t = I.load(spark, sf, "tagged")
    return t.where(features.tag("operator:en") == "Brand#2").select(
        "id", features.tag("name").alias("name"), features.tag("operator:en").alias("operator_en"))


@query("null_safe_diff", I.with_inputs("parts") + """
SELECT part_no FROM (SELECT *, CASE WHEN part_no % 4 = 0 THEN NULL ELSE abs(way_area) END AS other
FROM parts) p WHERE cast(way_area AS varchar) IS DISTINCT FROM cast(other AS varchar)""")
def null_safe_diff_(spark, sf):
    p = I.load(spark, sf, "parts").withColumn(
        "other", F.when(F.col("part_no") % 4 != 0, F.abs("way_area")))
    return p.where(null_safe_diff(F.col("way_area").cast("string"), F.col("other").cast("string"))
                   ).select("part_no")


@query("append_bbox", I.with_inputs("parts") + """
SELECT osm_id, part_no, CASE WHEN part_no % 9 <> 0 THEN x1::double END AS xmin,
  CASE WHEN part_no % 9 <> 0 THEN y1::double END AS ymin,
  CASE WHEN part_no % 9 <> 0 THEN x2::double END AS xmax,
  CASE WHEN part_no % 9 <> 0 THEN y2::double END AS ymax,
  part_no % 9 = 0 AS no_box FROM parts""")
def append_bbox(spark, sf):
    """Every ninth geometry is NULL, and so is its box."""
    p = I.part_table(spark, sf).withColumn("way", F.when(F.col("part_no") % 9 != 0, F.col("way")))
    return spatial.append_bbox(p).select(
        "osm_id", "part_no", "bbox.*", F.col("bbox").isNull().alias("no_box"))


@query("star_replace", I.with_inputs("parts") + """
SELECT * EXCLUDE (x1, y1) REPLACE (CASE WHEN isnan(way_area) THEN NULL ELSE abs(way_area) END AS way_area)
FROM parts""")
def star_replace(spark, sf):
    area = F.when(~F.isnan("way_area"), F.abs("way_area"))
    return I.load(spark, sf, "parts").drop("x1", "y1").withColumn("way_area", area)


@query("export_projection", I.with_inputs("tagged") + """
SELECT id, concat('{', array_to_string(list_sort(list_transform(json_keys(tags),
  lambda k: concat('"', k, '":"', json_extract_string(tags, concat('$."', k, '"')), '"'))), ','), '}') AS tags,
  id::double AS x FROM tagged""")
def export_projection(spark, sf):
    """Tag map to JSON text with sorted keys, geometry to bytes, other columns as they are."""
    from terrafold.functions import wkb

    t = I.tagged(spark, sf).select("id", "tags", wkb.make_point(
        F.col("id").cast("double"), F.lit(0.0)).alias("way"))
    return tagload.export_projection(t).select("id", "tags", wkb.envelope("way").alias("e")).select(
        "id", "tags", F.col("e.xmin").alias("x"))


@query("wide_geometries", I.with_inputs("parts") + """
SELECT osm_id, part_no, greatest(x2 - x1, y2 - y1)::double AS metres FROM parts
WHERE greatest(x2 - x1, y2 - y1) > 10000""")
def wide_geometries(spark, sf):
    return I.laid_out(spark, sf, "parts").where(spatial.wider_than(10000)).select(
        "osm_id", "part_no", F.greatest(F.col("bbox.xmax") - F.col("bbox.xmin"),
                                        F.col("bbox.ymax") - F.col("bbox.ymin")).alias("metres"))


@query("wkb_envelope", I.with_inputs("parts") + """
SELECT part_no, x1::double AS xmin, y1::double AS ymin, x2::double AS xmax, y2::double AS ymax FROM parts""")
def wkb_envelope(spark, sf):
    return layout.append_bbox(I.part_table(spark, sf)).select("part_no", "bbox.*")
