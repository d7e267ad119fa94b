"""Scalar functions: geometry headers, curve keys, projections, measures."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from terrafold.functions import measures, mercator, wkb
from terrafold.functions.hilbert import with_hilbert_key
from terrafold.functions.mercator import EARTH_RADIUS
from terrafold.operators import spatial
from terrafold.plans import inputs as I
from terrafold.plans.oracle import hilbert, utm
from terrafold.plans.registry import query

R = repr(EARTH_RADIUS)


@query("wkb_type", I.with_inputs("points", "parts") + """
SELECT 'point' AS source, osm_id, 'Point' AS geometry_type FROM points UNION ALL
SELECT 'part', part_no, 'Polygon' FROM parts""")
def wkb_type(spark, sf):
    def of(df, source, key):
        return df.select(F.lit(source).alias("source"), F.col(key).alias("osm_id"),
                         wkb.geometry_kind(F.col("way")).alias("geometry_type"))
    return of(I.point_table(spark, sf), "point", "osm_id").union(
        of(I.part_table(spark, sf), "part", "part_no"))


@query("make_wkb", I.with_inputs("parts") + """
SELECT part_no, 93 AS bytes, '0103000000' || '01000000' || '05000000' AS head,
       (x2 - x1)::double * (y2 - y1) AS area, 2e0 * (x2 - x1 + y2 - y1) AS border FROM parts""")
def make_wkb(spark, sf):
    p = I.part_table(spark, sf)
    return p.select("part_no", F.octet_length("way").alias("bytes"),
                    F.hex(F.substring("way", 1, 13)).alias("head"),
                    wkb.planar_area("way").alias("area"), wkb.planar_length("way").alias("border"))


@query("hilbert_key", I.with_inputs("points") + ", " + hilbert("points", "xi", "yi", "osm_id")
       + " SELECT osm_id, hkey FROM curve")
def hilbert_key(spark, sf):
    return with_hilbert_key(spatial.append_bbox(I.point_table(spark, sf)), "hkey").select(
        "osm_id", "hkey")


@query("mercator_forward", I.with_inputs("nodes") + f"""
SELECT node_id, round(radians(lon5 / 1e5) * {R}, 2) AS x,
       round(0.5e0 * {R} * ln((1 + sin(radians(lat5 / 1e5))) / (1 - sin(radians(lat5 / 1e5)))), 2) AS y
FROM nodes""")
def mercator_forward(spark, sf):
    n = I.elements(spark, sf).nodes
    return n.select(F.col("id").alias("node_id"),
                    F.round(mercator.lon_to_x(F.col("lon")), 2).alias("x"),
                    F.round(mercator.lat_to_y(F.col("lat")), 2).alias("y"))


@query("mercator_inverse", I.with_inputs("points") + f"""
SELECT osm_id, round(degrees(xi / {R}), 7) AS lon,
       round(degrees(asin(tanh(yi / {R}))), 7) AS lat FROM points""")
def mercator_inverse(spark, sf):
    p = I.load(spark, sf, "points")
    return p.select("osm_id", F.round(mercator.x_to_lon(F.col("xi").cast("double")), 7).alias("lon"),
                    F.round(mercator.y_to_lat(F.col("yi").cast("double")), 7).alias("lat"))


@query("utm_project", I.with_inputs("nodes") + ", " + utm(
    "nodes", "node_id", "lon5 / 1e5", "lat5 / 1e5")
       + " SELECT node_id, round(east, 2) AS east, round(north, 2) AS north FROM utm")
def utm_project(spark, sf):
    n = I.elements(spark, sf).nodes
    n = mercator.with_utm(n, F.col("lon"), F.col("lat"), 54, "east", "north")
    return n.select(F.col("id").alias("node_id"), F.round("east", 2).alias("east"),
                    F.round("north", 2).alias("north"))


_LL = f"degrees(asin(tanh(y / {R})))"


@query("planar_measures", I.with_inputs("parts") + f""",
corner AS (SELECT part_no, k, CASE WHEN k IN (0, 3) THEN x1 ELSE x2 END AS x,
             CASE WHEN k < 2 THEN y1 ELSE y2 END AS y
           FROM (SELECT *, unnest(range(4)) AS k FROM parts) c),
ll AS (SELECT part_no, k, degrees(x / {R}) AS lon, {_LL} AS lat FROM corner),
{utm("ll", "part_no, k", "lon", "lat")},
side AS (SELECT a.part_no, a.east * b.north - b.east * a.north AS twice,
           sqrt(pow(b.east - a.east, 2) + pow(b.north - a.north, 2)) AS len
         FROM utm a JOIN utm b ON a.part_no = b.part_no AND b.k = (a.k + 1) % 4),
true_size AS (SELECT part_no, abs(sum(twice)) / 2 AS area, sum(len) AS border FROM side GROUP BY part_no)
SELECT p.part_no, ((x2 - x1)::double * (y2 - y1)) AS raw_area, round(t.area / 10, 0) AS true_area_10,
       round(t.border, 1) AS true_border, round((x2 - x1)::double * (y2 - y1) / t.area, 4) AS distortion
FROM parts p JOIN true_size t ON t.part_no = p.part_no""")
def planar_measures(spark, sf):
    """Area and border in true metres beside the raw projected area.

    Every polygon is measured in the zone of its middle; a feature is never split."""
    p = spatial.append_bbox(I.part_table(spark, sf)).withColumn("zone", measures.zone_of_box())
    p = p.withColumn("moved", measures.polygon_to_utm(F.col("way"), F.col("zone")))
    area, raw = wkb.planar_area("moved"), wkb.planar_area("way")
    return p.select("part_no", raw.alias("raw_area"), area.alias("area"),
                    wkb.planar_length("moved").alias("border")).select(
        "part_no", "raw_area", F.round(F.col("area") / 10, 0).alias("true_area_10"),
        F.round("border", 1).alias("true_border"),
        F.round(F.col("raw_area") / F.col("area"), 4).alias("distortion"))


# Parts moved over nine zones, every fifth of them widened beyond any zone.
_FAR = """
far AS (SELECT part_no, x1 - (part_no % 7) * 900000 AS x1, y1 - (part_no % 3) * 3000000 AS y1,
               x1 - (part_no % 7) * 900000 + (x2 - x1) * CASE WHEN part_no % 5 = 0 THEN 4000 ELSE 1 END AS x2,
               y1 - (part_no % 3) * 3000000 + (y2 - y1) * CASE WHEN part_no % 5 = 0 THEN 30 ELSE 1 END AS y2
        FROM parts)"""
_E2 = repr(mercator.FLATTENING * (2 - mercator.FLATTENING))
_E = repr(math.sqrt(mercator.FLATTENING * (2 - mercator.FLATTENING)))
# Area between equator and latitude for a unit of longitude, and a meridian's arc by Simpson.
_Q = ("(1 - {e2}) * (s / (1 - {e2} * s * s) - ln((1 - {e} * s) / (1 + {e} * s)) / (2 * {e}))"
      .format(e2=_E2, e=_E))


@query("true_measures", I.with_inputs("parts") + f""",{_FAR},
edge AS (SELECT part_no, k, (x2 - x1) / {R} AS wide, tanh(CASE k WHEN 0 THEN y1 ELSE y2 END / {R}) AS s FROM far, (VALUES (0), (1)) t(k)),
flat AS (SELECT part_no, k, wide, {_Q}::double AS q, {R} * sqrt(1 - s * s) / sqrt(1 - {_E2} * s * s) * wide AS east FROM edge),
lat AS (SELECT part_no, asin(tanh(y1 / {R})) AS p1, asin(tanh(y2 / {R})) AS p2 FROM far),
arc AS (SELECT part_no, (p2 - p1) / 600 * sum(CASE WHEN i IN (0, 200) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
          * {R} * (1 - {_E2}) / pow(1 - {_E2} * pow(sin(p1 + (p2 - p1) * i / 200), 2), 1.5)) AS north
        FROM lat, range(201) r(i) GROUP BY part_no, p1, p2)
SELECT f.part_no, round({R} * {R} / 2 * a.wide * (b.q - a.q) / 100, 0) AS area_100,
       round(a.east + b.east + 2 * north, 1) AS border
FROM far f JOIN flat a ON a.part_no = f.part_no AND a.k = 0 JOIN flat b ON b.part_no = f.part_no AND b.k = 1
JOIN arc ON arc.part_no = f.part_no""")
def true_measures(spark, sf):
    """Area and border on the ellipsoid of features anywhere, however wide."""
    p = I.load(spark, sf, "parts")
    wide = F.col("part_no") % 5 == 0
    x1 = F.col("x1") - F.col("part_no") % 7 * 900000
    y1 = F.col("y1") - F.col("part_no") % 3 * 3000000
    x2 = x1 + (F.col("x2") - F.col("x1")) * F.when(wide, 4000).otherwise(1)
    y2 = y1 + (F.col("y2") - F.col("y1")) * F.when(wide, 30).otherwise(1)
    box = wkb.make_box(*[c.cast("double") for c in (x1, y1, x2, y2)])
    return p.select("part_no", box.alias("way")).select(
        "part_no", F.round(measures.true_area("way") / 100, 0).alias("area_100"),
        F.round(measures.true_length("way"), 1).alias("border"))
