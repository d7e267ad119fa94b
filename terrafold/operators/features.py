"""Feature-table operators: parts of one id, measures, tag lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions import measures, wkb
from terrafold.operators.skew import join_spread, numbered

# Salts over which the parts of one feature are joined before the salts are.
SALTS = 64
# Fixed value: bytes a value of a row can hold.
VALUE_BYTES = (1 << 31) - 64


def tag(key: str, tags: str = "tags") -> Column:
    """A tag of the JSON text column, by a key that may hold colons or quotes.

    The one value is picked out of the text; only a key that a JSON path cannot
    quote makes a map of it.
    """
    if any(c in key for c in "'?\\"):
        return F.from_json(F.col(tags), "map<string,string>").getItem(key)
    return F.get_json_object(F.col(tags), f"$['{key}']")


def regroup(df: DataFrame, key: str = "osm_id") -> DataFrame:
    """One row per id of the rows that share it: parts, summed area, extent, MultiPolygon.

    The area is a sum because parts do not overlap. Parts are joined per salt of
    their bytes, then the salts per id, so that a large feature is put together
    in many tasks; within ``way`` they come by salt, then by bytes. A feature
    whose bytes no value can hold fails by its id.
    """
    parts = df.where(F.col("way").isNotNull()).withColumn("__box", wkb.envelope("way"))
    salt = F.pmod(F.xxhash64("way"), F.lit(SALTS)).cast("int").alias("salt")
    box = [F.min("__box.xmin").alias("xmin"), F.min("__box.ymin").alias("ymin"),
           F.max("__box.xmax").alias("xmax"), F.max("__box.ymax").alias("ymax")]
    salted = parts.groupBy(key, salt).agg(
        F.count("*").alias("n"), F.sum(wkb.planar_area("way")).alias("a"), *box,
        F.sort_array(F.collect_list("way")).alias("ways"))
    salted = salted.withColumn("body", wkb.join_bytes("ways")).drop("ways")
    whole = salted.groupBy(key).agg(
        F.sum("n").alias("n_parts"), F.sum("a").alias("area"),
        F.struct(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
                 F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")).alias("bbox"),
        F.sum(F.octet_length("body").cast("bigint")).alias("bytes"),
        F.transform(F.sort_array(F.collect_list(F.struct("salt", "body"))),
                    lambda s: s["body"]).alias("bodies"))
    fits = F.when(F.col("bytes") < VALUE_BYTES, F.col("bodies")).otherwise(F.raise_error(
        F.concat(F.lit("too large for one value: feature "), F.col(key).cast("string")))
        .cast("array<binary>"))
    return whole.select(key, "n_parts", "area", "bbox",
                        wkb.make_multipolygon(fits, F.col("n_parts")).alias("way"))


def collect_parts(df: DataFrame, key: str, part: str) -> DataFrame:
    """(key, place, n_parts, part): the parts of each key in order, one row a part."""
    return numbered(df.select(key, part), key, [part], "place", "n_parts").select(
        key, "place", "n_parts", part)


def pair_distance(pairs: DataFrame, points: DataFrame, features: DataFrame,
                  point_key: str, feature_key: str) -> DataFrame:
    """Shortest distance for each asked (point, feature), in raw and in true metres.

    A feature may be several rows; the least over its rows counts. ``points``
    has x and y, ``features`` has polygons in ``way``, all in EPSG:3857. True
    metres come from the UTM zone of the point.
    """
    zone = measures.mercator.utm_zone(measures.mercator.x_to_lon(F.col("x")))
    sites = points.select(point_key, "x", "y", zone.alias("zone"))
    asked = join_spread(pairs.select(point_key, feature_key), sites, point_key,
                        spread_by=[feature_key])
    rows = join_spread(asked, features.select(feature_key, "way"), feature_key,
                       spread_by=[point_key])
    raw = wkb.planar_distance(wkb.make_point("x", "y"), F.col("way"))
    true = wkb.planar_distance(measures.point_to_utm(F.col("x"), F.col("y"), F.col("zone")),
                               measures.polygon_to_utm(F.col("way"), F.col("zone")))
    return rows.select(point_key, feature_key, raw.alias("raw"), true.alias("true")).groupBy(
        point_key, feature_key).agg(F.min("raw").alias("raw"), F.min("true").alias("true"))
