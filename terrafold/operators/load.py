"""The whole tag load: from elements and rules to the four feature tables.

Points come from tagged nodes, lines and areas from tagged ways, areas also from
relations whose rings close, under their negated ids, one row per outer ring.
Roads repeat the lines that a list of tags selects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.functions import wkb
from terrafold.operators import elements, rings, tagload
from terrafold.operators.skew import even
from terrafold.operators.tagload import Rule
from terrafold.workspace import stored

# Types of relations that stand for an area.
AREA_RELATIONS = ("multipolygon", "boundary")

TABLES = {"point": "node", "line": "way", "polygon": "way", "roads": "way"}


def load(nodes: DataFrame, ways: DataFrame, way_refs: DataFrame, relations: DataFrame,
         members: DataFrame, rules: list[Rule], roads: dict[str, list[str] | None],
         ranks: dict[tuple[str, str], int]) -> dict[str, DataFrame]:
    """``point``, ``line``, ``polygon`` and ``roads``, each with only its own columns.

    ``nodes`` are (id, x, y, tags), ``ways`` and ``relations`` (id, tags), tags being
    a map or NULL. A table has osm_id, a column for each tag its kind promotes,
    tags (what is left), z_order, way_area for polygons only, and way. Objects
    without a tag left are not loaded; neither are ways of fewer than two nodes
    that are there, nor relations without a closed outer ring.
    """
    lines = stored(elements.way_points(way_refs, nodes, "x", "y"), "lines")
    shapes = _points(nodes).unionByName(_ways(ways, way_refs, lines)).unionByName(
        _areas(relations, members, way_refs, lines))
    kept = tagload.delete_tags(shapes, rules).withColumn("z_order", tagload.z_order(ranks))
    routed = tagload.route(kept.withColumn("shape", F.coalesce("shape", _shape(rules))), roads)
    loaded = tagload.load_tags(routed, rules)
    loaded = loaded.withColumn("way", F.when(F.col("shape") == "point", F.col("way")).when(
        F.col("way").isNotNull(), F.col("way")).when(
        F.col("shape") == "polygon", wkb.make_polygon("points")).otherwise(
        wkb.make_line("points")))
    loaded = stored(loaded.drop("points", "is_closed", "shape"), "loaded")
    return {name: _own(loaded.where(F.col("table") == name), name, kind, rules)
            for name, kind in TABLES.items()}


def _shape(rules: list[Rule]):
    return F.when(tagload.is_area(rules, F.col("is_closed")), "polygon").otherwise("line")


def _own(rows: DataFrame, name: str, kind: str, rules: list[Rule]) -> DataFrame:
    area = [wkb.planar_area("way").cast("float").alias("way_area")] if name == "polygon" else []
    return rows.select("osm_id", *[F.col(f"`{k}`") for k in tagload.column_keys(rules, kind)],
                       "tags", "z_order", *area, "way")


_POINTS = "array<struct<x:double,y:double>>"


def _points(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.size("tags") > 0).select(
        F.lit("node").alias("kind"), F.col("id").alias("osm_id"), "tags",
        F.lit("point").alias("shape"), F.lit(False).alias("is_closed"),
        F.lit(None).cast(_POINTS).alias("points"), wkb.make_point("x", "y").alias("way"))


def _ways(ways: DataFrame, way_refs: DataFrame, lines: DataFrame) -> DataFrame:
    """Area or line is decided by the rules; a closed way ends where it began, three nodes on."""
    tagged = ways.where(F.size("tags") > 0).select(F.col("id").alias("way_id"), "tags")
    closed = (F.col("first") == F.col("last")) & (F.size("points") > 3)
    return (tagged.join(even(lines.where(F.size("points") > 1)), "way_id")
            .join(even(rings.way_ends(way_refs)), "way_id").select(
                F.lit("way").alias("kind"), F.col("way_id").alias("osm_id"), "tags",
                F.lit(None).cast("string").alias("shape"), closed.alias("is_closed"), "points",
                F.lit(None).cast("binary").alias("way")))


def _areas(relations: DataFrame, members: DataFrame, way_refs: DataFrame,
           lines: DataFrame) -> DataFrame:
    tagged = stored(relations.where(F.col("tags")["type"].isin(*AREA_RELATIONS)).select(
        F.col("id").alias("rel_id"), F.map_filter("tags", lambda k, _: k != "type")
        .alias("tags")), "areas")
    wanted = members.where(F.col("type") == "w").join(even(tagged.select("rel_id")), "rel_id",
                                                      "left_semi")
    closed = rings.polygons_of(rings.assemble(rings.member_edges(wanted, way_refs), lines))
    rows = rings.relation_rows(closed).withColumn("rel_id", -F.col("osm_id"))
    return rows.join(even(tagged), "rel_id").select(
        F.lit("relation").alias("kind"), "osm_id", "tags", F.lit("polygon").alias("shape"),
        F.lit(True).alias("is_closed"), F.lit(None).cast(_POINTS).alias("points"), "way")
