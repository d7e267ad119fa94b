"""Cutting a region out of node, way and relation tables, and id-set operators.

References are kept in long form, one row each, so that no way or relation,
however many references it has, must fit one row or one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.operators import spatial
from terrafold.operators.skew import TASK_ROWS, even, heavy_keys, join_spread, semi_spread
from terrafold.workspace import stored


@dataclass
class Elements:
    """A snapshot.

    nodes(id, lon, lat, ...), ways(id, ...), relations(id, ...),
    way_refs(way_id, pos, node_id), member_refs(rel_id, pos, type, ref, role)
    with types 'n', 'w' and 'r'.
    """

    nodes: DataFrame
    ways: DataFrame
    relations: DataFrame
    way_refs: DataFrame
    member_refs: DataFrame

    @staticmethod
    def from_arrays(nodes: DataFrame, ways: DataFrame, relations: DataFrame) -> Elements:
        """From ways with a ``nodes`` array and relations with a ``members`` array."""
        refs = ways.select(F.col("id").alias("way_id"), F.posexplode("nodes").alias("pos", "node_id"))
        members = relations.select(F.col("id").alias("rel_id"),
                                   F.posexplode("members").alias("pos", "m"))
        return Elements(nodes, ways.drop("nodes"), relations.drop("members"), refs,
                        members.select("rel_id", "pos", "m.type", "m.ref", "m.role"))


def in_lonlat_box(lon_min, lat_min, lon_max, lat_max) -> Column:
    return F.col("lon").between(lon_min, lon_max) & F.col("lat").between(lat_min, lat_max)


# ---------------------------------------------------------------- whole-way cuts

def whole_ways(source: Elements, inside: DataFrame, task_rows: int = TASK_ROWS) -> Elements:
    """The cut around the node ids ``inside``, nothing chopped at its border.

    A way stays if any of its nodes is inside, and then brings all its nodes. A
    way with no node inside goes, even if it crosses the region. A relation
    stays if one of its node or way members does.
    """
    heavy = heavy_keys(source.way_refs, ["node_id", "way_id"], task_rows=task_rows)
    node_ids = inside.select(F.col("id").alias("node_id"))
    touching = semi_spread(source.way_refs.select("way_id", "node_id"), node_ids, "node_id",
                           spread_by=["way_id"], heavy=heavy["node_id"])
    # Each id set feeds several results; it is worked out once.
    way_ids = stored(touching.select("way_id").distinct(), "ways")
    way_refs = semi_spread(source.way_refs, way_ids, "way_id", spread_by=["pos", "node_id"],
                           heavy=heavy["way_id"])
    wanted = stored(node_ids.union(way_refs.select("node_id")).distinct(), "nodes")
    ways = source.ways.join(even(way_ids.withColumnRenamed("way_id", "id")), "id", "left_semi")
    nodes = source.nodes.join(even(wanted.withColumnRenamed("node_id", "id")), "id", "left_semi")
    refs = source.member_refs.withColumn("__ref", _typed_ref())
    heavy = heavy_keys(refs, ["__ref", "rel_id"], task_rows=task_rows)
    kept = nodes.select(F.lit("n").alias("type"), F.col("id").alias("ref")).union(
        way_ids.select(F.lit("w"), "way_id"))
    hit = semi_spread(refs.where(F.col("type").isin("n", "w")),
                      kept.select(_typed_ref().alias("__ref")), "__ref",
                      spread_by=["rel_id", "pos"], heavy=heavy["__ref"])
    rel_ids = stored(hit.select("rel_id").distinct(), "relations")
    members = semi_spread(source.member_refs, rel_ids, "rel_id", spread_by=["pos", "ref"],
                          heavy=heavy["rel_id"])
    relations = source.relations.join(even(rel_ids.withColumnRenamed("rel_id", "id")), "id",
                                      "left_semi")
    return Elements(nodes, ways, relations, way_refs, members)


def _typed_ref() -> Column:
    """One key for (type, ref): a node id and a way id may be the same number."""
    return F.concat(F.col("type"), F.col("ref").cast("string"))


def cut_box(source: Elements, lon_min, lat_min, lon_max, lat_max, **kw) -> Elements:
    inside = source.nodes.where(in_lonlat_box(lon_min, lat_min, lon_max, lat_max))
    return whole_ways(source, inside.select("id"), **kw)


def cut_polygon(source: Elements, polygons: DataFrame, key: str, *, x: Column, y: Column,
                **kw) -> Elements:
    """As ``cut_box``, inside any of ``polygons`` (same coordinates as x and y)."""
    hits = spatial.within(source.nodes.select("id", x.alias("px"), y.alias("py")), polygons, key,
                          x=F.col("px"), y=F.col("py"), spread_by=["id"])
    return whole_ways(source, stored(hits.select("id").distinct(), "inside"), **kw)


def closure(source: Elements, relations: DataFrame, with_refs: bool = True,
            task_rows: int = TASK_ROWS) -> Elements:
    """Relations and, unless left out, the ways and nodes they need to be drawn."""
    refs = semi_spread(source.member_refs, relations.select(F.col("id").alias("rel_id")),
                       "rel_id", spread_by=["pos", "ref"], task_rows=task_rows)
    if not with_refs:
        return Elements(source.nodes.limit(0), source.ways.limit(0), relations,
                        source.way_refs.limit(0), refs)
    way_ids = stored(refs.where(F.col("type") == "w").select(F.col("ref").alias("id")).distinct(),
                     "ways")
    ways = source.ways.join(even(way_ids), "id", "left_semi")
    way_refs = semi_spread(source.way_refs, way_ids.withColumnRenamed("id", "way_id"), "way_id",
                           spread_by=["pos", "node_id"], task_rows=task_rows)
    node_ids = refs.where(F.col("type") == "n").select(F.col("ref").alias("id")).union(
        way_refs.select(F.col("node_id").alias("id"))).distinct()
    nodes = source.nodes.join(even(node_ids), "id", "left_semi")
    return Elements(nodes, ways, relations, way_refs, refs)


# ---------------------------------------------------------------- tag filters

def tag_in(tags: str, key: str, *values: str) -> Column:
    """Key present with one of the values; any value if none is named."""
    at = F.col(tags).getItem(key)
    return at.isin(*values) if values else at.isNotNull()


def is_admin_area(level: str, suffix: str) -> Column:
    """Administrative areas of one level whose name ends in ``suffix``."""
    return ((F.col("boundary") == "administrative") & (F.col("admin_level") == level)
            & F.col("name").endswith(suffix))


# ---------------------------------------------------------------- id sets

def by_ids(table: DataFrame, ids: DataFrame, key: str, **kw) -> DataFrame:
    """Rows whose key is listed; ids that match nothing are no error."""
    return semi_spread(table, ids, key, **kw)


def missing(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Expected keys that were not found."""
    return expected.join(even(found.select(key).distinct()), key, "left_anti")


def id_drift(old: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """One row: ids asked for, ids gone, and the rate."""
    gone = F.sum(F.when(F.col("__here").isNull(), 1).otherwise(0))
    here = snapshot.select(key).distinct().withColumn("__here", F.lit(True))
    return (old.select(key).distinct().join(even(here), key, "left")
            .agg(F.count("*").alias("n_ids"), F.coalesce(gone, F.lit(0)).alias("n_gone"))
            .withColumn("rate", F.when(F.col("n_ids") > 0, F.col("n_gone") / F.col("n_ids"))))


def agreement(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Keys on which two result sets differ, a key missing on one side included."""
    both = left.select(key, F.col(value).alias("left_value")).join(even(
        right.select(key, F.col(value).alias("right_value"))), key, "full_outer")
    return both.where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def cardinality_gate(df: DataFrame, key: str, expected: Column | int) -> DataFrame:
    """One row: distinct keys, the number expected, and whether they agree."""
    want = F.lit(expected) if isinstance(expected, int) else expected
    return df.agg(F.countDistinct(key).alias("found"), want.cast("bigint").alias("expected")
                  ).withColumn("ok", F.col("found") == F.col("expected"))


def element_info(source: Elements) -> DataFrame:
    """Count per element type, and the box of the nodes."""
    none = F.lit(None).cast("double")
    parts = [
        source.nodes.agg(F.count("*").alias("n"), F.min("lon").alias("lon_min"),
                         F.min("lat").alias("lat_min"), F.max("lon").alias("lon_max"),
                         F.max("lat").alias("lat_max")).select(F.lit("node").alias("type"), "*")]
    for name, df in (("way", source.ways), ("relation", source.relations)):
        parts.append(df.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("type"), "n", none.alias("lon_min"), none.alias("lat_min"),
            none.alias("lon_max"), none.alias("lat_max")))
    return parts[0].union(parts[1]).union(parts[2])


def coverage(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """One row: expected keys found, expected keys, and the missing ones in order.

    The expected list is the caller's checklist, so its missing part is no
    larger than that list.
    """
    gone = missing(expected.select(key).distinct(), found, key).select(
        key, F.lit(True).alias("__gone"))
    marked = expected.select(key).distinct().join(gone, key, "left")
    return marked.agg(
        F.count_if(F.col("__gone").isNull()).alias("n_found"), F.count("*").alias("n_expected"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("__gone"), F.col(key)))), ",")
        .alias("missing"))


# ---------------------------------------------------------------- way geometry

def way_points(way_refs: DataFrame, nodes: DataFrame, x: str, y: str,
               task_rows: int = TASK_ROWS) -> DataFrame:
    """(way_id, points) with the coordinates of every way in node order.

    Nodes absent from the snapshot are left out of the line. The list built per
    way is its geometry, one value of the output row.
    """
    at = nodes.select(F.col("id").alias("node_id"), F.col(x).cast("double").alias("x"),
                      F.col(y).cast("double").alias("y"))
    placed = join_spread(way_refs, at, "node_id", spread_by=["way_id", "pos"], task_rows=task_rows)
    rows = placed.groupBy("way_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "x", "y"))).alias("p"))
    return rows.select("way_id", F.transform(
        "p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points"))
