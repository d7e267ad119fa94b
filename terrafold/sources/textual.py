"""GeoJSON text sequences and OPL element text, line by line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SEPARATOR = "\x1e"
FEATURE_SCHEMA = "type string, properties map<string,string>, geometry string"


def read_geojson_lines(spark: SparkSession, path: str) -> DataFrame:
    """(properties, geometry_type, coordinates): one feature a line, RS byte optional.

    ``coordinates`` stays JSON text; its nesting depends on the type. Blank
    lines are skipped; a line that is no JSON object gives NULLs.
    """
    line = F.trim(F.regexp_replace("value", RECORD_SEPARATOR, ""))
    features = spark.read.text(path).select(line.alias("line")).where(F.col("line") != "")
    f = F.from_json("line", FEATURE_SCHEMA)
    return features.select(f.alias("f")).select(
        "f.properties", F.get_json_object("f.geometry", "$.type").alias("geometry_type"),
        F.get_json_object("f.geometry", "$.coordinates").alias("coordinates"))


def polygon_rings(coordinates: Column) -> Column:
    """Polygon coordinates text as array<array<struct<x, y>>>."""
    rings = F.from_json(coordinates, "array<array<array<double>>>")
    return F.transform(rings, lambda ring: F.transform(
        ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))


def feature_line(properties: Column, geometry_type: str, coordinates: Column) -> Column:
    """A GeoJSON Feature as one JSON text; NULL properties are left out."""
    return F.to_json(F.struct(
        F.lit("Feature").alias("type"), properties.alias("properties"),
        F.struct(F.lit(geometry_type).alias("type"), coordinates.alias("coordinates"))
        .alias("geometry")))


def ring_coordinates(points: Column) -> Column:
    """array<struct<x, y>> as GeoJSON positions."""
    return F.transform(points, lambda p: F.array(p["x"], p["y"]))


def read_opl(spark: SparkSession, path: str) -> DataFrame:
    """(kind, id, members): element lines; members are NULL without a member field.

    A line is fields between blanks, each begun by a letter that names it: the
    first gives kind and id, ``M`` the members, parted by commas, each a type
    letter, a number, and a role after an at sign.
    """
    fields = F.split(F.col("value"), " ")
    lines = spark.read.text(path).select(fields.alias("fields")).select(
        "fields", F.substring(F.col("fields")[0], 1, 1).alias("kind"),
        F.expr("try_cast(substring(fields[0], 2) AS bigint)").alias("id"))
    lines = lines.where(F.col("kind").isin("n", "w", "r") & F.col("id").isNotNull())
    listed = F.filter("fields", lambda f: f.startswith("M"))
    named = lines.select("kind", "id", F.get(listed, F.lit(0)).alias("field"))
    members = F.filter(F.split(F.expr("substring(field, 2)"), ","), lambda m: m != "")
    parsed = F.transform(members, lambda m: F.struct(
        F.substring(m, 1, 1).alias("type"),
        F.substring_index(m, "@", 1).substr(F.lit(2), F.length(m)).try_cast("bigint").alias("ref"),
        F.when(F.instr(m, "@") > 0, m.substr(F.instr(m, "@") + 1, F.length(m)))
        .otherwise("").alias("role")))
    return named.select("kind", "id", F.when(F.col("field").isNotNull(), parsed).alias("members"))


def opl_members(elements: DataFrame, member_type: str = "w") -> DataFrame:
    """(rel_id, pos, type, ref, role) of the relation members of one type."""
    rels = elements.where(F.col("kind") == "r").select(
        F.col("id").alias("rel_id"), F.posexplode("members").alias("pos", "m"))
    return rels.select("rel_id", "pos", "m.type", "m.ref", "m.role").where(
        F.col("type") == member_type)


def opl_relation_line(rel_id: Column, members: Column) -> Column:
    """A relation line from its id and array<struct<type, ref, role>>."""
    text = F.array_join(F.transform(members, lambda m: F.concat(
        m["type"], m["ref"].cast("string"), F.lit("@"), m["role"])), ",")
    return F.concat(F.lit("r"), rel_id.cast("string"), F.lit(" M"), text)
