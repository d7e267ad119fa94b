"""Loading tagged elements into the four wide feature tables.

A rule says for which element kinds a tag becomes a column, makes a closed way
an area, or is dropped. Rules are a small table; they are read once and turned
into column expressions, so the load itself is one projection over the rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AREA_YES = ("yes", "1", "true")
AREA_NO = ("no", "0", "false")


@dataclass(frozen=True)
class Rule:
    kinds: tuple[str, ...]      # 'node', 'way' or both; relations follow 'way'
    pattern: str                # a tag key, or 'prefix:*'
    flags: frozenset[str]       # linear, polygon, nocolumn, delete

    def holds_for(self, kind: str) -> bool:
        return ("way" if kind == "relation" else kind) in self.kinds


def rules_from(table: DataFrame) -> list[Rule]:
    """Rules of a (kind, pattern, type, flags) table; kind and flags may list several."""
    rows = table.select("kind", "pattern", "flags").collect()  # a style, not data
    return [Rule(tuple(r["kind"].split(",")), r["pattern"], frozenset(r["flags"].split(",")))
            for r in rows]


def column_keys(rules: list[Rule], kind: str | None = None) -> list[str]:
    """Keys that become columns, in rule order, for one kind or for any."""
    keys = [r.pattern for r in rules if not r.flags & {"delete", "nocolumn"}
            and (kind is None or r.holds_for(kind))]
    return list(dict.fromkeys(keys))


def area_keys(rules: list[Rule]) -> list[str]:
    return list(dict.fromkeys(r.pattern for r in rules
                              if "polygon" in r.flags and r.holds_for("way")))


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def is_deleted(key: Column, rules: list[Rule], kind: str) -> Column:
    patterns = [r.pattern for r in rules if "delete" in r.flags and r.holds_for(kind)]
    exact = [p for p in patterns if not p.endswith("*")]
    tests = [key.isin(*exact)] if exact else []
    tests += [key.startswith(p[:-1]) for p in patterns if p.endswith("*")]
    return _any(tests)


def _by_kind(make) -> Column:
    """One expression per element kind, chosen by the row's ``kind``."""
    out = F.when(F.col("kind") == "node", make("node"))
    return out.otherwise(make("way"))


# ---------------------------------------------------------------- tags

def delete_tags(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Drop tags whose key a delete rule names, by whole key or by prefix."""
    return df.withColumn("tags", _by_kind(
        lambda kind: F.map_filter("tags", lambda k, _: ~is_deleted(k, rules, kind))))


def promoted(rules: list[Rule]) -> list[Column]:
    """One column per promoted tag; NULL where the rule is for the other kind."""
    nodes, ways = column_keys(rules, "node"), column_keys(rules, "way")
    out = []
    for key in column_keys(rules):
        value = F.col("tags").getItem(key)
        if key not in nodes:
            value = F.when(F.col("kind") != "node", value)
        elif key not in ways:
            value = F.when(F.col("kind") == "node", value)
        out.append(value.alias(key))
    return out


def promote_tags(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.select(*df.columns, *promoted(rules))


def leftover(rules: list[Rule]) -> Column:
    """Tags without a column of their own, delete rules applied."""
    def keep(kind: str) -> Column:
        taken = column_keys(rules, kind)
        return F.map_filter("tags", lambda k, _: ~(
            k.isin(*taken) | is_deleted(k, rules, kind)))

    return _by_kind(keep)


def load_tags(df: DataFrame, rules: list[Rule], keep: str = "all",
              tags: str = "leftover") -> DataFrame:
    """Promoted columns plus the ``tags`` map.

    ``keep``: 'all' keeps every object with any tag left, 'matched' only those
    with a value in a promoted column. ``tags``: 'leftover', or 'all' to repeat
    the promoted tags in the map.
    """
    if keep not in ("all", "matched") or tags not in ("leftover", "all"):
        raise ValueError(f"unknown variant keep={keep!r}, tags={tags!r}")
    kept = delete_tags(df, rules)
    rest = leftover(rules) if tags == "leftover" else F.col("tags")
    names = column_keys(rules)
    base = [c for c in df.columns if c != "tags"]
    out = kept.select(*base, *promoted(rules), rest.alias("tags"),
                      F.size("tags").alias("__n_tags"))
    if keep == "matched":
        out = out.where(F.coalesce(*[F.col(f"`{n}`") for n in names]).isNotNull())
    else:
        out = out.where(F.col("__n_tags") > 0)
    return out.drop("__n_tags")


# ---------------------------------------------------------------- area or line

def is_area(rules: list[Rule], closed: Column) -> Column:
    """A closed way is an area by area=yes, or by an area tag unless area=no.

    natural=coastline does not make an area.
    """
    area = F.col("tags").getItem("area")
    tagged = []
    for key in area_keys(rules):
        value = F.col("tags").getItem(key)
        has = value.isNotNull()
        if key == "natural":
            has = has & (value != "coastline")
        if key != "area":
            tagged.append(has)
    return closed & F.when(area.isin(*AREA_YES), True).when(area.isin(*AREA_NO), False).otherwise(
        F.coalesce(_any(tagged), F.lit(False)))


def classify(df: DataFrame, rules: list[Rule], closed: str = "is_closed") -> DataFrame:
    """Append ``shape``: point for nodes, polygon or line for the rest."""
    return df.withColumn("shape", F.when(F.col("kind") == "node", "point")
                         .when(is_area(rules, F.col(closed)), "polygon").otherwise("line"))


def route(df: DataFrame, roads: dict[str, list[str] | None]) -> DataFrame:
    """One row per (element, table): its own table, and roads for the listed lines.

    ``roads`` maps a tag key to the values that belong there, None for any; the
    source does not fix this list, so it is the caller's.
    """
    in_roads = _any([F.col("tags").getItem(k).isNotNull() if v is None
                     else F.col("tags").getItem(k).isin(*v) for k, v in roads.items()])
    is_road = (F.col("shape") == "line") & F.coalesce(in_roads, F.lit(False))
    tables = F.when(is_road, F.array(F.col("shape"), F.lit("roads"))).otherwise(
        F.array(F.col("shape")))
    return df.withColumn("table", F.explode(tables))


def z_order(ranks: dict[tuple[str, str], int]) -> Column:
    """Sum of the ranks of the tag values an object has; the ranks are the caller's."""
    total = F.lit(0)
    for (key, value), rank in ranks.items():
        total = total + F.when(F.col("tags").getItem(key) == value, rank).otherwise(0)
    return total.cast("int")


# ---------------------------------------------------------------- export

def json_text(tags: Column) -> Column:
    """A tag map as JSON text with sorted keys."""
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(tags))))


def export_projection(df: DataFrame, geometry: str = "way", tags: str = "tags") -> DataFrame:
    """The file form: geometry as WKB bytes, tags as JSON text, all else unchanged, in order."""
    types = dict(df.dtypes)
    out = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        if name == tags and types[name].startswith("map<"):
            c = json_text(c).alias(name)
        elif name == geometry and types[name] != "binary":
            raise ValueError(f"`{geometry}` must hold WKB bytes, not {types[name]}")
        out.append(c)
    return df.select(*out)
