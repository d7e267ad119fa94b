"""Boundary rings: are all members there, do they close, and what do they enclose."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.functions import wkb
from terrafold.operators import features, grid, relate, spatial
from terrafold.operators.skew import TASK_ROWS, even, join_spread
from terrafold.workspace import stored


# ---------------------------------------------------------------- completeness

def _marked(member_ways: DataFrame, ways: DataFrame, task_rows: int) -> DataFrame:
    here = ways.select(F.col("id").alias("ref")).distinct().withColumn("here", F.lit(True))
    return join_spread(member_ways, here, "ref", "left", spread_by=["rel_id", "pos"],
                       task_rows=task_rows)


def completeness(member_ways: DataFrame, ways: DataFrame, first: int = 5,
                 task_rows: int = TASK_ROWS) -> DataFrame:
    """Per relation: members, members missing, and the first few missing in member order.

    The few are cut by a ranking filter, which Spark applies before the shuffle
    as well, so a relation of any size sends only that many rows a task.
    """
    marked = _marked(member_ways, ways, task_rows)
    totals = marked.groupBy("rel_id").agg(
        F.count("*").alias("total"), F.count_if(F.col("here").isNull()).alias("missing"))
    order = Window.partitionBy("rel_id").orderBy("pos", "ref")
    few = (marked.where(F.col("here").isNull()).select("rel_id", "pos", "ref")
           .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
           .groupBy("rel_id")
           .agg(F.sort_array(F.collect_list(F.struct("rank", "ref"))).alias("few")))
    return totals.join(even(few), "rel_id", "left").select(
        "rel_id", "missing", "total",
        F.coalesce(F.array_join(F.transform("few", lambda m: m["ref"].cast("string")), ","),
                   F.lit("")).alias("first_missing"))


def completeness_totals(member_ways: DataFrame, ways: DataFrame,
                        task_rows: int = TASK_ROWS) -> DataFrame:
    """One row: distinct member ways present, and distinct member ways wanted."""
    wanted = member_ways.select("ref").distinct()
    here = ways.select(F.col("id").alias("ref")).distinct().withColumn("here", F.lit(True))
    return wanted.join(even(here), "ref", "left").agg(
        F.count_if(F.col("here").isNotNull()).alias("present"), F.count("*").alias("wanted"))


# ---------------------------------------------------------------- closure

def _ends(edges: DataFrame) -> DataFrame:
    """(rel_id, way_id, role, at, node): both ends of every open way; at 0 is its first node."""
    ends = F.array(F.struct(F.lit(0).alias("at"), F.col("first").alias("node")),
                   F.struct(F.lit(1).alias("at"), F.col("last").alias("node")))
    return (edges.where(F.col("first") != F.col("last"))
            .select("rel_id", "way_id", "role", F.explode(ends).alias("e"))
            .select("rel_id", "way_id", "role", "e.at", "e.node"))


def way_ends(way_refs: DataFrame) -> DataFrame:
    """(way_id, first, last): the end nodes of every way with two nodes or more."""
    return way_refs.groupBy("way_id").agg(
        F.min_by("node_id", "pos").alias("first"), F.max_by("node_id", "pos").alias("last"),
        F.count("*").alias("n")).where(F.col("n") > 1).drop("n")


def member_edges(member_ways: DataFrame, way_refs: DataFrame,
                 task_rows: int = TASK_ROWS) -> DataFrame:
    """(rel_id, way_id, role, first, last) of the member ways that are present."""
    ends = way_ends(way_refs).withColumnRenamed("way_id", "ref")
    joined = join_spread(member_ways, ends, "ref", spread_by=["rel_id", "pos"], task_rows=task_rows)
    return joined.groupBy("rel_id", F.col("ref").alias("way_id")).agg(
        F.min("role").alias("role"), F.min("first").alias("first"), F.min("last").alias("last"))


def _bearings(way_points: DataFrame) -> DataFrame:
    """(way_id, bearings): in which directions a way leaves its first and its last node."""
    def towards(here: Column, there: Column) -> Column:
        return F.atan2(there["y"] - here["y"], there["x"] - here["x"])

    first, last = F.element_at("points", 1), F.element_at("points", -1)
    return way_points.where(F.size("points") > 1).select("way_id", F.array(
        towards(first, F.get(F.filter("points", lambda p: p != first), F.lit(0))),
        towards(last, F.try_element_at(F.filter("points", lambda p: p != last), F.lit(-1))),
    ).alias("bearings"))


def _touching(ends: DataFrame, crowded: DataFrame, way_points: DataFrame) -> DataFrame:
    """The ends at nodes where more than two meet, each with the one that follows by turn.

    (rel_id, node, way_id, at, side, among, before, verdict). ``side`` tells the
    ends of holes from the others; ``among`` counts the ends of the side at the
    node. Seen from the node, ``before`` is the next end of the side clockwise.
    ``verdict`` is touch where that settles it; branch where a side has an odd
    number of ends or two leave in one direction; cross where rings of the two
    sides pass through each other.
    """
    here = ends.join(even(crowded), ["rel_id", "node"]).join(
        even(_bearings(way_points)), "way_id", "left")
    here = here.select("rel_id", "node", "way_id", "at",
                       F.when(F.col("role") == "inner", "i").otherwise("o").alias("side"),
                       F.get("bearings", F.col("at")).alias("bearing"))
    node, side = Window.partitionBy("rel_id", "node"), Window.partitionBy("rel_id", "node", "side")
    end = F.struct("bearing", "way_id", "at")
    here = here.select("*", F.count("*").over(side).alias("among"),
                       F.coalesce(F.lag(end).over(side.orderBy("bearing", "way_id", "at")),
                                  F.max(end).over(side)).alias("before"),
                       F.count("bearing").over(node).alias("known"),
                       F.count("*").over(node).alias("all"),
                       F.lag("bearing").over(node.orderBy("bearing", "way_id", "at")).alias("prior"),
                       F.row_number().over(node.orderBy("bearing", "way_id", "at")).alias("nth"))
    # Rings of two sides do not cross if neighbours of one side cancel until none is left. Take
    # the ends of a hole as x -> -x, the others as x -> 1 - x: two of a side cancel and nothing
    # else does, so none is left if all together move no number. What they move it by is the
    # ends of one side at even places less those at odd places.
    shift = F.when(F.col("side") == "o", 1 - F.col("nth") % 2 * 2).otherwise(0)
    ruled = here.groupBy("rel_id", "node").agg(
        F.max(F.col("among") % 2).alias("odd"), F.sum(shift).alias("shift"),
        F.max((F.col("known") < F.col("all")) | F.coalesce(F.col("prior") == F.col("bearing"),
                                                           F.lit(False))).alias("unclear"))
    verdict = (F.when((F.col("odd") > 0) | F.col("unclear"), "branch")
               .when(F.col("shift") != 0, "cross").otherwise("touch"))
    return here.join(even(ruled.select("rel_id", "node", verdict.alias("verdict"))),
                     ["rel_id", "node"]).select("rel_id", "node", "way_id", "at", "side", "among",
                                                "before", "verdict")


def ring_closure(edges: DataFrame, way_points: DataFrame | None = None) -> DataFrame:
    """Per relation: member ways, open ends, branches, crossings, touches, and whether it closes.

    Open ends are end nodes of odd degree. Where more than two ways end, rings
    touch if going round by turn parts them, cross if a hole's ring passes
    through another one, and branch otherwise. Without ``way_points``, (way_id,
    points), there is no turn to go by, and all these nodes are branches.
    """
    ends = _ends(edges)
    degree = ends.groupBy("rel_id", "node").agg(F.count("*").alias("degree"))
    if way_points is None:
        degree = degree.withColumn("verdict", F.when(F.col("degree") > 2, "branch"))
    else:
        degree = stored(degree, "degrees")
        crowded = degree.where((F.col("degree") > 2) & (F.col("degree") % 2 == 0))
        if crowded.isEmpty():
            degree = degree.withColumn("verdict", F.when(F.col("degree") > 2, "branch"))
        else:
            told = _touching(ends, crowded.select("rel_id", "node"), way_points).select(
                "rel_id", "node", "verdict").distinct()
            degree = degree.join(even(told), ["rel_id", "node"], "left").withColumn(
                "verdict", F.coalesce("verdict", F.when(F.col("degree") > 2, "branch")))
    bad = degree.groupBy("rel_id").agg(
        F.count_if(F.col("degree") % 2 == 1).alias("open_ends"),
        *[F.count_if(F.col("verdict") == v).alias(name) for v, name in _VERDICTS.items()])
    n = edges.groupBy("rel_id").agg(F.count("*").alias("ways"))
    counts = ["open_ends", *_VERDICTS.values()]
    return n.join(even(bad), "rel_id", "left").select(
        "rel_id", "ways", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts]).withColumn(
        "closed", (F.col("open_ends") == 0) & (F.col("branches") == 0)
        & (F.col("crossings") == 0))


_VERDICTS = {"branch": "branches", "cross": "crossings", "touch": "touches"}


# ---------------------------------------------------------------- order in a ring

# Relations of more than 2 ** LONG ways are contracted until KEPT links are left of them.
LONG, KEPT = 10, 100_000


def _half(way: Column, direction: Column) -> Column:
    """A way in a travel direction as one number; direction 0 runs first to last node."""
    return F.shiftleft(way.cast("bigint"), 1) + direction


def _way(half: Column) -> Column:
    return F.shiftright(half, 1)


def _direction(half: Column) -> Column:
    return half.bitwiseAND(F.lit(1)).cast("int")


def _doubled(links: DataFrame) -> DataFrame:
    """(rel_id, h, w, low, ahead) of the links that go in circles.

    ``links`` are (rel_id, h, next, w, need); ``w`` is how far it is from h to
    next, 2 ** need at least the number of links of the longest circle. By
    pointer doubling each link learns the smallest of its circle and how far
    ahead that lies. A relation leaves once its own rounds are done. Keys are
    unique on both sides of each join, so a circle of any size spreads over all
    tasks; an open chain runs out of links and falls out.
    """
    state = links.select("rel_id", "h", "next", "need", "w", F.col("w").alias("hop"),
                         F.col("h").alias("low"), F.lit(0).cast("bigint").alias("ahead"))
    state, done = stored(state, "links"), []
    rounds = state.agg(F.max("need")).first()[0] or 0
    for k in range(rounds):
        there = state.select("rel_id", F.col("h").alias("next"), F.col("next").alias("next2"),
                             F.col("hop").alias("hop2"), F.col("low").alias("low2"),
                             F.col("ahead").alias("ahead2"))
        lower = F.col("low2") < F.col("low")
        stepped = stored(state.join(even(there), ["rel_id", "next"]).select(
            "rel_id", "h", F.col("next2").alias("next"), "need", "w",
            (F.col("hop") + F.col("hop2")).alias("hop"),
            F.when(lower, F.col("low2")).otherwise(F.col("low")).alias("low"),
            F.when(lower, F.col("ahead2") + F.col("hop")).otherwise(F.col("ahead"))
            .alias("ahead")), "links")
        done.append(stepped.where(F.col("need") <= k + 1))
        state = stepped.where(F.col("need") > k + 1)
    out = state if not done else done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("rel_id", "h", "w", "low", "ahead")


def _contracted(links: DataFrame) -> DataFrame:
    """(rel_id, h, leader, off) of the links that go in circles, in a few rows written a link.

    Round by round the links whose random mark is above both neighbours' are
    taken out, about a third and never two in a row, and their neighbours are
    joined across the gap. What is left is ranked by doubling, and the links are
    put back in reverse order, each behind the one it followed.
    """
    after = links.select("rel_id", F.col("next").alias("h"), F.col("h").alias("prev"))
    ring = stored(links.join(even(after), ["rel_id", "h"], "left").select(
        "rel_id", "h", "next", "prev", "need", F.lit(1).cast("bigint").alias("w"),
        F.lit(1).cast("bigint").alias("back")), "ring")
    taken, circles, k = [], [], 0
    while (left := ring.count()) > KEPT:
        mark = {c: F.xxhash64(c, F.lit(k)) for c in ("h", "next", "prev")}
        gone = (mark["h"] > mark["next"]) & (mark["h"] > mark["prev"])
        out = stored(ring.where(F.coalesce(gone, F.lit(False))), "taken")
        if out.isEmpty():  # open chains alone
            break
        taken.append(out)
        over = out.select("rel_id", F.col("h").alias("next"), F.col("next").alias("next2"),
                          F.col("w").alias("w2"))
        under = out.select("rel_id", F.col("h").alias("prev"), F.col("prev").alias("prev2"),
                           F.col("back").alias("back2"))
        stay = (ring.where(~F.coalesce(gone, F.lit(False)))
                .join(even(over), ["rel_id", "next"], "left")
                .join(even(under), ["rel_id", "prev"], "left"))
        joined = stored(stay.select(
            "rel_id", "h", F.coalesce("next2", "next").alias("next"),
            F.coalesce("prev2", "prev").alias("prev"), "need",
            (F.col("w") + F.coalesce("w2", F.lit(0))).alias("w"),
            (F.col("back") + F.coalesce("back2", F.lit(0))).alias("back")), "ring")
        # A link that follows itself is all that is left of its circle.
        circles.append(joined.where(F.col("next") == F.col("h")).select(
            "rel_id", "h", F.col("h").alias("leader"), F.lit(0).cast("bigint").alias("off")))
        ring, k = joined.where(F.col("next") != F.col("h")), k + 1
    ranked = stored(_doubled(ring.select("rel_id", "h", "next", "w", F.least(
        F.col("need"), F.lit(max(1, math.ceil(math.log2(max(left, 2)))))).alias("need"))), "ranked")
    whole = ranked.groupBy("rel_id", "low").agg(F.sum("w").alias("round"))
    placed = ranked.join(even(whole), ["rel_id", "low"]).select(
        "rel_id", "h", F.col("low").alias("leader"),
        F.pmod(F.col("round") - F.col("ahead"), F.col("round")).alias("off"))
    # In reverse: what was taken out first followed links that were still there.
    for out, circle in zip(reversed(taken), reversed(circles)):
        placed = placed.unionByName(circle)
        before = placed.select("rel_id", F.col("h").alias("prev"), "leader", "off")
        placed = stored(placed.unionByName(out.join(even(before), ["rel_id", "prev"]).select(
            "rel_id", "h", "leader", (F.col("off") + F.col("back")).alias("off"))), "placed")
    return placed


def _circles(links: DataFrame, sizes: DataFrame) -> DataFrame:
    """(rel_id, low, pos, h, n): the links (rel_id, h, next) that go in circles, in order.

    ``low`` is the smallest link of the circle and at place 0, ``n`` its length.
    ``sizes`` is (rel_id, ways); no circle of a relation is longer.
    """
    need = F.ceil(F.log2(F.greatest("ways", F.lit(2)))).cast("int").alias("need")
    links = stored(links.join(even(sizes.select("rel_id", need)), "rel_id"), "links")
    one = F.lit(1).cast("bigint").alias("w")
    short = _doubled(links.where(F.col("need") <= LONG).select("rel_id", "h", "next", one, "need"))
    short = stored(short, "circles")
    size = short.groupBy("rel_id", "low").agg(F.count("*").alias("n"))
    out = short.join(even(size), ["rel_id", "low"]).select(
        "rel_id", "low", F.pmod(F.col("n") - F.col("ahead"), F.col("n")).alias("pos"), "h", "n")
    long = links.where(F.col("need") > LONG)
    if long.isEmpty():
        return out
    placed = _contracted(long)
    first = placed.groupBy("rel_id", "leader").agg(
        F.count("*").alias("n"), F.min(F.struct("h", "off")).alias("first"))
    return out.unionByName(placed.join(even(first), ["rel_id", "leader"]).select(
        "rel_id", F.col("first.h").alias("low"),
        F.pmod(F.col("off") - F.col("first.off"), F.col("n")).alias("pos"), "h", "n"))


def _links(edges: DataFrame, way_points: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """(rel_id, h, next): where travel goes on from one way into another; and those by turn.

    Where two ends meet, one goes on into the other. Where more meet, travel
    turns into the next end clockwise, so that it keeps to the border of what
    lies to its left; open and unclear nodes link to nothing.
    """
    ends = _ends(edges)
    met = stored(ends.groupBy("rel_id", "node").agg(
        F.count("*").alias("n"), F.min(F.struct("way_id", "at")).alias("a"),
        F.max(F.struct("way_id", "at")).alias("b")), "joints")

    def link(into: str, out: str) -> Column:
        return F.struct(
            _half(F.col(f"{into}.way_id"), 1 - F.col(f"{into}.at")).alias("h"),
            _half(F.col(f"{out}.way_id"), F.col(f"{out}.at")).alias("next"))

    links = met.where(F.col("n") == 2).select(
        "rel_id", F.explode(F.array(link("a", "b"), link("b", "a"))).alias("l")).select(
        "rel_id", "l.h", "l.next")
    crowded = met.where((F.col("n") > 2) & (F.col("n") % 2 == 0)).select("rel_id", "node")
    if way_points is None or crowded.isEmpty():
        return links, None
    here = stored(_touching(ends, crowded, way_points).where(F.col("verdict") == "touch").select(
        "rel_id", "among", F.struct("way_id", "at").alias("e"), "before"), "touching")
    turns = here.select("rel_id", "among", link("e", "before").alias("l")).select(
        "rel_id", "among", "l.h", "l.next")
    by_turn = turns.where(F.col("among") > 2).select("rel_id", "h")
    return links.unionByName(turns.drop("among")), by_turn


def ordered_rings(edges: DataFrame, way_points: DataFrame | None = None) -> DataFrame:
    """(rel_id, ring, pos, way_id, dir, parted): the ways of every closed ring, in travel order.

    Rings that touch are told apart by turn, given ``way_points``: ``parted``
    ones run with the inside of the whole to their left. All others run so that
    their smallest way, after which a ring is named, is taken forward. Open
    chains and unclear nodes yield no ring.
    """
    alone = edges.where(F.col("first") == F.col("last")).select(
        "rel_id", F.col("way_id").alias("ring"), F.lit(0).cast("bigint").alias("pos"), "way_id",
        F.lit(0).alias("dir"), F.lit(False).alias("parted"))
    sizes = edges.groupBy("rel_id").agg(F.count("*").alias("ways"))
    links, by_turn = _links(edges, way_points)
    circles = _circles(links, sizes)

    def rows(circles: DataFrame, parted: bool) -> DataFrame:
        return circles.select("rel_id", _way(F.col("low")).alias("ring"), "pos",
                              _way(F.col("h")).alias("way_id"), _direction(F.col("h")).alias("dir"),
                              F.lit(parted).alias("parted"))

    if by_turn is not None:
        circles = stored(circles, "circles")
        turned = stored(circles.join(even(by_turn), ["rel_id", "h"], "left_semi").select(
            "rel_id", "low").distinct(), "turned")
        faces = stored(circles.join(even(turned), ["rel_id", "low"], "left_semi"), "faces")
        circles = circles.join(even(turned), ["rel_id", "low"], "left_anti")
        parted = _simple(_inside(faces, way_points), edges, sizes)
        alone = alone.unionByName(rows(parted, True))
    # Both travel directions were followed; keep the one that takes the smallest way forward.
    return rows(circles.where(_direction(F.col("low")) == 0), False).unionByName(alone)


def _inside(faces: DataFrame, way_points: DataFrame) -> DataFrame:
    """The walks round the inside of touching rings, of all walks by turn.

    Walks go round faces of a plane map. Only the one round the outside of
    everything turns clockwise; crossing a way from there leads inside, crossing
    another one outside again, and so on.
    """
    walked = _points(faces.select("rel_id", "low", "pos", _way(F.col("h")).alias("way_id"),
                                  _direction(F.col("h")).alias("dir")), way_points, ["rel_id", "low"])
    seen = stored(walked.where(signed_area(F.col("points")) <= 0).select(
        "rel_id", "low", F.lit(0).alias("depth")), "faces")
    twin = F.col("h").bitwiseXOR(F.lit(1))
    across = stored(faces.select("rel_id", "low", "h").join(even(
        faces.select("rel_id", twin.alias("h"), F.col("low").alias("other"))), ["rel_id", "h"])
        .select("rel_id", "low", "other").distinct(), "across")
    depth, front = 0, seen
    while True:
        depth += 1
        front = stored(front.select("rel_id", "low").join(even(across), ["rel_id", "low"]).select(
            "rel_id", F.col("other").alias("low")).distinct()
            .join(even(seen), ["rel_id", "low"], "left_anti")
            .withColumn("depth", F.lit(depth)), "faces")
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return faces.join(even(seen.where(F.col("depth") % 2 == 1)), ["rel_id", "low"], "left_semi")


def _simple(walks: DataFrame, edges: DataFrame, sizes: DataFrame) -> DataFrame:
    """Walks that come to a node several times, as rings that touch there."""
    starts = edges.select("rel_id", F.explode(F.array(
        F.struct(_half(F.col("way_id"), F.lit(0)).alias("h"), F.col("first").alias("node")),
        F.struct(_half(F.col("way_id"), F.lit(1)).alias("h"), F.col("last").alias("node")))
    ).alias("s")).select("rel_id", "s.*")
    walks = stored(walks.join(even(starts), ["rel_id", "h"]), "walks")
    visits = Window.partitionBy("rel_id", "low", "node").orderBy("pos")
    # What leaves a node is followed up to the next time the walk comes there.
    until = F.coalesce(F.lead("pos").over(visits), F.first("pos").over(visits))
    leaving = walks.select("rel_id", "low", F.col("h").alias("next"),
                           F.pmod(until - 1, F.col("n")).alias("pos"))
    return _circles(walks.select("rel_id", "low", "pos", "h").join(even(
        leaving), ["rel_id", "low", "pos"]).select("rel_id", "h", "next"), sizes)


# ---------------------------------------------------------------- assembly

def signed_area(points: Column) -> Column:
    """Area of a closed ring of points, negative where it runs clockwise."""
    start = points[0]
    return F.aggregate(
        F.zip_with(F.slice(points, 1, F.size(points) - 1), F.slice(points, 2, F.size(points) - 1),
                   lambda p, q: (p["x"] - start["x"]) * (q["y"] - start["y"])
                   - (q["x"] - start["x"]) * (p["y"] - start["y"])),
        F.lit(0.0), lambda total, v: total + v) / 2


def _points(placed: DataFrame, way_points: DataFrame, keys: list[str], *more: Column,
            task_rows: int = TASK_ROWS) -> DataFrame:
    """(keys, points, more): the coordinates of whole rings, and aggregates over their ways."""
    ways = join_spread(placed, way_points.select("way_id", "points"), "way_id", spread_by=keys,
                       task_rows=task_rows)
    run = F.when(F.col("dir") == 0, F.col("points")).otherwise(F.reverse("points"))
    # Each way gives all its points but the last, which the next way begins with.
    ways = ways.withColumn("run", F.slice(run, F.lit(1), F.size("points") - 1))
    rings = ways.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("pos", "run"))).alias("runs"), *more)
    body = F.flatten(F.transform("runs", lambda r: r["run"]))
    return rings.withColumn("body", body).withColumn(
        "points", F.concat("body", F.slice("body", 1, 1))).drop("runs", "body")


def assemble(edges: DataFrame, way_points: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """(rel_id, ring, role, ways, points): closed rings with their coordinates.

    The list per ring is its geometry, one value of the output row. A ring that
    touches others and runs clockwise has the outside of its side within it, so
    it is a hole among outer rings, and an island among holes.
    """
    edges = stored(edges, "edges")
    placed = ordered_rings(edges, way_points)
    roles = edges.select("rel_id", "way_id", "role")
    rings = _points(placed.join(even(roles), ["rel_id", "way_id"]), way_points, ["rel_id", "ring"],
                    F.count("*").alias("ways"), F.min("role").alias("role"),
                    F.max("parted").alias("parted"), task_rows=task_rows)
    other = F.when(F.col("role") == "inner", "outer").otherwise("inner")
    turned = F.col("parted") & (F.when(F.col("parted"), signed_area(F.col("points"))) < 0)
    return rings.select("rel_id", "ring", F.when(turned, other).otherwise(F.col("role"))
                        .alias("role"), "ways", "points")


def inner_point(points: Column) -> Column:
    """A point inside a simple ring: midway between the first two sides a level line crosses.

    The line runs between the two lowest levels of the ring's points; NULL for a
    ring without height.
    """
    levels = F.array_sort(F.array_distinct(F.transform(points, lambda p: p["y"])))
    y = (F.get(levels, F.lit(0)) + F.get(levels, F.lit(1))) / 2
    sides = F.zip_with(points, F.slice(points, F.lit(2), F.size(points) - 1), lambda p, q: F.struct(
        p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")))
    met = F.array_sort(F.transform(
        F.filter(sides, lambda s: (s["y1"] < y) != (s["y2"] < y)),
        lambda s: s["x1"] + (y - s["y1"]) / (s["y2"] - s["y1"]) * (s["x2"] - s["x1"])))
    return F.struct(((F.get(met, F.lit(0)) + F.get(met, F.lit(1))) / 2).alias("x"), y.alias("y"))


def polygons_of(rings: DataFrame) -> DataFrame:
    """(rel_id, ring, way, orphan): one polygon per outer ring, with the holes it holds.

    A ring without a role counts as outer. A hole belongs to the smallest outer
    ring of its relation around a point inside it, islands in the hole, which are
    smaller than it, aside; the pairs come from the cell join within the relation. A hole that lies in no outer ring is not lost: it
    comes as a row of its own, ``orphan``. The holes of a shell are part of its
    geometry, one value of the output row.
    """
    rings = stored(rings, "rings")
    is_inner = F.coalesce(F.col("role") == "inner", F.lit(False))
    outer = rings.where(~is_inner).withColumn("way", wkb.make_polygon("points")).withColumn(
        "shell", F.struct("rel_id", "ring"))
    inner = stored(rings.where(is_inner).withColumn("at", inner_point(F.col("points"))).select(
        "rel_id", "ring", "points", F.col("at.x").alias("px"), F.col("at.y").alias("py"),
        wkb.planar_area(wkb.make_polygon("points")).alias("own")), "inner")
    held = spatial.within(inner.select("rel_id", "ring", "px", "py", "own"), outer.select("shell", "way"),
                          "shell", x=F.col("px"), y=F.col("py"), spread_by=["rel_id", "ring"],
                          same=("rel_id", "rel_id"))
    size = outer.select("shell", wkb.planar_area("way").alias("area"))
    owner = (held.join(even(size), "shell").where(F.col("area") > F.col("own"))
             .groupBy("rel_id", "ring")
             .agg(F.min_by("shell.ring", F.struct("area", "shell.ring")).alias("shell_ring")))
    placed = stored(inner.join(even(owner), ["rel_id", "ring"], "left")
                    .select("rel_id", "ring", "points", "shell_ring"), "holes")
    holes = (placed.where(F.col("shell_ring").isNotNull()).groupBy("rel_id", "shell_ring")
             .agg(F.sort_array(F.collect_list(F.struct("ring", "points"))).alias("h"))
             .select("rel_id", F.col("shell_ring").alias("ring"),
                     F.transform("h", lambda h: h["points"]).alias("holes")))
    whole = outer.select("rel_id", "ring", "points").join(even(holes), ["rel_id", "ring"], "left")
    shell = F.array("points")
    shells = whole.select("rel_id", "ring", wkb.make_polygon_with_holes(
        F.when(F.col("holes").isNull(), shell).otherwise(F.concat(shell, "holes"))).alias("way"),
        F.lit(False).alias("orphan"))
    return shells.unionByName(placed.where(F.col("shell_ring").isNull()).select(
        "rel_id", "ring", wkb.make_polygon("points").alias("way"), F.lit(True).alias("orphan")))


def relation_rows(polygons: DataFrame) -> DataFrame:
    """Feature rows of relations: negated id, one row per polygon; orphaned holes are none."""
    return polygons.where(~F.col("orphan")).select((-F.col("rel_id")).alias("osm_id"), "ring", "way")


# ---------------------------------------------------------------- dissolve

def outer_ways(area_ways: DataFrame, region: str) -> DataFrame:
    """Ways used by exactly one area of a region: the border of the areas' union.

    Neighbouring areas share whole ways, so a shared way is inside the union.
    """
    used = area_ways.groupBy(region, "way_id").agg(
        F.count("*").alias("n"), F.min("area_id").alias("area_id"))
    return used.where(F.col("n") == 1).select(region, "area_id", "way_id")


def dissolve(area_ways: DataFrame, ends: DataFrame, way_points: DataFrame,
             region: str) -> DataFrame:
    """(region, the columns of ring_closure, n_parts, area, bbox, way): the union of areas.

    ``ends`` are (way_id, first, last), ``way_points`` (way_id, points).
    """
    border = outer_ways(area_ways, region).join(even(ends), "way_id")
    return _bounded(border.select(F.col(region).alias("rel_id"), "way_id", "first", "last"),
                    way_points, region)


def dissolve_sides(areas: DataFrame, region: str, way: str = "way",
                   task_rows: int = TASK_ROWS) -> DataFrame:
    """The union of a region's polygons, as ``dissolve`` gives it, from their sides alone.

    Sides that an even number of a region's polygons share cancel, whichever
    ways they belong to; what is left is linked into rings. Where a corner of
    the region lies on a side, the side is parted there first, so that
    neighbours may break their common border at different places. Polygons that
    overlap, or whose borders miss each other by rounding, do not cancel.
    """
    sides = stored(_noded(grid.segments(areas, region, way, wkb.POLYGON), region, task_rows),
                   "sides")
    turned = F.struct("x1", "y1") > F.struct("x2", "y2")
    ends = [F.when(turned, F.col(b)).otherwise(F.col(a)).alias(a)
            for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))]
    odd = sides.select(region, *ends).groupBy(region, *grid.ENDS).agg(
        F.count("*").alias("n")).where(F.col("n") % 2 == 1)
    kept = stored(odd.select(
        F.col(region).alias("rel_id"), F.monotonically_increasing_id().alias("way_id"),
        F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")).alias("first"),
        F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")).alias("last")), "border")
    return _bounded(kept, kept.select("way_id", F.array("first", "last").alias("points")), region)


def _noded(sides: DataFrame, key: str, task_rows: int) -> DataFrame:
    """``sides``, parted at the corners of the same key that lie on them."""
    sides = stored(sides.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))
                   .withColumn("side", F.monotonically_increasing_id()), "sides")
    level = relate.mean_level(sides)
    corners = sides.select(key, F.col("x1").alias("x"), F.col("y1").alias("y")).union(
        sides.select(key, "x2", "y2")).distinct()
    square = F.struct(F.col(key), "cx", "cy").alias("square")
    here = corners.withColumn("cx", grid.square(F.col("x"), level)).withColumn(
        "cy", grid.square(F.col("y"), level)).select(square, "x", "y")
    passed = stored(grid.on_squares(sides, level).select(square, "side", *grid.ENDS), "passed")
    met = join_spread(passed, here, "square", spread_by=["side"], task_rows=task_rows)
    x1, y1, x2, y2, x, y = (F.col(c) for c in (*grid.ENDS, "x", "y"))
    along = (x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)
    on = ((x2 - x1) * (y - y1) == (x - x1) * (y2 - y1)) & (along > 0) & (
        along < (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))
    cuts = met.where(on).groupBy("side").agg(F.array_sort(F.collect_set(
        F.struct(along.alias("at"), "x", "y"))).alias("cuts"))
    first, last = (F.struct(F.lit(0.0).alias("at"), F.col(f"x{i}").alias("x"),
                            F.col(f"y{i}").alias("y")) for i in (1, 2))
    stops = F.when(F.col("cuts").isNull(), F.array(first, last)).otherwise(
        F.concat(F.array(first), "cuts", F.array(last)))
    legs = F.zip_with(F.slice(stops, F.lit(1), F.size(stops) - 1),
                      F.slice(stops, F.lit(2), F.size(stops) - 1), lambda p, q: F.struct(
                          p["x"].alias("x1"), p["y"].alias("y1"),
                          q["x"].alias("x2"), q["y"].alias("y2")))
    return sides.join(even(cuts), "side", "left").select(key, F.explode(legs).alias("leg")).select(
        key, "leg.*")


def _bounded(border: DataFrame, way_points: DataFrame, region: str) -> DataFrame:
    """One row per region: its border (rel_id, way_id, first, last) as a MultiPolygon, and the gate.

    The border is stitched into rings, rings inside an odd number of others are
    cut out as holes. The gate is ``closed``: a border with open or branching
    ends is no boundary, and rings it would have had are missing from ``way``,
    which is NULL if there is none.
    """
    edges = stored(border.withColumn("role", F.lit("outer")), "border")
    rung = stored(assemble(edges, way_points).withColumn("at", inner_point(F.col("points"))),
                  "rung")
    shells = rung.select(F.struct("rel_id", "ring").alias("shell"),
                         wkb.make_polygon("points").alias("way"))
    around = spatial.within(
        rung.select("rel_id", "ring", F.col("at.x").alias("px"), F.col("at.y").alias("py")),
        shells, "shell", x=F.col("px"), y=F.col("py"), spread_by=["rel_id", "ring"],
        same=("rel_id", "rel_id")).where(F.col("shell.ring") != F.col("ring"))
    # Of two rings one within the other, a point of the outer one may lie in the inner as well.
    size = rung.select("rel_id", "ring", wkb.planar_area(wkb.make_polygon("points")).alias("size"))
    larger = size.select(F.struct("rel_id", "ring").alias("shell"), F.col("size").alias("other"))
    depth = (around.join(even(size), ["rel_id", "ring"]).join(even(larger), "shell")
             .where(F.col("other") > F.col("size"))
             .groupBy("rel_id", "ring").agg(F.count("*").alias("depth")))
    role = F.when(F.col("depth") % 2 == 1, "inner").otherwise("outer")
    parts = polygons_of(rung.drop("at", "role").join(even(depth), ["rel_id", "ring"], "left")
                        .withColumn("role", role).drop("depth")).where(~F.col("orphan"))
    whole = features.regroup(parts, "rel_id")
    return ring_closure(edges, way_points).join(even(whole), "rel_id", "left").withColumnRenamed(
        "rel_id", region)
