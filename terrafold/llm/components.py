"""Connected components of a large graph, by alternating large-star and small-star steps.

Both steps keep the components as they are and only move edges nearer to the
smallest node; they stop when every edge points straight at it, after about
log^2 of the longest path. Each step is a pre-aggregated minimum per node and a
join in which hot nodes are settled map-side. Edges stay in a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import join_spread
from terrafold.workspace import discard, stored


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and root, the smallest node of its component, for all nodes of ``edges``.

    Self-loops and null ends are ignored; repeated edges do not matter.
    """
    now = stored(_down(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    while True:
        large = _star(now, both=True)
        small = _star(large, both=False)
        # Settled if nothing moved: the steps only lower, so equal sets have equal sums.
        done = _mark(now) == _mark(small)
        discard(now), discard(large)
        now = small
        if done:
            return now.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
                now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def _down(pairs: DataFrame) -> DataFrame:
    """Distinct edges with u < v."""
    return (pairs.where(F.col("u") != F.col("v"))
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """One step: each node's larger (or smaller) neighbours are tied to its smallest one."""
    down = edges.select(F.col("v").alias("x"), F.col("u").alias("y"))
    near = down.unionByName(edges.select(F.col("u").alias("x"), F.col("v").alias("y"))) \
        if both else down
    near = stored(near, "near")
    least = stored(near.groupBy("x").agg(F.min("y").alias("m"), F.count("*").alias("n")), "least")
    least_of = F.least("m", "x")
    joined = join_spread(near, least, "x", "n", "inner")
    if both:
        tied = joined.where(F.col("y") > F.col("x")).select(least_of.alias("u"),
                                                            F.col("y").alias("v"))
        # A node that is larger than its least neighbour keeps that edge.
        kept = least.where(F.col("m") < F.col("x")).select(F.col("m").alias("u"),
                                                           F.col("x").alias("v"))
    else:
        tied = joined.select(F.col("m").alias("u"), F.col("y").alias("v"))
        kept = least.select(F.col("m").alias("u"), F.col("x").alias("v"))
    out = stored(_down(tied.unionByName(kept)), "edges")
    discard(near), discard(least)
    return out


def _mark(edges: DataFrame) -> tuple:
    """Order-free marks of an edge set: its size and two sums of hashes."""
    # Halved, so that sums of very many hashes stay in range of a decimal.
    h = F.xxhash64("u", "v").cast("decimal(20,0)")
    g = F.xxhash64("v", "u", F.lit(7)).cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h), F.sum(g)).first())
