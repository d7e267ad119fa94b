"""Exact dedup with a heavy-hitter split.

A Misra-Gries summary (Spark's ``approx_top_k`` family, whose frequent-items
sketch descends from that algorithm) finds the digests that may hold more than
1/HOT_SHARE of the rows. Their counts and winners are then computed exactly, and
the verified winners, at most HOT_SHARE rows, are broadcast: rows of hot digests
are settled map-side and never shuffled. All other digests use ordinary
shuffling, aggregated before they move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.common import HOT_SHARE, digest_of
from terrafold.workspace import stored

# Counters of the summary: its error is 3.5 / TRACKED of the rows, well under 1 / HOT_SHARE.
TRACKED = 16_384
# The summaries are merged in this many groups before the last merge.
MERGE_GROUPS = 64


def decide(docs: DataFrame, normalised: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, keep_id, group_size, kept.

    Texts are equal when their SHA-256 is; ``normalised`` replaces the text
    before that, null counts as the empty text. Of equal texts the row with the
    largest doc_id stays, a null doc_id being the smallest. Rows that share
    text and doc_id are alike: one of them stays. An empty table gives none.
    """
    source = docs.select("doc_id", (normalised if normalised is not None else F.col("text"))
                         .alias("text"))
    rows = stored(source.select("doc_id", digest_of().alias("digest")), "digests")
    hot = winners(rows)
    small = F.broadcast(hot.drop("winner_rows"))
    losers = (rows.join(small, "digest").where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
              .withColumn("kept", F.lit(False)))
    first = hot.select("digest", F.col("keep_id").alias("doc_id"), "keep_id", "group_size",
                       F.explode(F.sequence(F.lit(1), F.col("winner_rows"))).alias("copy"))
    settled = losers.unionByName(
        first.withColumn("kept", F.col("copy") == 1).drop("copy"))

    rest = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    units = rest.groupBy("digest", "doc_id").agg(F.count("*").alias("copies"))
    groups = units.groupBy("digest").agg(F.max("doc_id").alias("keep_id"),
                                         F.sum("copies").alias("group_size"))
    cold = (units.join(groups, "digest")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))
                        & (F.col("copy") == 1)))
    columns = ["doc_id", "digest", "keep_id", "group_size", "kept"]
    return settled.select(columns).unionByName(cold.select(columns))


def winners(rows: DataFrame) -> DataFrame:
    """digest, keep_id, group_size, winner_rows of the hot digests, exact.

    The summary only proposes; a proposal stays if its exact count is above
    1/HOT_SHARE of all rows, so there are fewer than HOT_SHARE winners.
    """
    proposed = stored(_proposed(rows), "proposed")
    seen = rows.join(F.broadcast(proposed), "digest")
    total = rows.count()
    sizes = stored(
        seen.groupBy("digest").agg(F.max("doc_id").alias("keep_id"),
                                   F.count("*").alias("group_size"))
        .where(F.col("group_size") * HOT_SHARE > total), "winners")
    held = (rows.join(F.broadcast(sizes), "digest")
            .where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .groupBy("digest").agg(F.count("*").alias("winner_rows")))
    return stored(sizes.join(held, "digest"), "winners")


def _proposed(rows: DataFrame) -> DataFrame:
    """At most HOT_SHARE digests, among them all that hold more than 1/HOT_SHARE of the rows."""
    parts = rows.select(F.hex("digest").alias("item"),
                        (F.spark_partition_id() % MERGE_GROUPS).alias("part"))
    summaries = parts.groupBy("part").agg(
        F.expr(f"approx_top_k_accumulate(item, {TRACKED})").alias("summary"))
    # Grouped, so that partitions without a summary add no empty one.
    merged = summaries.groupBy(F.lit(0).alias("all")).agg(F.expr(
        f"approx_top_k_estimate(approx_top_k_combine(summary, {TRACKED}), {HOT_SHARE})")
        .alias("top"))
    return merged.select(F.explode("top").alias("top")).select(
        F.unhex("top.item").alias("digest"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all their columns; ``decide`` says which.

    Texts move only to meet the list of dropped rows, and only where that list
    is too large for Spark to broadcast.
    """
    ruled = stored(decide(docs), "decisions")
    dropped = ruled.where(~F.col("kept") & ~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    # A non-null form of the id, so that null ids meet and both columns are join keys.
    known = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    dropped = dropped.select(known.alias("id"), "digest")
    rows = docs.select(known.alias("id"), digest_of().alias("digest"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    left = rows.join(dropped, ["id", "digest"], "left_anti")
    again = stored(ruled.where(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id")))
                   .select(known.alias("id"), "digest").distinct(), "repeated")
    if not again.isEmpty():
        # Rows alike in id and text: the first of them in order of their other columns.
        alike = left.join(again, ["id", "digest"], "left_semi")
        only = alike.groupBy("id", "digest").agg(F.min(F.struct(F.xxhash64("row").alias("h"),
                                                                "row")).alias("least"))
        left = left.join(again, ["id", "digest"], "left_anti").select("row").unionByName(
            only.select(F.col("least.row").alias("row")))
    return left.select("row.*")


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of documents."""
    from terrafold.llm.common import table

    ruled = decide(table(spark, sf_dir, "documents"))
    return ruled.select("doc_id", "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


OP6_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY digest ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       digest AS text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS digest FROM documents)
WINDOW g AS (PARTITION BY digest)
"""
