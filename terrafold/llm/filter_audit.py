"""What each filter of a chain removes, in every order of the chain.

A document is a mask of the filters it fails, and every figure of the audit is a
sum over masks, so texts are reduced to masks where they lie. Only the filter on
copies needs other documents. It goes by a counting Bloom prepass: each text
counts up a few counters of a sketch, the tasks' counts are merged, and a text
that finds one of its counters at one occurs nowhere else. Only the texts that
are not cleared move, to be grouped by their full text; what that finds is
added to the counts as a correction, so no document waits for the join.

DataFrame functions only.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import table, text_of
from terrafold.workspace import stored

# A chunk of the sketch is one of Spark's bitmaps; it serves about CHUNK_TEXTS texts, each
# with COUNTERS of its counters, so that a lone text is cleared in 99 of 100 cases.
CHUNK_COUNTERS, CHUNK_TEXTS, COUNTERS = 1 << 15, 2048, 3
CHUNK_BYTES = CHUNK_COUNTERS // 8
# A merged sketch up to this size goes to every executor, a larger one is joined by chunk.
SKETCH_BYTES = 64 << 20

WHITE = r"[\x20\x09-\x0D]+"
COPIES = "E"


def checks() -> dict[str, Column]:
    """The conditions on one text, by filter; true where the text fails."""
    words = F.filter(F.split("text", WHITE), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(F.regexp_replace("text", "[^A-Z]", ""))
    return {
        "A": n < 100,
        "B": F.size(F.array_distinct(words)) * 100 < n * 80,
        "C": capitals * 100 > F.length("text") * 10,
        "D": F.col("text").rlike(r"[#$%&*|]"),
    }


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang",
          failing: Mapping[str, Column] | None = None, copies: str = COPIES) -> DataFrame:
    """part, filter_order, step and the counts of that step, for every order of the filters.

    ``failing`` maps one letter a filter to its condition over the column
    ``text`` (null texts are empty; a null condition is not a failure);
    ``copies`` is the letter of the filter on texts that occur with a smaller
    doc_id, or empty for none. At most six filters.

    Null parts count as the empty part; each part that has documents has all
    rows, zeros included. A document without doc_id is no copy of others, nor
    are others copies of it, and it has no labels. Rows that repeat a doc_id
    count each; rows alike in doc_id and text are not copies of each other. Of
    several labels of one document 1 wins. An empty table gives no rows.
    """
    failing = checks() if failing is None else dict(failing)
    letters = [*failing, *copies]
    if len(letters) > 6 or any(len(x) != 1 for x in letters) or len(set(letters)) < len(letters):
        raise ValueError("at most six filters, each with a letter of its own")
    texts = docs.select("doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"),
                        text_of().alias("text"))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failing.values())),
               F.lit(0))
    flags = stored(texts.select("doc_id", "part", mask.alias("mask"), *_prints()), "flags")
    counted = flags.select("doc_id", "part", "mask", F.lit(1).alias("weight"))
    if copies:
        again = stored(repeats(flags, texts).select("doc_id", "part", "mask"), "copies")
        moved = F.explode(F.array(
            F.struct(F.col("mask"), F.lit(-1).alias("weight")),
            F.struct((F.col("mask") + (1 << len(failing))).alias("mask"),
                     F.lit(1).alias("weight"))))
        counted = counted.unionByName(
            again.select("doc_id", "part", moved.alias("m")).select("doc_id", "part", "m.*"))
    one = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    masks = (counted.join(one.where("good or toxic"), "doc_id", "left")
             .groupBy("part", "mask", F.coalesce("good", F.lit(False)).alias("good"),
                      F.coalesce("toxic", F.lit(False)).alias("toxic"))
             .agg(F.sum("weight").alias("n")))
    return _orders(stored(masks, "masks"), letters)


# ---------------------------------------------------------------- copies

def _prints() -> list[Column]:
    """128 bits of a text's hashes, as two columns."""
    return [F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2")]


def _counters() -> Column:
    """The places of a text's counters in its chunk, each once."""
    return F.array_distinct(F.array(*[
        F.shiftrightunsigned("h2", 16 * i).bitwiseAND(CHUNK_COUNTERS - 1)
        for i in range(COUNTERS)]))


def _chunk(chunks: int) -> Column:
    return F.pmod("h1", F.lit(chunks)).alias("chunk")


def sketch(flags: DataFrame, chunks: int) -> DataFrame:
    """chunk, crowded: which of the chunk's counters were counted up more than once.

    Every task adds up its own counters before they are merged, so a text with
    a large share of the rows sends a few rows a task.
    """
    counts = (flags.select(_chunk(chunks), F.explode(_counters()).alias("at"))
              .groupBy("chunk", "at").agg(F.count("*").alias("n")))
    return counts.where("n > 1").groupBy("chunk").agg(
        F.bitmap_construct_agg("at").alias("crowded"))


def _not_cleared() -> Column:
    """Whether all counters of a text are crowded."""
    def bit(at: Column) -> Column:
        byte = F.substring("crowded", F.shiftright(at, 3).cast("int") + 1, F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"),
                        at.bitwiseAND(7).cast("int")) == 1

    return F.forall(_counters(), bit)


def repeats(flags: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``flags`` whose text occurs with a smaller doc_id.

    ``flags`` is a stored table of doc_id and the prints of ``texts``.
    """
    total = flags.count()
    chunks = total // CHUNK_TEXTS + 1
    crowded = stored(sketch(flags, chunks), "sketch")
    if crowded.count() * CHUNK_BYTES <= SKETCH_BYTES:
        crowded = F.broadcast(crowded)

    def possible(rows: DataFrame) -> DataFrame:
        rows = rows.where(F.col("doc_id").isNotNull()).withColumn("chunk", _chunk(chunks))
        return rows.join(crowded, "chunk").where(_not_cleared()).drop("chunk", "crowded")

    moved = possible(texts.select("doc_id", "text", *_prints())).select("doc_id", "text")
    firsts = (moved.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
              .select("doc_id", *_prints()))
    return possible(flags).join(stored(firsts, "firsts"), ["doc_id", "h1", "h2"], "left_anti")


# ---------------------------------------------------------------- orders

def _orders(masks: DataFrame, letters: list[str]) -> DataFrame:
    """The counts of every step of every order, as sums over masks."""
    orders = ["".join(o) for o in permutations(letters)]
    bits = {x: 1 << i for i, x in enumerate(letters)}
    steps = [{"filter_order": o, "step": k + 1, "bit": bits[x],
              "before": sum(bits[y] for y in o[:k])}
             for o in orders for k, x in enumerate(o)]
    step = F.explode(F.from_json(
        F.lit(json.dumps(steps)),
        "array<struct<filter_order:string,step:int,bit:int,before:int>>"))
    each = masks.withColumn("s", step).select("part", "mask", "good", "toxic", "n", "s.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    alone = F.col("mask") == F.col("bit")

    def total(which: Column, value: Column | None = None) -> Column:
        return F.sum(F.when(which, F.col("n") if value is None else value).otherwise(0))

    # Of the filters a document fails each comes first in an equal share of the orders.
    share = F.col("n") * F.expr(f"{len(orders)} div greatest(bit_count(mask), 1)")
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"), total(alone).alias("unique_fails"),
        total(fails & ~gone & F.col("good")).alias("good_lost"),
        total(fails & ~gone & F.col("toxic")).alias("toxic_lost"),
        total(fails, share).alias("shapley"))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    """The audit of five filters over all documents, by language."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                     lambda w: w <> '') AS ws
  FROM documents),
failed AS (
  SELECT doc_id, part,
         (len(ws) < 100)::INT
         + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM docs),
judged AS (
  SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM failed LEFT JOIN judged USING (doc_id) GROUP BY ALL),
f(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT v.l || w.l || x.l || y.l || z.l AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bits
  FROM f v, f w, f x, f y, f z
  WHERE v.b + w.b + x.b + y.b + z.b = 31 AND (v.b | w.b | x.b | y.b | z.b) = 31),
steps AS (
  SELECT filter_order, s AS step, bits[s] AS bit,
         coalesce(list_sum(bits[1:s - 1]), 0)::INT AS before
  FROM orders, range(1, 6) r(s)),
sums AS (
  SELECT part, filter_order, step, bit,
         sum(n) FILTER ((mask & (bit | before)) = 0) AS kept,
         sum(n) FILTER ((mask & bit) <> 0 AND (mask & before) = 0) AS removed,
         sum(n) FILTER ((mask & bit) <> 0 AND (mask & before) <> 0) AS redundant,
         sum(n) FILTER (mask = bit) AS unique_fails,
         sum(n) FILTER ((mask & bit) <> 0 AND (mask & before) = 0 AND good) AS good_lost,
         sum(n) FILTER ((mask & bit) <> 0 AND (mask & before) = 0 AND toxic) AS toxic_lost
  FROM counts, steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept,
       coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM sums
"""
