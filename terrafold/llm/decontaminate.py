"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item is a set of windows of consecutive words, every window a
list of word shingles. A document contains a window only if it contains all its
shingles, so with shingles ordered by rarity in the corpus a prefix of one, the
rarest, is necessary. The join goes by that shingle alone; its place in the
window fixes where the window would start, which must lie inside the document
(length and positional bounds); what remains is verified shingle by shingle,
word for word. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import UPPER, digest_of, table, text_of
from terrafold.workspace import stored

# The characters that end a word, and the same as a pattern.
BREAKS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
BREAK_PATTERN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]++"

WINDOW = 10
SHINGLE = 3
# Benchmark sides of up to this many rows are broadcast, larger ones shuffled.
BROADCAST_ROWS = 1_000_000


def words_of(column: Column) -> Column:
    """Words after lower-casing A-Z; an empty array for a text without any."""
    ascii_only = F.octet_length(column) == F.char_length(column)
    lower = F.when(ascii_only, F.lower(column)).otherwise(
        F.translate(column, UPPER, UPPER.lower()))
    inner = F.btrim(lower, F.lit(BREAKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, BREAK_PATTERN))


def _bounded(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if a count shows that it is small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per different window: win, n (words), k (words a shingle), words, item_ids.

    ``win`` is the window's text. An item shorter than ``window`` is one window,
    an item without words none. Repeated ids count once, a null id as "null".
    """
    words = (items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("id"),
                          words_of(text_of()).alias("words"))
             .withColumn("size", F.size("words")).where(F.col("size") > 0))
    starts = words.withColumn("at", F.explode(F.sequence(
        F.lit(0), F.greatest(F.col("size") - window, F.lit(0)))))
    return (starts.select("id", F.slice("words", F.col("at") + 1, F.lit(window)).alias("words"))
            .groupBy("words").agg(F.array_sort(F.collect_set("id")).alias("item_ids"))
            .select(F.array_join("words", " ").alias("win"), F.size("words").alias("n"),
                    F.least(F.size("words"), F.lit(shingle)).alias("k"), "words", "item_ids"))


def _window_shingles(windows: DataFrame) -> DataFrame:
    """win, n, k, offset, shingle, h for every shingle of every window."""
    placed = windows.select("win", "n", "k", "words", F.explode(F.sequence(
        F.lit(0), F.col("n") - F.col("k"))).alias("offset"))
    parts = placed.withColumn("part", F.slice("words", F.col("offset") + 1, F.col("k")))
    # The same value as _shingle_hash gives on the documents' side.
    h = F.when(F.col("k") == 1, F.xxhash64(F.lit(1), F.get("part", F.lit(0))))
    most = windows.agg(F.max("k")).first()[0] or 1
    for k in range(2, most + 1):
        h = h.when(F.col("k") == k, F.xxhash64(F.lit(k), *[F.get("part", F.lit(i))
                                                           for i in range(k)]))
    return parts.select("win", "n", "k", "offset", F.array_join("part", " ").alias("shingle"),
                        h.alias("h"))


def _shingle_hash(k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get("words", F.col("at") + i) for i in range(k)])


def matches(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """doc_id, digest, n_words, at, shingle: where documents hold benchmark shingles.

    One pass over the texts. Each document also gives a row with ``at`` = -1 and
    no shingle, which carries its word count.
    """
    known = stored(shingles.select("k", "h", "shingle").distinct(), "shingles")
    lengths = sorted(r[0] for r in known.select("k").distinct().collect())  # at most SHINGLE
    least = lengths[0] if lengths else 1
    texts = docs.select("doc_id", digest_of().alias("digest"), words_of(text_of()).alias("words"))
    sized = texts.select("doc_id", "digest", "words", F.size("words").alias("n_words"))
    at = sized.select("*", F.explode(F.sequence(
        F.lit(-1), F.greatest(F.col("n_words") - least, F.lit(-1)))).alias("at"))
    # Spread, and met by no shingle: the word-for-word test below fails.
    own = F.xxhash64("doc_id", "digest")
    if len(lengths) > 1:
        fits = [F.when((F.col("at") >= 0) & (F.col("at") + k <= F.col("n_words")), F.struct(
            F.lit(k).alias("k"), _shingle_hash(k).alias("h"))) for k in lengths]
        here = F.when(F.col("at") < 0, F.array(F.struct(F.lit(0).alias("k"), own.alias("h"))))
        at = at.select("*", F.explode(here.otherwise(F.array_compact(F.array(*fits)))).alias("s"))
        at = at.select("doc_id", "digest", "words", "n_words", "at", "s.k", "s.h")
    else:
        at = at.select("*", F.lit(least).alias("k"), F.when(F.col("at") < 0, own).otherwise(
            _shingle_hash(least)).alias("h"))
    rows = at.withColumnRenamed("h", "__h").withColumnRenamed("k", "__k")
    # As text between line ends, which no word holds; a test, not one more join key.
    same = F.instr(F.concat(F.lit("\n"), F.col("shingle"), F.lit("\n")), F.concat(
        F.lit("\n"), F.array_join(F.slice("words", F.col("at") + 1, F.col("__k")), " "),
        F.lit("\n"))) > 0
    met = rows.join(_bounded(known), (F.col("__h") == F.col("h")) & (F.col("at") >= 0) & same,
                    "left")
    return (met.where((F.col("at") < 0) | F.col("shingle").isNotNull())
            .select("doc_id", "digest", "n_words", "at", "shingle"))


def occurrences(found: DataFrame, windows: DataFrame, shingles: DataFrame) -> DataFrame:
    """doc_id, digest, start, n, item_ids: every occurrence of a window in a document."""
    held = found.where(F.col("at") >= 0)
    counted = held.groupBy("shingle").agg(F.count("*").alias("seen"))
    rarest = (shingles.join(counted, "shingle", "left")
              .groupBy("win", "n", "k")
              .agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "shingle",
                                  "offset")).alias("first")))
    prefix = stored(rarest.where(F.col("first.seen") > 0)
                    .select("win", "n", F.col("first.shingle").alias("shingle"),
                            F.col("first.offset").alias("offset")), "prefix")
    candidates = (held.join(_bounded(prefix), "shingle")
                  .withColumn("start", F.col("at") - F.col("offset"))
                  .where((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("n_words")))
                  .select("doc_id", "digest", "start", "win"))
    wanted = (candidates.join(_bounded(stored(shingles, "window_shingles")), "win")
              .select("doc_id", "digest", "start", "win", "n", "k", "offset", "shingle",
                      (F.col("start") + F.col("offset")).alias("at")))
    there = held.select(F.col("doc_id").alias("__doc_id"), "digest", "at", "shingle")
    met = wanted.join(there, (wanted["doc_id"].eqNullSafe(there["__doc_id"]))
                      & (wanted["digest"] == there["digest"]) & (wanted["at"] == there["at"])
                      & (wanted["shingle"] == there["shingle"]), "left_semi")
    whole = (met.groupBy("doc_id", "digest", "start", "win", "n", "k")
             .agg(F.count_distinct("offset").alias("got"))
             .where(F.col("got") == F.col("n") - F.col("k") + 1))
    return whole.join(_bounded(stored(windows.select("win", "item_ids"), "item_ids")), "win") \
        .select("doc_id", "digest", "start", "n", "item_ids")


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW,
         shingle: int = SHINGLE) -> DataFrame:
    """doc_id, digest, n_words, n_hit, item_ids per row of ``docs``.

    A word inside any occurrence of a window is hit, once. Null texts have no
    words; rows without hits have n_hit 0 and an empty list; repeated rows are
    judged alike; without items nothing is hit.
    """
    windows = stored(item_windows(items, window, shingle), "windows")
    shingles = stored(_window_shingles(windows), "shingles")
    found = stored(matches(docs, shingles), "matches")
    runs = F.transform(F.collect_set(F.struct("start", "n")),
                       lambda x: F.sequence(x["start"], x["start"] + x["n"] - 1))
    judged = (occurrences(found, windows, shingles).groupBy("doc_id", "digest")
              .agg(F.size(F.array_distinct(F.flatten(runs))).cast("long").alias("n_hit"),
                   F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids"))))
                   .alias("item_ids"))
              .withColumnRenamed("doc_id", "__doc_id").withColumnRenamed("digest", "__digest"))
    rows = found.where(F.col("at") < 0).select("doc_id", "digest", "n_words")
    return (rows.join(judged, rows["doc_id"].eqNullSafe(judged["__doc_id"])
                      & (rows["digest"] == judged["__digest"]), "left")
            .select("doc_id", "digest", F.col("n_words").cast("long").alias("n_words"),
                    F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit word, all their columns."""
    tainted = (stored(hits(docs, items).where(F.col("n_hit") > 0)
                      .select("doc_id", "digest").distinct(), "tainted")
               .withColumnRenamed("doc_id", "__id").withColumnRenamed("digest", "__tainted"))
    rows = docs.select(F.col("doc_id").alias("__doc_id"), digest_of().alias("__digest"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(tainted, rows["__doc_id"].eqNullSafe(tainted["__id"])
                     & (rows["__digest"] == tainted["__tainted"]), "left_anti").select("row.*")


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    judged = hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


_SQL_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, len(s) AS n, array_to_string(s, ' ') AS win FROM (
    SELECT item_id, list_slice(w, a, a + 9) AS s
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS a FROM i
          WHERE len(w) > 0))),
lengths AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS a FROM d),
occ AS (
  SELECT DISTINCT pos.doc_id, a, l.n, win.item_id
  FROM pos CROSS JOIN lengths l
  JOIN win ON win.n = l.n AND win.win = array_to_string(list_slice(w, a, a + l.n - 1), ' ')
  WHERE a + l.n - 1 <= len(w)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(a, a + n)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit,
       coalesce(n_items, 0)::bigint AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
