"""SimHash near-dedup by multi-index hashing.

Fingerprints of 64 bits are cut into two segments of 32. If two differ in at
most two bits, either their high segments differ in at most one bit or their low
segments are equal; so each fingerprint enumerates the ball of radius one
around its high segment and the one point of its low segment, fetches the
fingerprints filed under those values, and the complete distance of each pair is
verified. Copies are one fingerprint, so only different fingerprints meet.

Families of near copies can crowd one segment value. A value with more than
CROWD fingerprints is never paired up: all fingerprints that probe it go another,
equally exact way. Two fingerprints differ in at most two bits if and only if
some 64-bit point is within one bit of both, so they enumerate that ball of 65
points; at most 65 fingerprints can meet at a point, whatever the data.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import column_of, digest_of, join_spread, slices, table, text_of
from terrafold.llm.components import components
from terrafold.llm.token_store import raw_texts
from terrafold.operators.skew import even
from terrafold.workspace import stored

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
# Fingerprints a segment value may hold before its probes go the other way.
CROWD = 64
# Shingles counted at once, which bounds the memory a long text needs.
COUNTED = 1 << 16

_BITS = 64


def fingerprint_of(raw: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of a UTF-8 text, as a signed 64-bit number.

    A-Z are lower-cased, words are runs without ASCII white space, shingles are
    ``words`` of them joined by a space, repeats counted. Fewer words make one
    shingle; none give zero. A bit is set if set in over half the hashes.
    """
    found = raw.lower().split()
    if not found:
        return 0
    if len(found) <= words:
        return struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(
            b" ".join(found), SEED)))[0]
    n = len(found) - words + 1
    joined, ends = b" ".join(found), np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[words - 1:] - 1).tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(_BITS, np.int64)
    for at in range(0, n, COUNTED):
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in
             zip(starts[at:at + COUNTED], stops[at:at + COUNTED])), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, _BITS)
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(counts * 2 > n, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, digest of the text, fp, the fingerprint, of each row; null is the empty text."""
    def run(batches):
        for batch in batches:
            texts = column_of(batch, "text")
            found = [fingerprint_of(raw, words) for a, b in slices(texts)
                     for raw in raw_texts(texts.slice(a, b - a))]
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), column_of(batch, "digest"),
                 pa.array(found, pa.int64())], ["doc_id", "digest", "fp"])

    rows = docs.select("doc_id", digest_of().alias("digest"), text_of().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, digest binary, fp bigint")


def _high(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, 32)


def _low(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _flip(value: Column, bit: int) -> Column:
    mask = 1 << bit
    return value.bitwiseXOR(F.lit(mask if mask < 1 << 63 else mask - (1 << 64)))


def links(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Pairs (a, b) of different fingerprints that join all those two bits apart or less.

    ``prints`` has distinct values in ``fp``. Outside crowded values every link
    is listed, once or twice. Inside, the fingerprints around one point are
    linked to the least of them, which leaves the same groups.

    Joins are shuffled: Spark does not see that an exploded row is 34, and would
    broadcast the probes of a million fingerprints by the size of their file.
    """
    members = stored(prints.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("part"), _high(F.col("fp")).alias("value")),
        F.struct(F.lit(1).alias("part"), _low(F.col("fp")).alias("value")))).alias("m"))
        .select("fp", "m.part", "m.value"), "segments")
    sizes = stored(members.groupBy("part", "value").agg(F.count("*").alias("n"))
                   .where(F.col("n") > crowd).drop("n"), "crowded")
    ball = F.array(*[F.struct(F.lit(0).alias("part"), v.alias("value")) for v in
                     [_high(F.col("fp")), *[_flip(_high(F.col("fp")), i) for i in range(32)]]],
                   F.struct(F.lit(1).alias("part"), _low(F.col("fp")).alias("value")))
    probes = (prints.select("fp", F.explode(ball).alias("p"))
              .select("fp", "p.part", "p.value"))
    filed = members.join(even(sizes), ["part", "value"], "left_anti")
    pairs = (probes.withColumnRenamed("fp", "a")
             .join(even(filed.withColumnRenamed("fp", "b")), ["part", "value"])
             .where(F.col("a") != F.col("b")))
    found = _verified(pairs.select("a", "b"))
    if sizes.isEmpty():
        return found
    # Whoever probes a crowded value, its own members included, goes by whole points.
    other = stored(probes.join(even(sizes), ["part", "value"], "left_semi").select("fp").distinct(),
                   "crowd")
    points = other.select("fp", F.explode(F.array(
        F.col("fp"), *[_flip(F.col("fp"), i) for i in range(_BITS)])).alias("point"))
    met = (points.groupBy("point").agg(F.collect_list("fp").alias("near"))
           .where(F.size("near") > 1)
           .select(F.array_min("near").alias("a"), F.explode("near").alias("b"))
           .where(F.col("a") != F.col("b")))
    return found.unionByName(_verified(met))


def _verified(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, crowd: int = CROWD) -> DataFrame:
    """doc_id, digest, fp, root, component_id per row: the smallest doc_id reachable over links.

    ``root`` is the group's smallest fingerprint, which names it too.

    Texts without words have fingerprint zero and are linked like any other.
    Rows with a null doc_id belong to their group but never name it, unless all
    are null. Repeated rows come out repeated, an empty table gives no rows.
    """
    rows = stored(fingerprints(docs, words), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least"),
                                           F.count("*").alias("n")), "prints")
    found = stored(links(prints.select("fp"), crowd).select("a", "b").distinct(), "links")
    groups = components(found, "a", "b")
    named = (prints.join(even(groups.withColumnRenamed("node", "fp")), "fp", "left")
             .withColumn("root", F.coalesce("root", "fp")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"),
                                      F.count("*").alias("n_prints"))
    named = stored(named, "named")
    least = stored(least, "least")
    by_print = stored(join_spread(named, least, "root", "n_prints", "inner")
                      .select("fp", "root", "component_id", "n"), "by_print")
    return join_spread(rows, by_print, "fp", "n", "inner").select(
        "doc_id", "digest", "fp", "root", "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """One document of each group, all its columns: that of the smallest doc_id.

    Null ids come last, ties go to the smallest text digest. Rows alike in id and
    text are one document; they stay or go together.
    """
    grouped = stored(near_groups(docs, words), "grouped")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    first = stored(grouped.groupBy("root").agg(F.min(place).alias("first"),
                                               F.count("*").alias("n")), "first")
    dropped = stored(
        join_spread(grouped, first, "root", "n", "inner")
        .where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
                 & (F.col("digest") == F.col("first.digest"))))
        .select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct(),
        "dropped")
    rows = docs.select(F.col("doc_id").alias("id"), digest_of().alias("digest"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(dropped, rows["id"].eqNullSafe(dropped["__id"])
                     & (rows["digest"] == dropped["__digest"]), "left_anti").select("row.*")


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every row of documents."""
    return near_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
