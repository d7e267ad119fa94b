"""Hard negatives by the method of Four Russians.

Components are whole numbers. For every group of eight dimensions an anchor has
a table of its 256 subset sums; a candidate is packed into bit planes, one byte
a group and plane, in two's complement. Looking the bytes up, adding over the
groups and shifting over the planes gives the exact inner product with every
anchor: a byte of eight dimensions costs one look-up. Arithmetic is modulo 2^64,
so a score is exact whenever it fits 64 bits.

Every anchor meets every row, in blocks: candidates are packed once, rows of a
few thousand vectors; anchors go round by round, a bounded broadcast each. A
task keeps the best few of each anchor over all blocks it sees and hands on
only those. Positives take one such pass over the rows of an anchor's label,
negatives a second one over the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.common import column_of, table
from terrafold.llm.running import running
from terrafold.workspace import new_path, stored

# Vectors a block of candidates; anchors whose tables are held at once; bytes of anchors a round.
BLOCK_ROWS, ANCHOR_ROWS, ROUND_BYTES = 2048, 256, 16 << 20
# Scores a task works out, about a minute's work; bytes of tables it keeps.
TASK_SCORES, TABLE_BYTES = 200_000_000, 64 << 20
GROUP = 8
# Copies of an anchor's rows that are listed at once.
COPIES = 10_000
# Components are below this in magnitude; others could not be scored in 64 bits.
LARGEST = 1 << 62
LEAST = np.iinfo(np.int64).min

_PACKED = "n int, dims int, planes int, ids binary, labels binary, bits binary"
_ANCHORS = ("block bigint, n int, dims int, nths binary, ids binary, labels binary, "
            "vectors binary, positives array<array<bigint>>")
_FOUND = "nth bigint, positive int, score bigint, vec_id bigint"


# ---------------------------------------------------------------- the rows

def whole_vectors(rows: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id, label, vector of the rows that take part; the vector in whole numbers.

    A component x becomes floor(scale * x). Rows with a null vec_id, label or
    vector, or with any component that is null, not finite or too large for
    LARGEST, take no part. Other columns are dropped.
    """
    scaled = F.transform("embedding", lambda v: v.cast("double") * scale)
    fits = F.forall("x", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < LARGEST), F.lit(False)))
    return (rows.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                        F.col("label").cast("bigint").alias("label"), scaled.alias("x"))
            .where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").where(fits)
            .select("vec_id", "label", F.transform("x", lambda v: F.floor(v)).alias("vector")))


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Rows of one length; shorter vectors end in zeros."""
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.values.slice(vectors.offsets[0].as_py(), int(lengths.sum())).to_numpy()
    out = np.zeros((len(lengths), -(-int(lengths.max(initial=1)) // GROUP) * GROUP), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """(plane, group, row): each row's bits, eight dimensions a byte, highest plane first.

    As many planes as the largest component needs in two's complement.
    """
    widest = int(np.bitwise_or.reduce(np.where(vectors < 0, ~vectors, vectors), axis=None))
    planes = widest.bit_length() + 1
    n, dims = vectors.shape
    out = np.empty((planes, dims // GROUP, n), np.uint8)
    for k in range(planes):
        bit = (vectors >> (planes - 1 - k)) & 1
        out[k] = np.packbits(bit.astype(np.uint8).reshape(n, -1, GROUP), axis=2,
                             bitorder="little")[:, :, 0].T
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of candidates, each in order of vec_id."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            part = part.take(pc.sort_indices(column_of(part, "vec_id")))
            vectors = _matrix(column_of(part, "vector"))
            bits = bit_planes(vectors)
            yield pa.RecordBatch.from_pydict({
                "n": pa.array([len(vectors)], pa.int32()),
                "dims": pa.array([vectors.shape[1]], pa.int32()),
                "planes": pa.array([len(bits)], pa.int32()),
                "ids": [column_of(part, "vec_id").to_numpy().tobytes()],
                "labels": [column_of(part, "label").to_numpy().tobytes()],
                "bits": [bits.tobytes()]})


def _pack_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ANCHOR_ROWS):
            part = batch.slice(start, ANCHOR_ROWS)
            vectors = _matrix(column_of(part, "vector"))
            columns = {c: column_of(part, c).to_numpy() for c in ("nth", "vec_id", "label")}
            positives = column_of(part, "positives").to_pylist()
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([int(columns["nth"][0])], pa.int64()),
                "n": pa.array([len(vectors)], pa.int32()),
                "dims": pa.array([vectors.shape[1]], pa.int32()),
                "nths": [columns["nth"].tobytes()], "ids": [columns["vec_id"].tobytes()],
                "labels": [columns["label"].tobytes()], "vectors": [vectors.tobytes()],
                "positives": pa.array([positives], pa.list_(pa.list_(pa.int64())))})


# ---------------------------------------------------------------- scoring

def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(group, byte, anchor): the sum of the components that the byte's bits name."""
    n, dims = anchors.shape
    parts = anchors.reshape(n, dims // GROUP, GROUP)
    out = np.zeros((dims // GROUP, 1 << GROUP, n), np.int64)
    for bit in range(GROUP):
        half = 1 << bit
        out[:, half:2 * half] = out[:, :half] + parts[:, :, bit].T[:, None, :]
    # Narrow tables are looked up faster; sums over groups must fit as well.
    if int(np.abs(anchors).max(initial=0)) * dims < 1 << 31:
        return out.astype(np.int32)
    return out


def scores(tables: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """(row, anchor): the inner products, exact modulo 2^64."""
    groups = min(len(tables), bits.shape[1])  # what one side lacks is zero
    out = np.zeros((bits.shape[2], tables.shape[2]), np.int64)
    for k, plane in enumerate(bits):
        here = np.zeros(out.shape, tables.dtype)
        for g in range(groups):
            here += tables[g].take(plane[g], axis=0)
        out = -here.astype(np.int64) if k == 0 else (out << 1) + here
    return out


def _best(score: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the ``most`` largest scores and their ids, ties by the smaller id."""
    order = np.lexsort((ids, ~score), axis=-1)[..., :most]
    return np.take_along_axis(score, order, -1), np.take_along_axis(ids, order, -1)


def _ranked(score: np.ndarray, ids: np.ndarray, valid: np.ndarray):
    """(anchor, row) scores, best first, ties by id, and their ids; those not valid come last.

    ``score`` is (row, anchor) with rows in order of id; what is not valid has
    score LEAST. Score and place are sorted as one number where they fit.
    """
    n = len(score)
    flat = np.where(valid, score, LEAST).T
    if n and max(int(score.max()), -int(score.min())) < 1 << 50:
        key = np.where(valid, score * n + (n - 1 - np.arange(n))[:, None], LEAST).T
        key = -np.sort(-(key + 1)) - 1
        place = np.where(key == LEAST, 0, n - 1 - key % n)
        return np.where(key == LEAST, LEAST, key // n), ids[place]
    order = np.argsort(~flat, axis=1, kind="stable")
    return np.take_along_axis(flat, order, 1), ids[order]


def _from(score: np.ndarray, ids: np.ndarray, most: int, least=LEAST, highest=None):
    """The best ``most`` of ranked rows between two scores; places not taken are at LEAST."""
    anchors, n = score.shape
    start = 0 if highest is None else (score > highest[:, None]).sum(axis=1)[:, None]
    at = np.broadcast_to(start + np.arange(most), (anchors, most))
    there = at < n
    at = np.minimum(at, n - 1)
    got = np.take_along_axis(score, at, 1)
    there &= (got > LEAST) & (got >= np.reshape(least, (-1, 1)))
    return np.where(there, got, LEAST), np.where(there, np.take_along_axis(ids, at, 1), 0)


class _Kept:
    """The best few of every anchor (and window) over all blocks a task has seen."""

    def __init__(self, most: int):
        self.most, self.held = most, {}

    def add(self, block: int, nths: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if block in self.held:
            _, s, i = self.held[block]
            score = np.concatenate([s, score], -1)
            ids = np.concatenate([i, ids], -1)
        self.held[block] = (nths, *_best(score, ids, self.most))

    def rows(self) -> Iterator[pa.RecordBatch]:
        for nths, score, ids in self.held.values():
            there = score > LEAST
            at = np.nonzero(there)
            yield pa.RecordBatch.from_pydict({
                "nth": nths[at[0]],
                "positive": (at[1] if score.ndim == 3 else np.zeros(len(at[0]))).astype(np.int32),
                "score": score[there], "vec_id": ids[there]})


def _met(batches: Iterator[pa.RecordBatch]):
    """Candidates and anchors of each pair of blocks, as arrays; an anchor's tables are kept."""
    kept: dict[int, np.ndarray] = {}
    for batch in batches:
        for r in batch.to_pylist():
            ids, labels = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["labels"], "<i8")
            bits = np.frombuffer(r["bits"], np.uint8).reshape(r["planes"], -1, r["n"])
            a = r["a"]
            if a["block"] not in kept:
                if sum(t.nbytes for t in kept.values()) > TABLE_BYTES:
                    kept.clear()
                vectors = np.frombuffer(a["vectors"], "<i8").reshape(a["n"], a["dims"])
                kept[a["block"]] = subset_sums(vectors)
            yield ids, labels, bits, a, kept[a["block"]]


def _positives(most: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Kept(most)
        for ids, labels, bits, a, tables in _met(batches):
            of, own = np.frombuffer(a["labels"], "<i8"), np.frombuffer(a["ids"], "<i8")
            nths = np.frombuffer(a["nths"], "<i8")
            # Rows of one label meet the anchors of that label only.
            for label in np.intersect1d(labels, of):
                rows, some = np.flatnonzero(labels == label), np.flatnonzero(of == label)
                score = scores(tables[:, :, some], bits[:, :, rows])
                ranked = _ranked(score, ids[rows], ids[rows][:, None] != own[some])
                found = _from(*ranked, most)
                full = np.full((len(of), most), LEAST), np.zeros((len(of), most), np.int64)
                for whole, part in zip(full, found):
                    whole[some] = part
                best.add(a["block"], nths, *full)
        yield from best.rows()

    return search


def _windows(positives: list[list[int]], low: int, high: int) -> Iterator[tuple]:
    """For the first, second, ... positive of every anchor the least and the highest score."""
    for j in range(max(map(len, positives))):
        bounds = [(-(-low * p[j] // 100), high * p[j] // 100) if j < len(p) else (0, -1)
                  for p in positives]
        yield tuple(np.array([min(max(b, LEAST), -LEAST - 1) for b in side], np.int64)
                    for side in zip(*bounds))


def _negatives(most: int, low: int, high: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Kept(most)
        for ids, labels, bits, a, tables in _met(batches):
            other = labels[:, None] != np.frombuffer(a["labels"], "<i8")
            ranked = _ranked(scores(tables, bits), ids, other)
            found = [_from(*ranked, most, least, highest)
                     for least, highest in _windows(a["positives"], low, high)]
            best.add(a["block"], np.frombuffer(a["nths"], "<i8"),
                     *(np.stack(x, axis=1) for x in zip(*found)))
        yield from best.rows()

    return search


# ---------------------------------------------------------------- the operator

def _against_all(anchors: DataFrame, blocks: DataFrame, search, rows: int, name: str) -> DataFrame:
    """What ``search`` keeps of every anchor against every block, round by round of anchors."""
    spark = anchors.sparkSession
    path = new_path(spark, name)
    held = blocks.count()
    size = anchors.agg(F.max("nth").alias("last"), F.max(F.size("vector")).alias("dims")).first()
    a_round = max(1, ROUND_BYTES // (8 * max(GROUP, size["dims"])))
    packed = [c for c in ("nth", "vec_id", "label", "vector", "positives")]
    for r, first in enumerate(range(0, size["last"] + 1, a_round)):
        some = anchors.where(F.col("nth").between(first, first + a_round - 1)).select(packed)
        # At most ROUND_BYTES, by the count of anchors and their dimensions.
        some = some.coalesce(1).mapInArrow(_pack_anchors, _ANCHORS)
        tasks = max(3 * spark.sparkContext.defaultParallelism, a_round * rows // TASK_SCORES)
        (blocks.repartition(max(1, min(held, tasks)))
         .crossJoin(F.broadcast(some.select(F.struct("*").alias("a"))))  # blocks against blocks
         .mapInArrow(search, _FOUND).write.parquet(f"{path}/round={r}"))
    return spark.read.schema(_FOUND).parquet(path)


def _top(found: DataFrame, most: int) -> DataFrame:
    """Of each anchor's positive the best rows, numbered from 1."""
    order = Window.partitionBy("nth", "positive").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90, scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, embedding and label; ``is_anchor`` is a condition over
    vec_id and label. Scores are inner products of floor(scale * embedding),
    higher ones come first, ties by smaller vec_id. An anchor's positives are
    its first rows of the same label and another vec_id; its negatives for each
    of them the first rows of another label with
    low * positive <= 100 * negative <= high * positive.

    ``whole_vectors`` says which rows take no part. Shorter vectors end in
    zeros. Repeated rows count each, as anchors as well. Scores have to fit 64
    bits. No rows, no anchors or no partner give no rows.
    """
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, "
                                      "negative_id bigint, positive_score bigint, "
                                      "negative_score bigint")
    vectors = stored(whole_vectors(rows, scale), "vectors")
    anchors = (vectors.where(is_anchor).groupBy("vec_id", "label", "vector")
               .agg(F.count("*").alias("copies"))
               .withColumn("mark", F.xxhash64("label", "vector")).withColumn("one", F.lit(1)))
    anchors = stored(running(anchors, ["vec_id", "mark"], "one", "nth").withColumn(
        "positives", F.array().cast("array<bigint>")), "anchors")
    if anchors.isEmpty():
        return empty
    total = vectors.count()
    blocks = stored(vectors.mapInArrow(_pack, _PACKED), "blocks")
    near = stored(_top(_against_all(anchors, blocks, _positives(positives), total, "near"),
                       positives), "positives")
    if near.isEmpty():
        return empty
    of = near.groupBy("nth").agg(F.transform(F.array_sort(F.collect_list(
        F.struct("rank", "score"))), lambda p: p.score).alias("positives"))
    asked = stored(anchors.drop("positives").join(of, "nth"), "asked")
    far = _top(_against_all(asked, blocks, _negatives(negatives, low, high), total, "far"),
               negatives)
    pairs = near.select("nth", (F.col("rank") - 1).alias("positive"),
                        F.col("vec_id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    names = anchors.select("nth", F.col("vec_id").alias("anchor_id"), "copies")
    found = far.select("nth", "positive", "rank", F.col("vec_id").alias("negative_id"),
                       F.col("score").alias("negative_score")).join(pairs, ["nth", "positive"])
    found = found.join(names, "nth")
    # Copies of an anchor come in lists of bounded length.
    found = found.withColumn("list", F.explode(F.sequence(
        F.lit(0), ((F.col("copies") - 1) / COPIES).cast("bigint"))))
    found = found.withColumn("copy", F.explode(F.sequence(
        F.lit(1), F.least(F.col("copies") - F.col("list") * COPIES, F.lit(COPIES)))))
    return found.select(*empty.columns)


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th vector, with the labels of every 7th moved on by one."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM met WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT
         AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN met USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
