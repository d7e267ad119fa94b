"""Token ids in Parquet: list columns, dictionary and delta encoding, page indexes.

Rows lie in ascending doc_id order. Ids are a dictionary-encoded list column,
the whole-number columns are delta-encoded, row groups and pages are kept small
so that the page index lets a reader fetch the ids of few documents, or only the
metadata of all, without touching the rest. Places in the whole token stream are
not written into the rows: each carries its place in its part, and the parts'
bases, a few rows, are summed when the store is read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrafold.llm.common import bounded, column_of, slices, table, text_of
from terrafold.llm.tokens import WORD_VOCABULARY, encoder
from terrafold.workspace import new_path, stored

ROW_GROUP_BYTES = 16 << 20
PAGE_ROWS = 500
END_ID = 1


def ids_column(packed: list[bytes]) -> pa.ListArray:
    """Packed little-endian ids as a list column of 32-bit integers."""
    offsets = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets),
                                    pa.array(np.frombuffer(b"".join(packed), "<i4")))


def packed_of(ids: pa.ListArray) -> list[bytes]:
    """The inverse of ``ids_column``; a null list is empty."""
    offsets = ids.offsets.to_numpy()
    values = ids.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(
        zero_copy_only=False).astype("<u4", copy=False)
    offsets = offsets - offsets[0]
    return [b"" if null else values[a:b].tobytes() for a, b, null in zip(
        offsets[:-1].tolist(), offsets[1:].tolist(), ids.is_null().to_pylist())]


def raw_texts(texts: pa.Array) -> list[bytes]:
    """A non-null text column's values in UTF-8."""
    return texts.cast(pa.binary()).to_pylist()


def write_tokens(docs: DataFrame, path: str, vocabulary: str = WORD_VOCABULARY,
                 end_id: int | None = END_ID) -> None:
    """Encode every text and write doc_id, part, part_start, n_tokens, ids to ``path``.

    Null counts as the empty text, which leaves the end id alone. Rows are in
    ascending doc_id order, null ids first; rows with one id are ordered by
    their text's hash, repeated rows all stay. An empty table gives no rows.
    """
    def run(batches):
        part, start, tool = TaskContext.get().partitionId(), 0, encoder(vocabulary)
        for batch in batches:
            texts = column_of(batch, "text")
            for a, b in slices(texts):
                packed = tool.encode(raw_texts(texts.slice(a, b - a)), end_id)
                sizes = np.array([len(p) // 4 for p in packed], np.int64)
                ends = start + np.cumsum(sizes)
                start = int(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [column_of(batch, "doc_id").slice(a, b - a),
                     pa.array(np.full(len(packed), part, np.int64)), pa.array(ends - sizes),
                     pa.array(sizes), ids_column(packed)],
                    ["doc_id", "part", "part_start", "n_tokens", "ids"])

    rows = docs.select("doc_id", text_of().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # The row's number only deals out rows that are alike.
    order = ["doc_id", "__tie", "__row"]
    ordered = (rows.withColumn("__tie", F.xxhash64("text"))
               .withColumn("__row", F.monotonically_increasing_id())
               .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"))
    (ordered.mapInArrow(run, f"doc_id {kind}, part bigint, part_start bigint, n_tokens bigint, "
                             "ids array<int>")
     .write.option("parquet.block.size", ROW_GROUP_BYTES)
     .option("parquet.page.row.count.limit", PAGE_ROWS)
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", "false")
     .option("parquet.enable.dictionary#ids.list.element", "true")
     .option("compression", "zstd").parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids; ``start`` counts the ids of all documents before.

    Select and filter as usual: columns left out are not read, a range of
    doc_id is looked up in the page index.
    """
    rows = spark.read.parquet(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("__n"))
    # One row a part, not a document: few enough to be summed in order.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    return rows.join(bounded(stored(bases, "bases")), "part").select(
        "doc_id", (F.col("__base") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def checked(tokens: DataFrame, carried: list[str]) -> DataFrame:
    """``carried`` columns with ids_crc32, the crc32 of the ids as unsigned 32-bit integers."""
    def run(batches):
        for batch in batches:
            sums = [zlib.crc32(p) for p in packed_of(column_of(batch, "ids"))]
            yield pa.RecordBatch.from_arrays(
                [*[column_of(batch, c) for c in carried], pa.array(sums, pa.int64())],
                [*carried, "ids_crc32"])

    kinds = ", ".join(f"{c} {tokens.schema[c].dataType.simpleString()}" for c in carried)
    return tokens.select(*carried, "ids").mapInArrow(run, f"{kinds}, ids_crc32 bigint")


def op7_token_store(spark, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the store."""
    path = new_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return checked(read_tokens(spark, path), ["doc_id", "start", "n_tokens"])
