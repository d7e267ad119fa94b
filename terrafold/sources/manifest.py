"""Checksum manifests: what files are there, their sizes and MD5 digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.sources.filesystem import list_files, resolve

CHUNK = 1 << 22


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for uri in batch.column("path").to_pylist():
            system, path = resolve(uri)
            h = hashlib.md5()
            with system.open_input_stream(path) as f:
                while chunk := f.read(CHUNK):
                    h.update(chunk)
            found.append(h.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("name"), batch.column("length"), pa.array(found, pa.string())],
            names=["name", "size", "digest"])


def manifest(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(name, size, digest) of the files under ``root``, names relative to it.

    Files are streamed in chunks where they are listed, so size does not matter
    to memory; one file is one task's work because MD5 runs front to back.
    """
    return list_files(spark, root, glob).mapInArrow(
        _digests, "name string, size bigint, digest string")


def numbered(files: DataFrame) -> DataFrame:
    """Manifest lines in name order: one row a file, so a single ordered pass is small."""
    return files.select("name", "size", "digest",
                        F.concat("digest", F.lit("  "), "name").alias("line")).orderBy("name")


def drift(recorded: DataFrame, actual: DataFrame) -> DataFrame:
    """(name, status): every file whose recorded and actual digests disagree."""
    both = recorded.select("name", F.col("digest").alias("was")).join(
        actual.select("name", F.col("digest").alias("is")), "name", "full_outer")
    status = (F.when(F.col("is").isNull(), "missing").when(F.col("was").isNull(), "unrecorded")
              .otherwise("changed"))
    return both.where(~F.col("was").eqNullSafe(F.col("is"))).select(
        "name", status.alias("status"))


def sizes(files: DataFrame) -> DataFrame:
    """(table, files, bytes) by the first part of each name."""
    table = F.regexp_replace(F.split("name", "/")[0], r"\.parquet$", "")
    return files.groupBy(table.alias("table")).agg(
        F.count("*").alias("files"), F.sum("size").alias("bytes"))
