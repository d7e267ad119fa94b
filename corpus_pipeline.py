"""From raw documents to packed training sequences, stage by stage.

Every stage works on all that its predecessor kept and calls one operator; its
result is written as Parquet and read again. All but the last return the columns
of the documents they keep.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from terrafold.llm import (  # noqa: E402
    decontaminate,
    exact_dedup,
    language_id,
    packing,
    simhash,
)
from terrafold.llm.common import prepare, table  # noqa: E402
from terrafold.workspace import new_path  # noqa: E402


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without letters, or like no known language, go."""
    prepare(spark)
    return language_id.known_language(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the document with the largest id stays."""
    prepare(spark)
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group the document with the smallest id stays."""
    prepare(spark)
    return simhash.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: documents that hold a window of a benchmark item go."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of all documents that are left, with their token ids."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("decontamination", benchmark_leaks),
    ("packing", packed),
]

# Fingerprints and token ids have no SQL form; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the pieces of the last one."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
