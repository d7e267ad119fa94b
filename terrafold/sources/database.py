"""Reading feature tables out of a database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, partition_column: str,
               lower: int, upper: int, partitions: int, **options: str) -> DataFrame:
    """A table in ``partitions`` range reads of a numeric column; rows outside
    the bounds land in the first and last read, none is lost."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in options.items():
        reader = reader.option(k, v)
    return (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
            .option("upperBound", upper).option("numPartitions", partitions).load())
