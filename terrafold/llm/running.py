"""Running totals over a whole ordered table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.workspace import stored


def running(rows: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """``rows`` with ``out``, the sum of ``value`` over all rows before in ``order``.

    Rows are dealt out by range; only one total a range is summed in one task.
    ``order`` should tell rows apart; rows alike in it are taken in any order.
    """
    ranged = stored(rows.repartitionByRange(*order)
                    .withColumn("__range", F.spark_partition_id()), "ranged")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    bases = (ranged.groupBy("__range").agg(F.sum(value).alias("__sum"))
             .select("__range", F.coalesce(F.sum("__sum").over(before.orderBy("__range")),
                                           F.lit(0)).alias("__base")))
    inside = F.coalesce(F.sum(value).over(before.partitionBy("__range").orderBy(*order)), F.lit(0))
    return (ranged.join(bases, "__range").withColumn(out, F.col("__base") + inside)
            .drop("__range", "__base"))
