"""Equi-joins that stay even when one key holds a large share of the rows.

Rows are counted per key, aggregated before they move, and the keys with more
rows than a task should take are kept as a table with the salts they need. Their
rows are spread over the salts on the many side and repeated per salt on the
other; all other keys join as usual. The counts only decide the plan: every row
still meets every partner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.workspace import stored

# A key with more rows than this is split into salts of this size.
TASK_ROWS = 2_000_000
# Heavy keys up to this many are broadcast to both sides, more are joined by key.
BROADCAST_KEYS = 100_000

# Tables that Spark estimates smaller are dealt out evenly where a row makes much work.
SMALL_BYTES = 256 << 20

_SALT = "__salt"
_SALTS = "__salts"


def dealt(df: DataFrame) -> DataFrame:
    """``df`` over all cores if it is small: a small table comes in few splits.

    Goes by the optimizer's own estimate, without a job; larger tables have
    splits enough and are left where they are.
    """
    if df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() >= SMALL_BYTES:
        return df
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def even(df: DataFrame) -> DataFrame:
    """``df`` as the right side of a join that shuffles both, whatever size Spark takes it for.

    The estimate goes by bytes in files and knows neither encodings nor explodes, so
    that what passes for 10 MB may hold a hundred times as much; a broadcast takes all
    of it through the driver.
    """
    return df.hint("merge")


def heavy_keys(df: DataFrame, keys: list[str],
               task_rows: int = TASK_ROWS) -> dict[str, DataFrame]:
    """Per key column a stored table (key, __salts) of the keys over ``task_rows`` rows.

    Such a table has at most rows / ``task_rows`` entries.
    """
    return {k: heavy_counted(df.select(F.col(f"`{k}`").alias(k), F.lit(1).alias("__n")), k, task_rows)
            for k in keys}


def heavy_counted(counts: DataFrame, key: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """``heavy_keys`` of rows that stand for ``__n`` rows each."""
    sums = counts.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("__n").alias("__n"))
    return stored(sums.where(F.col("__n") > task_rows).select(
        key, F.ceil(F.col("__n") / task_rows).cast("int").alias(_SALTS)), "heavy")


def join_spread(many: DataFrame, few: DataFrame, key: str, how: str = "inner", *,
                spread_by: list[str], heavy: DataFrame | None = None,
                task_rows: int = TASK_ROWS) -> DataFrame:
    """``many.join(few, key, how)`` with the heavy keys of ``many`` salted.

    ``how`` is inner, left, left_semi or left_anti. ``spread_by`` names columns
    of ``many`` that tell rows of one key apart; the salt is their hash, so a
    task that runs again puts each row where it went the first time.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    if heavy is None:
        heavy = heavy_keys(many, [key], task_rows)[key]
    n = heavy.limit(BROADCAST_KEYS + 1).count()
    if not n:
        return many.join(even(few), key, how)
    salts = F.broadcast(heavy) if n <= BROADCAST_KEYS else heavy
    columns = many.columns
    salt = F.coalesce(F.pmod(_hash(spread_by), F.col(_SALTS).cast("bigint")).cast("int"),
                      F.lit(0))
    many = many.join(salts, key, "left").withColumn(_SALT, salt).drop(_SALTS)
    top = F.coalesce(F.col(_SALTS), F.lit(1)) - 1
    few = (few.join(salts, key, "left")
           .withColumn(_SALT, F.explode(F.sequence(F.lit(0), top))).drop(_SALTS))
    joined = many.join(even(few), [key, _SALT], how).drop(_SALT)
    rest = [c for c in joined.columns if c not in columns]
    return joined.select(*[F.col(f"`{c}`") for c in columns + rest])


def _hash(columns: list[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def semi_spread(many: DataFrame, keys: DataFrame, key: str, **kw) -> DataFrame:
    """Rows of ``many`` whose key occurs in ``keys`` (repeats there do not matter)."""
    return join_spread(many, keys.select(key).distinct(), key, "left_semi", **kw)


def numbered(df: DataFrame, key: str, order: list[str], place: str, total: str) -> DataFrame:
    """``df`` with the place of each row in its key, from 0, and the key's number of rows.

    Rows are dealt out by range of (key, order), so a large key fills many ranges;
    only the keys that cross a border, at most one a border, need the other
    ranges' counts.
    """
    ranged = stored(df.repartitionByRange(F.col(key).asc_nulls_first(), *order)
                    .withColumn("__range", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("__range", key).agg(F.count("*").alias("__n"))
    wide = Window.partitionBy(key)
    crossing = stored(sizes.select(
        "__range", F.col(key).alias("__key"),
        F.coalesce(F.sum("__n").over(wide.orderBy("__range").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.sum("__n").over(wide).alias("__all"), F.count("*").over(wide).alias("__ranges"))
        .where(F.col("__ranges") > 1).drop("__ranges"), "crossing")
    here = Window.partitionBy("__range", key)
    local = ranged.withColumn(place, F.row_number().over(here.orderBy(*order)) - 1).withColumn(
        total, F.count("*").over(here))
    met = local.join(F.broadcast(crossing.withColumnRenamed("__range", "__r")),
                     (F.col("__range") == F.col("__r")) & F.col(key).eqNullSafe(F.col("__key")),
                     "left")
    return met.withColumns({
        place: F.col(place) + F.coalesce("__before", F.lit(0)),
        total: F.coalesce("__all", F.col(total))}).select(*df.columns, place, total)
