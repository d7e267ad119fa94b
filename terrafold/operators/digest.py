"""Comparing tables without regard to row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrafold.workspace import stored

FLOATS = (T.FloatType, T.DoubleType)


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, FLOATS)]


def exact(df: DataFrame, name: str) -> Column:
    """A column in a form whose equality is identity: -0.0 and 0.0 differ as text."""
    c = F.col(f"`{name}`")
    return c.cast("string") if isinstance(df.schema[name].dataType, FLOATS) else c


def row_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """64-bit hash of a row. Null flags go in too, because the hash skips NULLs
    and would not see a value move into a neighbouring NULL."""
    parts: list[Column] = []
    for name in columns or df.columns:
        parts += [F.col(f"`{name}`").isNull(), exact(df, name)]
    return F.xxhash64(*parts)


def digest_columns(df: DataFrame, columns: list[str] | None = None) -> list[Column]:
    h = row_hash(df, columns)
    return [F.count("*").alias("n_rows"),
            F.sum(h.cast("decimal(38,0)")).alias("hash_sum"),
            F.bit_xor(h).alias("hash_xor")]


def table_digest(df: DataFrame) -> DataFrame:
    """One row: row count, sum and xor of the row hashes."""
    return df.agg(*digest_columns(df))


def special_columns(df: DataFrame) -> list[Column]:
    out = []
    for name in float_columns(df):
        c = F.col(f"`{name}`")
        out += [F.count_if(c.cast("string") == "-0.0").alias(f"{name}__minus_zero"),
                F.count_if(F.isnan(c)).alias(f"{name}__nan")]
    return out


def float_specials(df: DataFrame) -> DataFrame:
    """(column, minus_zero, nan), one row per float column, from one pass."""
    names = float_columns(df)
    if not names:
        raise ValueError("the table has no float column")
    counted = df.agg(*special_columns(df))
    rows = F.array(*[F.struct(F.lit(n).alias("column"),
                              F.col(f"`{n}__minus_zero`").alias("minus_zero"),
                              F.col(f"`{n}__nan`").alias("nan")) for n in names])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def except_both(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one table without a partner in the other, duplicates counted.

    Signs are summed by a 128-bit hash of the row, so only hashes cross the
    network; whole rows are fetched and compared, value by value, where a sum is
    not zero. Copies of a row shrink to one count first, so a third of a table
    being one row is no hot task. Floats are compared as text: otherwise a lost
    -0.0 goes unseen.
    """
    names = [f"`{c}`" for c in left.columns]

    def signed(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select(*[exact(df, n).alias(n) for n in left.columns], F.lit(sign).alias("__n"))
        # NULLs are skipped by the hash, so their places take part too.
        nulls = [F.col(n).isNull() for n in names]
        return rows.withColumns({"__h": F.xxhash64(*nulls, *names),
                                 "__g": F.xxhash64(F.lit(1), *reversed(names), *nulls)})

    both = signed(left, 1).unionAll(signed(right, -1))
    net = stored(both.groupBy("__h", "__g").agg(F.sum("__n").alias("__n"))
                 .where(F.col("__n") != 0).drop("__n"), "unpaired")
    sums = both.join(net, ["__h", "__g"], "left_semi").groupBy(*names).agg(
        F.sum("__n").alias("__n")).where(F.col("__n") != 0)
    return sums.select(
        F.when(F.col("__n") > 0, "left").otherwise("right").alias("only_in"),
        F.abs("__n").alias("copies"), *names)


def null_safe_diff(left: Column, right: Column) -> Column:
    return ~left.eqNullSafe(right)
