"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.operators.skew import even
from terrafold.workspace import attach

# A key with more than 1/HOT_SHARE of all rows is hot; there are fewer than
# HOT_SHARE such keys whatever the table's size, which bounds their broadcast.
HOT_SHARE = 1024
# Narrow tables of up to this many rows are broadcast, larger ones shuffled.
BROADCAST_ROWS = 1_000_000
# Texts are handed to Python code in slices of about this many bytes.
SLICE_BYTES = 2 << 20

# Batches that go to and from Python are at most about this large. Spark's own limit
# of 64 MB would hold thousands of texts several times over in one executor.
BATCH_BYTES = "4m"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def prepare(spark) -> None:
    """Ship the package and bound the session's Arrow batches; every query begins with it."""
    attach(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def digest_of(column: str = "text") -> Column:
    """SHA-256 of a text column in UTF-8, 32 bytes."""
    return F.unhex(F.sha2(text_of(column), 256))


def crc32_of_id(column: str) -> Column:
    """crc32 of an id written as decimal text; null ids count as 0."""
    return F.crc32(F.coalesce(F.col(column), F.lit(0)).cast("string"))


def join_spread(many: DataFrame, one: DataFrame, key: str, weight: str,
                how: str = "left") -> DataFrame:
    """``many`` joined with ``one`` on ``key``, even when few keys hold most rows.

    ``one`` has one row a key, its column ``weight`` (dropped from the result)
    says how many rows of ``many`` carry the key. Keys with more than
    1/HOT_SHARE of the summed weight, fewer than HOT_SHARE by arithmetic, are
    joined map-side; the others are shuffled. ``how`` is left or inner. Both
    sides are read more than once and should be stored tables. Keys are not null.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"cannot spread a {how} join")
    total = one.agg(F.sum(weight)).first()[0] or 0
    hot = one.where(F.col(weight) * HOT_SHARE > F.lit(total))
    cold = one.where(F.col(weight) * HOT_SHARE <= F.lit(total)).drop(weight)
    if hot.isEmpty():
        return many.join(even(one.drop(weight)), key, how)
    hot = hot.drop(weight)
    taken = many.join(F.broadcast(hot), key, "inner")
    rest = many.join(F.broadcast(hot.select(key)), key, "left_anti").join(even(cold), key, how)
    return taken.unionByName(rest)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if a count shows that it has ``rows`` rows or fewer."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of texts of about ``most`` bytes together, one text at least."""
    start, held = 0, 0
    for i, size in enumerate(_lengths(texts)):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def _lengths(texts: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_pylist()


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
