"""Order-sensitive scans that do not put a whole group into one task.

A plain window over ``PARTITION BY key`` sorts every row of a key in a single
task.  Here a key's history is cut into chunks of its order column, each chunk
is scanned on its own, and what one chunk hands to the next (its last row, its
maximum, its sum) is computed from one small summary row per chunk.  The result
is exactly that of the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"


def with_chunk(df: DataFrame, position: Column, width: int) -> DataFrame:
    """Add the chunk number of a numeric position (epoch seconds, a tick, ...)."""
    return df.withColumn(CHUNK, F.floor(position / F.lit(width)).cast("bigint"))


def _join_summary(df: DataFrame, summary: DataFrame, keys: list[str], value: str) -> DataFrame:
    names = [*keys, CHUNK]
    right = summary.select(*[F.col(c).alias(f"_s_{c}") for c in names], value)
    condition = F.lit(True)
    for c in names:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    return df.join(right, condition, "left").drop(*[f"_s_{c}" for c in names])


def previous_row(
    df: DataFrame, keys: list[str], order: list[str], values: list[str], out: str
) -> DataFrame:
    """``lag(struct(values))`` per key.  ``df`` must carry a chunk column."""
    row = F.struct(*values)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    tails = df.groupBy(*keys, CHUNK).agg(F.max_by(row, F.struct(*order)).alias("_tail"))
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    carried = tails.select(*keys, CHUNK, F.lag("_tail").over(across).alias("_carry"))
    return (
        _join_summary(df.withColumn("_inside", F.lag(row).over(inside)), carried, keys, "_carry")
        .withColumn(out, F.coalesce("_inside", "_carry"))
        .drop("_inside", "_carry")
    )


def max_before(
    df: DataFrame, keys: list[str], order: list[str], value: str, out: str
) -> DataFrame:
    """Running maximum over all earlier rows of the key, NULL on its first row."""
    inside = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    across = (
        Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        df.groupBy(*keys, CHUNK)
        .agg(F.max(value).alias("_m"))
        .select(*keys, CHUNK, F.max("_m").over(across).alias("_carry"))
    )
    # greatest() skips NULLs, so a missing side does not hide the other one.
    return (
        _join_summary(
            df.withColumn("_inside", F.max(value).over(inside)), carried, keys, "_carry"
        )
        .withColumn(out, F.greatest("_inside", "_carry"))
        .drop("_inside", "_carry")
    )


def running_sum(
    df: DataFrame, keys: list[str], order: list[str], value: str, out: str
) -> DataFrame:
    """Running sum up to and including the row."""
    inside = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    across = (
        Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        df.groupBy(*keys, CHUNK)
        .agg(F.sum(value).alias("_s"))
        .select(*keys, CHUNK, F.coalesce(F.sum("_s").over(across), F.lit(0)).alias("_carry"))
    )
    return (
        _join_summary(
            df.withColumn("_inside", F.sum(value).over(inside)), carried, keys, "_carry"
        )
        .withColumn(out, F.col("_inside") + F.col("_carry"))
        .drop("_inside", "_carry")
    )
