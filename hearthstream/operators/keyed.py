"""First and last arrival per key, insert-if-absent, upsert and surrogate ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick(
    df: DataFrame, keys: list[str], order: Column, chooser, keep: list[str] | None
) -> DataFrame:
    rest = [c for c in df.columns if c not in keys] if keep is None else keep
    if not rest:
        return df.select(*keys).dropDuplicates(keys)
    picked = df.groupBy(*keys).agg(chooser(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, "_row.*").select(
        *[c for c in df.columns if c in keys or c in rest]
    )


def first_wins(
    df: DataFrame, keys: list[str], order: Column, keep: list[str] | None = None
) -> DataFrame:
    """Keep the first row per key (all columns, or the keys and ``keep``).

    An aggregate, so every map task first reduces its own rows to one per key:
    a key that holds a third of the input still shuffles one row per task.
    """
    return _pick(df, keys, order, F.min_by, keep)


def last_wins(
    df: DataFrame, keys: list[str], order: Column, keep: list[str] | None = None
) -> DataFrame:
    """Keep the last row per key, with the same map-side reduction."""
    return _pick(df, keys, order, F.max_by, keep)


def absent_from(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing`` (keys compare null-safely)."""
    probe = existing.select(*[F.col(k).alias(f"_have_{k}") for k in keys])
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_have_{k}"))
    return new.join(probe, condition, "left_anti")


def assign_ids(
    new_rows: DataFrame, keys: list[str], after: Column, id_column: str = "id",
    buckets: int | None = None,
) -> DataFrame:
    """Dense serial ids for rows with distinct keys, starting at ``after`` + 1.

    Numbering through one global window would drag all rows through one task.
    Instead rows are numbered inside hash buckets, and each bucket starts where
    the ones before it end.  Only the per-bucket counts (at most ``buckets``
    rows, by default four per shuffle partition) meet in one place.  The result
    depends on the keys and the number of buckets, so a retried task or batch
    produces the same ids.
    """
    if buckets is None:
        conf = new_rows.sparkSession.conf
        buckets = max(256, 4 * int(conf.get("spark.sql.shuffle.partitions")))
    bucketed = new_rows.withColumn(
        "_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    )
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy("_bucket").orderBy(*keys)
    return (
        bucketed.withColumn("_rank", F.row_number().over(within))
        .join(offsets, "_bucket")
        .withColumn(id_column, (after + F.col("_offset") + F.col("_rank")).cast("bigint"))
        .drop("_bucket", "_rank", "_offset")
    )


def next_id_base(existing: DataFrame, id_column: str = "id") -> Column:
    """The largest id in use (0 when empty), as a scalar subquery."""
    return existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("m")).scalar()


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    merged: dict[str, Column],
    id_column: str | None = "id",
) -> DataFrame:
    """Overwrite known keys and insert new ones; ``incoming`` has one row per key.

    ``merged`` maps columns to expressions over ``old.<c>`` and ``new.<c>``; for
    an inserted row every old value is NULL.  Columns not named there keep the
    old value.  New keys receive serial ids.
    """
    def row(c: str) -> Column:
        if c in keys:
            value = F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}"))
        elif c in merged:
            value = F.when(F.col("new._hit"), merged[c]).otherwise(F.col(f"old.{c}"))
        else:
            value = F.col(f"old.{c}")
        return value.cast(existing.schema[c].dataType).alias(c)

    def same_key() -> Column:
        condition = F.lit(True)
        for k in keys:
            condition = condition & F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}"))
        return condition

    new = incoming.withColumn("_hit", F.lit(True)).alias("new")
    old = existing.alias("old")
    kept = old.join(new, same_key(), "left").select(*[row(c) for c in existing.columns])
    nothing = existing.where(F.lit(False)).alias("old")
    fresh = (
        new.join(old, same_key(), "left_anti")
        .alias("new")
        .join(nothing, same_key(), "left")
        .select(*[row(c) for c in existing.columns])
    )
    if id_column is not None:
        fresh = assign_ids(
            fresh.drop(id_column), keys, next_id_base(existing, id_column), id_column
        ).select(*existing.columns)
    return kept.unionByName(fresh)
