"""Helpers shared by the operators: tables, batches, words and number codes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthstream.session import cut_lineage, ship

# Rows per Arrow batch.  Texts can be long, so batches are short.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package and keep Arrow batches of long texts small."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back."""
    return cut_lineage(df, f"llm-{label}")


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return df.mapInArrow(work, schema)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a column, null as the empty text."""
    return [t or "" for t in column.to_pylist()]


_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of unsigned 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


def with_id(df: DataFrame, id_column: str, *rest: str) -> DataFrame:
    """The id and the named columns of the rows that have an id.

    Selecting them by name keeps extra columns, whatever they are called, out
    of the operator.
    """
    return df.select(id_column, *rest).where(F.col(id_column).isNotNull())


def range_bucket(value: Column, cuts: list[int]) -> Column:
    """Number of distinct cut points below ``value``: range partitions with fixed bounds."""
    cuts = sorted(set(cuts))

    def below(lo: int, hi: int) -> Column:
        # Balanced comparisons, so a row costs log2 of the number of cuts.
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value <= cuts[mid], below(lo, mid)).otherwise(below(mid + 1, hi))

    return below(0, len(cuts)).cast("int")
