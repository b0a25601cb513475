"""Polled snapshots as a stream of deduplicated messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from hearthstream import schemas
from hearthstream.functions import record_date
from hearthstream.operators import ingest as I
from hearthstream.operators.days import day_bitmap, day_filter, outside_days
from hearthstream.operators.envelope import last_header
from hearthstream.plans.ingest import shape_snapshots
from hearthstream.sources.files import distinct_keys, publish_to_files


def ingest_stream(
    snapshots: DataFrame, sensors: DataFrame, published_path: str, checkpoint: str
) -> DataStreamWriter:
    """Publish each ``lsid:ts`` once, across batches and restarts.

    The published messages themselves are the memory: each batch is anti-joined
    with the keys of its own days, so the cost follows the batch and not the
    history.
    """
    spark = snapshots.sparkSession

    def published(batch: DataFrame) -> DataFrame:
        path = spark._jvm.org.apache.hadoop.fs.Path(published_path)
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return schemas.empty(spark, schemas.MESSAGE_DDL)
        points = I.keyed_points(I.explode_points(batch))
        found = points.agg(
            day_bitmap(F.col("ts")).alias("days"), outside_days(F.col("ts")).alias("outside")
        ).first()
        stored = spark.read.schema(f"{schemas.MESSAGE_DDL}, dt date").parquet(published_path)
        return stored.where(day_filter(F.col("dt"), found["days"], found["outside"] > 0))

    def apply(batch: DataFrame, _: int) -> None:
        kept = batch.persist()
        try:
            fresh = shape_snapshots(kept, sensors, distinct_keys(published(kept)))
            # The record time is the second part of the key and also a header.
            day = record_date(last_header("timestamp").try_cast("bigint"))
            publish_to_files(fresh, published_path, day=day)
        finally:
            kept.unpersist()

    return snapshots.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
