"""Bounded replay of an envelope table: metadata first, then data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthstream.operators.envelope import offset_range
from hearthstream.operators.ingest import (
    CATALOG_TOPIC,
    RECORD_TOPICS,
    SENSORS_TOPIC,
    STATION_TOPIC,
    STRICT_RECORD_TOPICS,
)
from hearthstream.operators.orphans import pending_orphans
from hearthstream.plans.materialize import Summary, materialize
from hearthstream.plans.metadata import apply_catalog, apply_metadata
from hearthstream.sources.tables import Tables

EARLIEST = -2
LATEST = -1


def replay(
    messages: DataFrame,
    tables: Tables,
    topics: list[str] | None = None,
    start: int = EARLIEST,
    end: int = LATEST,
    include_metadata: bool = False,
    partition: int | None = None,
    now: Column | None = None,
    strict_topics: bool = False,
) -> Summary:
    """Replay a range of offsets.

    The metadata phase runs in foreign-key order (sensors, catalog, station)
    before any record is read.  All data topics are then one job: its
    parallelism is the number of input partitions.  Every partition of a topic
    is read unless one is named; ``strict_topics`` leaves out the topic of
    uncategorized sensors.
    """
    ranged = offset_range(messages, start, end)
    if partition is not None:
        ranged = ranged.where(F.col("partition") == partition)
    if include_metadata:
        apply_metadata(ranged.where(F.col("topic") == SENSORS_TOPIC), tables, now)
        apply_catalog(ranged.where(F.col("topic") == CATALOG_TOPIC), tables, False, now)
        apply_metadata(ranged.where(F.col("topic") == STATION_TOPIC), tables, now)
    data = ranged.where(F.col("topic").isin(topics or (STRICT_RECORD_TOPICS if strict_topics else RECORD_TOPICS)))
    return materialize(data, tables, replay=True, now=now)


def replay_summary(summary: Summary, tables: Tables) -> DataFrame:
    """(metric, value) of a finished replay, with the orphans still pending."""
    rows = [(k, summary[k]) for k in ("processed", "errors", "numeric", "text", "null")]
    spark = tables.spark
    pending = pending_orphans(tables.orphans(["reason"])).agg(
        F.lit("orphaned").alias("metric"), F.count(F.lit(1)).alias("value")
    )
    return spark.createDataFrame(rows, "metric string, value bigint").unionByName(pending)
