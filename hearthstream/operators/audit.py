"""Integrity checks, message statistics and metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream.operators.ordered import previous_row, with_chunk

DAYS_PER_YEAR = 365


def counted(**tables: DataFrame) -> DataFrame:
    """(table_name, count) of several tables."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias("table_name"), "count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def duplicate_records(records: DataFrame) -> DataFrame:
    """Keys stored more than once within one kind; empty when all is well."""
    return (
        records.groupBy("kind", "tag_id", "ts")
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > 1)
    )


def integrity_audit(devices: DataFrame, tags: DataFrame, records: DataFrame) -> DataFrame:
    """Dangling references: tags without device, records of each kind without tag."""
    loose_tags = tags.join(devices.select(F.col("id").alias("device_id")), "device_id", "left_anti")
    tag_check = loose_tags.agg(F.count(F.lit(1)).alias("dangling")).select(
        F.lit("tags").alias("table_name"), "dangling"
    )
    # One scan of the facts for all kinds, reduced to one row per tag before the join.
    per_tag = records.groupBy("kind", "tag_id").agg(F.count(F.lit(1)).alias("n"))
    loose = per_tag.join(tags.select(F.col("id").alias("tag_id")), "tag_id", "left_anti")
    totals = loose.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k)
            for k in ("numeric", "text", "null")
        ]
    )
    record_check = totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f"records_{k}").alias("table_name"), F.col(k).alias("dangling")
                    )
                    for k in ("numeric", "text", "null")
                ]
            )
        )
    )
    return tag_check.unionByName(record_check)


def topic_sizes(messages: DataFrame) -> DataFrame:
    """Low and high (exclusive) offset and their distance per topic and partition."""
    return (
        messages.groupBy("topic", "partition")
        .agg(F.min("offset").alias("low"), (F.max("offset") + 1).alias("high"))
        .withColumn("size", F.col("high") - F.col("low"))
    )


def topic_progress(messages: DataFrame, end_offset: int = -1) -> DataFrame:
    """First and next offset, message count and percent of the range per topic."""
    progress = messages.groupBy("topic").agg(
        F.min("offset").alias("start_offset"),
        (F.max("offset") + 1).alias("current_offset"),
        F.count(F.lit(1)).alias("messages"),
    )
    total = F.lit(end_offset) - F.col("start_offset")
    return progress.withColumn(
        "percent",
        F.when(
            total > 0,
            F.round((F.col("current_offset") - F.col("start_offset")) / total * 100.0, 1),
        ),
    )


def unit_coverage(tags: DataFrame, catalog: DataFrame) -> DataFrame:
    """Tags, tags with a unit, and the size of the catalog."""
    size = catalog.agg(F.count(F.lit(1)).alias("n")).scalar()
    return tags.agg(
        F.count(F.lit(1)).alias("tags"), F.count("unit").alias("tags_with_unit")
    ).withColumn("catalog_entries", size)


def storage_projection(messages: DataFrame, ratio: float = 1.0) -> DataFrame:
    """Megabytes per year from sensors, messages per sensor and day, and body size.

    Device and day counts come from one pre-aggregation by (device, day).
    """
    per_day = messages.groupBy(
        "lsid", F.floor(F.col("record_ts") / 86400).alias("day")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length("value")).alias("bytes"),
    )
    totals = per_day.agg(
        F.countDistinct("lsid").alias("sensors"),
        F.countDistinct("day").alias("days"),
        F.sum("n").alias("messages"),
        F.sum("bytes").alias("bytes"),
    )
    per_sensor_day = F.col("messages") / F.col("sensors") / F.col("days")
    average = F.col("bytes") / F.col("messages")
    return totals.withColumn(
        "mb_per_year",
        F.col("sensors") * per_sensor_day * DAYS_PER_YEAR * average * F.lit(ratio) / F.lit(1e6),
    )


def metric_deltas(metrics: DataFrame, chunk: int = 1440) -> DataFrame:
    """Each metric's growth since the previous tick (the value itself on the first)."""
    chunked = with_chunk(metrics, F.col("tick"), chunk)
    before = previous_row(chunked, ["metric"], ["tick"], ["value"], "_before")
    return before.withColumn(
        "delta", F.col("value") - F.coalesce(F.col("_before.value"), F.lit(0))
    ).drop("_before", "_chunk")


def cumulative_metrics(batches: DataFrame) -> DataFrame:
    """Per-batch counters turned into totals, in (metric, tick, value) rows."""
    from hearthstream.operators.ordered import running_sum

    chunked = with_chunk(batches, F.col("tick"), 1440)
    return running_sum(chunked, ["metric"], ["tick"], "n", "value").select(
        "metric", "tick", "value"
    )
