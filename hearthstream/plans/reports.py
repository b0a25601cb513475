"""The reporting queries over devices, tags, records and orphans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream.functions import epoch_to_timestamp
from hearthstream.operators.orphans import pending_orphans
from hearthstream.operators.records import records_view
from hearthstream.session import cut_lineage
from hearthstream.sources.tables import Tables


def table_stats(
    devices: DataFrame, tags: DataFrame, records: DataFrame, orphans: DataFrame
) -> DataFrame:
    """(type, count as text) of devices, tags, the three kinds, pending orphans.

    The kinds are counted in one pass over the fact table's partition column.
    """
    def total(label: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("type"), "n")

    kinds = {"numeric": "Numeric Records", "text": "Text Records", "null": "Null Records"}
    by_kind = records.agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds]).select(
        F.inline(
            F.array(
                *[F.struct(F.lit(v).alias("type"), F.col(k).alias("n")) for k, v in kinds.items()]
            )
        )
    )
    parts = [
        total("Devices", devices),
        total("Tags", tags),
        by_kind,
        total("Orphaned (pending)", pending_orphans(orphans)),
    ]
    return reduce(DataFrame.unionByName, parts).select(
        "type", F.col("n").cast("string").alias("count")
    )


def device_list(devices: DataFrame, tags: DataFrame) -> DataFrame:
    """Devices with the number of their tags, by device number."""
    counts = tags.groupBy("device_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        devices.select("id", "lsid", "category", "product_name")
        .join(counts.withColumnRenamed("device_id", "id"), "id", "left")
        .select("lsid", "category", "product_name", F.coalesce("n", F.lit(0)).alias("tags"))
        .orderBy("lsid")
    )


def tags_per_device(devices: DataFrame, tags: DataFrame) -> DataFrame:
    """Left outer join counted per device; devices without tags count 0."""
    per_device = tags.groupBy("device_id").agg(F.count("id").alias("n"))
    return (
        devices.select("id", "lsid", "category")
        .join(per_device.withColumnRenamed("device_id", "id"), "id", "left")
        .select("lsid", "category", F.coalesce("n", F.lit(0)).alias("tag_count"))
        .orderBy("lsid")
    )


def tag_record_counts(
    devices: DataFrame, tags: DataFrame, records: DataFrame, lsid: int | None = None
) -> DataFrame:
    """Records of all kinds per tag, of one device or of all.

    For one device the tag list is semi-joined first, so only its records are
    shuffled; the count itself is reduced in every map task.
    """
    owner = devices if lsid is None else devices.where(F.col("lsid") == lsid)
    wanted = tags.join(
        owner.select(F.col("id").alias("device_id"), "lsid"), "device_id"
    ).select(F.col("id").alias("tag_id"), "lsid", "tag_name", "data_type")
    facts = records.select("tag_id")
    if lsid is not None:
        facts = facts.join(wanted.select("tag_id"), "tag_id", "left_semi")
    counts = facts.groupBy("tag_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        wanted.join(counts, "tag_id", "left")
        .select("lsid", "tag_name", "data_type", F.coalesce("n", F.lit(0)).alias("record_count"))
        .orderBy("lsid", "tag_name")
    )


def joined_records(records: DataFrame, tags: DataFrame, devices: DataFrame) -> DataFrame:
    """Records view with tag and device columns.

    Tags and devices are joined first: one lookup of the facts instead of two.
    """
    return records_view(records).join(_labels(tags, devices), "tag_id")


def _labels(tags: DataFrame, devices: DataFrame) -> DataFrame:
    return tags.join(
        devices.select(F.col("id").alias("device_id"), "lsid", "category"), "device_id"
    ).select(F.col("id").alias("tag_id"), "lsid", "category", "tag_name")


def recent_records(
    records: DataFrame,
    tags: DataFrame,
    devices: DataFrame,
    lsid: int | None = None,
    n: int = 20,
) -> DataFrame:
    """The latest n records, of all devices or of one.

    Ties are broken by device, tag and kind, so the answer is determined.  The time of the
    n-th record comes first, from tag numbers and times alone, by a top-n in every task;
    only records at least as late, ties included, meet their labels.
    """
    if lsid is not None:
        devices = devices.where(F.col("lsid") == lsid)
    labels = _labels(tags, devices)
    known = labels.select("tag_id")
    newest = records.select("tag_id", "ts").join(known, "tag_id", "left_semi").select("ts")
    last = newest.orderBy(F.desc("ts")).limit(n).agg(F.min("ts")).scalar()
    # Values are put into text for the n chosen records only.
    chosen = (
        records.where(F.col("ts") >= last).join(labels, "tag_id")
        .orderBy(F.desc("ts"), "lsid", "tag_name", "kind")
        .limit(n)
    )
    ranked = (
        records_view(chosen).join(labels, "tag_id")
        .orderBy(F.desc("ts"), "lsid", "tag_name", "value_type")
    )
    shown = ["time", "tag_name", "value", "value_type"]
    if lsid is None:
        shown[1:1] = ["lsid", "category"]
    return ranked.withColumn("time", epoch_to_timestamp(F.col("ts"))).select(*shown, "ts")


def recent_stored(tables: Tables, lsid: int | None = None, n: int = 20) -> DataFrame:
    """:func:`recent_records` over stored tables, reading only the newest days.

    The days looked at double until they hold n matching records, so a full scan
    happens only when there are fewer than n in all.  Records without a valid
    day are always looked at.
    """
    records, tags, devices = tables.records(), tables.dimension("tags"), tables.dimension("devices")
    days = tables.record_days()
    width = 1
    while width < len(days):
        newest = records.where((F.col("dt") >= days[width - 1]) | F.col("dt").isNull())
        # At most n rows, kept, so that they are computed once.
        found = cut_lineage(recent_records(newest, tags, devices, lsid, n).withColumn(
            "_rank", F.monotonically_increasing_id()
        ))
        if found.count() >= n:
            return found.orderBy("_rank").drop("_rank")
        width *= 2
    return recent_records(records, tags, devices, lsid, n)
