"""Dead letters: saving, replaying, summarizing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream.operators.keyed import last_wins, upsert
from hearthstream.operators.records import BAD_BODY

ORPHAN_KEYS = ["topic", "partition", "offset"]

# Versions that a task sorts, and the most tasks: up to so many, rows go to their files
# unsorted and need no memory in the tasks that read them.
SORTED_ROWS = 100_000
MOST_PARTS = 200


def save_orphans(orphans: DataFrame, rows: DataFrame) -> DataFrame:
    """Upsert by message position; everything but ``reprocessed`` is overwritten."""
    incoming = last_wins(rows, ORPHAN_KEYS, F.struct("created_at", "reason", "tag_name"))
    overwritten = {
        c: F.col(f"new.{c}") for c in orphans.columns if c not in (*ORPHAN_KEYS, "reprocessed")
    }
    overwritten["reprocessed"] = F.coalesce(F.col("old.reprocessed"), F.lit(False))
    return upsert(orphans, incoming, ORPHAN_KEYS, overwritten, id_column=None)


def latest_versions(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Current orphans out of an append-only log of their versions.

    The latest version counts, except that ``reprocessed`` stays once set: the
    same outcome as upserting version by version, without rewriting the table
    for every batch.  ``columns`` limits what has to be shuffled.

    Choosing whole rows sorts them.  They are dealt out first, a bounded number to a
    task: a file that a task reads holds fifty times its size in rows, and before the
    shuffle there is little to reduce, as most positions have one version.
    """
    rest = [c for c in log.columns if c not in (*ORPHAN_KEYS, "reprocessed")]
    kept = rest if columns is None else [c for c in rest if c in columns]
    parts = min(MOST_PARTS, 1 + log.count() // SORTED_ROWS)
    current = log.repartition(parts, *ORPHAN_KEYS).groupBy(*ORPHAN_KEYS).agg(
        F.max_by(F.struct(*kept), F.struct("created_at", "reason", "tag_name")).alias("_v"),
        F.bool_or("reprocessed").alias("reprocessed"),
    )
    return current.select(*ORPHAN_KEYS, "_v.*", "reprocessed").select(
        *[c for c in log.columns if c in (*ORPHAN_KEYS, *kept, "reprocessed")]
    )


def pending_orphans(orphans: DataFrame) -> DataFrame:
    return orphans.where(~F.col("reprocessed"))


def replayable(orphans: DataFrame, devices: DataFrame) -> DataFrame:
    """Pending orphans whose device is known by now and whose body can be read.

    An unreadable body fails again in every replay, so it stays pending.
    """
    ready = pending_orphans(orphans).where(F.col("reason") != BAD_BODY)
    return ready.join(devices.select("lsid"), "lsid", "left_semi")


def as_messages(orphans: DataFrame) -> DataFrame:
    """Orphans back in envelope form.  The arrival time becomes the record time."""
    return orphans.select(
        "topic",
        "partition",
        "offset",
        F.lit(None).cast("string").alias("key"),
        F.transform(
            F.map_entries("message_headers"),
            lambda e: F.struct(
                e["key"].alias("key"), e["value"].cast("binary").alias("value")
            ),
        ).alias("headers"),
        F.col("message_body").cast("binary").alias("value"),
        F.timestamp_seconds("record_ts").alias("timestamp"),
    )


def orphan_summary(orphans: DataFrame) -> DataFrame:
    """Pending orphans counted by topic, device, tag and reason."""
    return (
        pending_orphans(orphans)
        .groupBy("topic", "lsid", "tag_name", "reason")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "topic", "lsid", "tag_name", "reason")
    )


def orphan_reasons(orphans: DataFrame) -> DataFrame:
    return pending_orphans(orphans).groupBy("reason").agg(F.count(F.lit(1)).alias("count"))


def latest_orphans(orphans: DataFrame, n: int = 10) -> DataFrame:
    """The n most recently saved orphans, ties by message position."""
    return orphans.orderBy(F.desc("created_at"), "topic", "partition", F.desc("offset")).limit(n)
