"""Archiving frames of closed sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthstream.functions import record_date
from hearthstream.operators import sessions as S
from hearthstream.session import cut_lineage

ARCHIVE_DDL = (
    "detection_type string, camera string, start_sec bigint, ts bigint, path string, "
    "archived_at bigint, dt date"
)
SESSION = ["dt", "detection_type", "camera", "start_sec"]


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archive index; ``dt`` is the day on which a session starts.

    The target path of a frame follows from its session and is derived here, so no
    stored row holds it.
    """
    stored = spark.read.schema(ARCHIVE_DDL).parquet(path)
    return stored.withColumn("target", S.archive_target())


def write_archive(
    frames: DataFrame,
    sessions: DataFrame,
    path: str,
    now: int | Column,
    archived: DataFrame | None = None,
    lead: int = S.LEAD,
    trail: int = S.TRAIL,
) -> None:
    """Append the frames of the sessions that the archive does not have yet.

    What the archive has is read for the days on which the sessions start, and no
    others.
    """
    rows = cut_lineage(
        S.archive_rows(S.frames_in_sessions(frames, sessions, lead, trail)).withColumn(
            "dt", record_date(F.col("start_sec"))
        )
    )
    if archived is not None:
        days = [r.dt for r in rows.select("dt").distinct().collect()]  # one row per day
        rows = S.unarchived(rows, archived.where(F.col("dt").isin(days)))
    now = now if isinstance(now, Column) else F.lit(now)
    (
        rows.withColumn("archived_at", now.cast("bigint"))
        .drop("target")
        .hint("rebalance", "dt")
        .sortWithinPartitions("dt", "detection_type", "camera", "start_sec", "ts")
        .write.mode("append")
        .partitionBy("dt")
        .parquet(path)
    )


def expire_archive(spark: SparkSession, path: str, now: int, days: int = S.ARCHIVE_DAYS) -> int:
    """Delete the sessions that nothing was written to for ``days``; returns how many days were touched.

    A session ages by its last written frame, as a whole.  A day all of whose sessions
    are old is dropped with its folder; one with old and live sessions is replaced by the
    live ones, which are staged before.
    """
    index = spark.read.schema(ARCHIVE_DDL).parquet(path)
    aged = index.groupBy(*SESSION).agg(F.max("archived_at").alias("last"))
    live = F.col("last") >= now - days * 86400
    per_day = aged.groupBy("dt").agg(
        F.count_if(live).alias("live"), F.count_if(~live).alias("old")
    ).where("old > 0").collect()  # one row per day
    mixed = [r.dt for r in per_day if r.live]
    if mixed:
        kept = aged.where(live & F.col("dt").isin(mixed)).select(*SESSION)
        rest = cut_lineage(index.where(F.col("dt").isin(mixed)).join(kept, SESSION, "left_semi"))
        rest.select(*index.columns).hint("rebalance", "dt").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("dt").parquet(path)
    for r in per_day:
        if not r.live:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/dt={r.dt}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(per_day)
