"""Event windows: coalescing start/end events, joining frames, archiving, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthstream.functions import millis_to_seconds, record_date
from hearthstream.operators.keyed import absent_from
from hearthstream.operators.ordered import max_before, running_sum, with_chunk
from hearthstream.session import cut_lineage

# Defaults in seconds and days.
LEAD = 0
TRAIL = 0
COPY_DELAY = 5
END_TIMEOUT = 60
ARCHIVE_DAYS = 30
FRAME_SECONDS = 30 * 60

GROUP = ["camera", "detection_type"]


def archive_base(detection_type: Column, camera: Column, start_ms: Column) -> Column:
    return F.concat_ws("/", F.lit("smart"), detection_type, camera, millis_to_seconds(start_ms))


def copy_after(end_ms: Column, trail: int, delay: int) -> Column:
    return millis_to_seconds(end_ms) + F.lit(trail + delay)


def collapse_events(events: DataFrame) -> DataFrame:
    """One row per event id: earliest start, latest end, first arrival."""
    return events.groupBy(*GROUP, "event_id").agg(
        F.min("start_ms").alias("start_ms"),
        F.max("end_ms").alias("end_ms"),
        F.min("arrival").alias("arrival"),
    )


def session_members(
    events: DataFrame,
    trail: int = TRAIL,
    delay: int = COPY_DELAY,
    timeout: int = END_TIMEOUT,
    chunk_seconds: int = 3600,
) -> DataFrame:
    """Every event with the number of its session within (camera, type).

    Gaps and islands: a new session starts when an event arrives at or after the
    time by which everything before it was due to be closed.  An event closes
    ``trail + delay`` seconds after its end, or ``timeout`` seconds after its
    arrival if it never ends.  Both scans run in chunks of arrival time, so one
    camera with a third of all events is spread over many tasks.

    Each scan reads its input twice (chunk summaries, then rows), so the narrow
    rows are staged before each: the events themselves are read once.
    """
    collapsed = cut_lineage(collapse_events(events)).withColumn(
        "_due",
        F.coalesce(copy_after(F.col("end_ms"), trail, delay), F.col("arrival") + timeout),
    )
    order = ["arrival", "event_id"]
    chunked = with_chunk(collapsed, F.col("arrival"), chunk_seconds)
    due = max_before(chunked, GROUP, order, "_due", "_due_before")
    starts = due.withColumn(
        "_starts",
        F.when(
            F.col("_due_before").isNull() | (F.col("arrival") >= F.col("_due_before")), 1
        ).otherwise(0),
    )
    staged = cut_lineage(starts.drop("_due", "_due_before"))
    return running_sum(staged, GROUP, order, "_starts", "session_no").drop("_starts", "_chunk")


def session_rollup(members: DataFrame, trail: int = TRAIL, delay: int = COPY_DELAY) -> DataFrame:
    """Earliest start, latest end and event count per session.

    A session whose only event never ended is dropped.  Event ids stay in the
    member rows, where a huge session is many rows and not one huge array.
    """
    rolled = members.groupBy(*GROUP, "session_no").agg(
        F.min("start_ms").alias("start_ms"),
        F.max("end_ms").alias("end_ms"),
        F.count(F.lit(1)).alias("event_count"),
    )
    kept = rolled.where(F.col("end_ms").isNotNull() | (F.col("event_count") > 1))
    return kept.withColumns(
        {
            "copy_after": copy_after(F.col("end_ms"), trail, delay),
            "archive_base": archive_base(
                F.col("detection_type"), F.col("camera"), F.col("start_ms")
            ),
        }
    )


def session_event_ids(members: DataFrame, size: int = 1000, chunk_seconds: int = 3600) -> DataFrame:
    """The event ids of every session in order of arrival, in arrays of ``size`` at most.

    (camera, detection_type, session_no, part, event_ids): part 0 holds the first ``size``
    ids.  Ranks come from a chunked scan, so a session with a third of all events is many
    arrays in many tasks.  ``members`` are rows of :func:`session_members`.
    """
    keys = [*GROUP, "session_no"]
    narrow = members.select(*keys, "arrival", "event_id").withColumn("_one", F.lit(1))
    staged = cut_lineage(with_chunk(narrow, F.col("arrival"), chunk_seconds))
    ranked = running_sum(staged, keys, ["arrival", "event_id"], "_one", "_rank")
    return (
        ranked.groupBy(*keys, F.floor((F.col("_rank") - 1) / size).cast("int").alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("_rank", "event_id"))).alias("_ids"))
        .select(*keys, "part", F.col("_ids.event_id").alias("event_ids"))
    )


def coalesce_sessions(
    events: DataFrame,
    trail: int = TRAIL,
    delay: int = COPY_DELAY,
    timeout: int = END_TIMEOUT,
    chunk_seconds: int = 3600,
) -> DataFrame:
    """Sessions of start/end events per (camera, detection type)."""
    return session_rollup(
        session_members(events, trail, delay, timeout, chunk_seconds), trail, delay
    )


# Bucket widths in seconds for the interval join, and the longest session put on
# each.  A session then covers at most 13 buckets of its width (only one of more
# than two years covers more), and a frame is looked up once per width in use.
BUCKETS = [(300, 3600), (21600, 259200), (1555200, None)]


def frames_in_sessions(
    frames: DataFrame, sessions: DataFrame, lead: int = LEAD, trail: int = TRAIL
) -> DataFrame:
    """Frames whose second lies in a session of their camera, bounds included.

    A frame may lie in several sessions and then comes out once for each.  The
    interval condition is turned into equality on (camera, bucket width, bucket)
    so that it can be hashed and split; the exact bounds are checked after.
    """
    spans = sessions.where(F.col("end_ms").isNotNull()).withColumns(
        {
            "_from": millis_to_seconds(F.col("start_ms")) - lead,
            "_to": millis_to_seconds(F.col("end_ms")) + trail,
        }
    ).where(F.col("_from") <= F.col("_to"))
    length = F.col("_to") - F.col("_from")
    width = None
    for seconds, longest in BUCKETS[:-1]:
        width = (
            F.when(length <= longest, seconds) if width is None
            else width.when(length <= longest, seconds)
        )
    spans = spans.withColumn("_width", width.otherwise(BUCKETS[-1][0]).cast("bigint"))
    # At most three rows per camera: a frame is looked up once for each width its
    # camera has sessions of, and not at all where there are none.
    widths = spans.select("camera", "_width").distinct()
    spans = spans.withColumn(
        "_bucket",
        F.explode(
            F.sequence(
                F.floor(F.col("_from") / F.col("_width")), F.floor(F.col("_to") / F.col("_width"))
            )
        ),
    )
    probes = frames.join(widths, "camera").withColumn(
        "_bucket", F.floor(F.col("ts") / F.col("_width"))
    )
    return (
        probes.join(spans, ["camera", "_width", "_bucket"])
        .where(F.col("ts").between(F.col("_from"), F.col("_to")))
        .drop("_width", "_bucket", "_from", "_to")
    )


def frames_per_session(matches: DataFrame) -> DataFrame:
    """Distinct frame seconds per session."""
    return matches.groupBy(*GROUP, "session_no").agg(F.countDistinct("ts").alias("frames"))


def unarchived(matches: DataFrame, archived: DataFrame) -> DataFrame:
    """Matches not yet in the archive index."""
    return absent_from(matches, archived, ["detection_type", "camera", "start_sec", "ts"])


def archive_target() -> Column:
    """Path of an archived frame below the archive."""
    return F.concat_ws(
        "/", F.lit("smart"), "detection_type", "camera", "start_sec", F.concat("ts", F.lit(".jpg"))
    )


def archive_rows(matches: DataFrame) -> DataFrame:
    """Archive index rows: type, camera, start second, frame second, target path."""
    keep = [c for c in ("path", "content") if c in matches.columns]
    return matches.select(
        "detection_type",
        "camera",
        millis_to_seconds(F.col("start_ms")).alias("start_sec"),
        "ts",
        *keep,
    ).withColumn("target", archive_target()).dropDuplicates(
        ["detection_type", "camera", "start_sec", "ts"]
    )


def retain(frames: DataFrame, now: Column, max_age_seconds: int = FRAME_SECONDS) -> DataFrame:
    """Frames not older than ``max_age_seconds``."""
    return frames.where(F.col("ts") >= now - max_age_seconds)


def retain_archive(sessions: DataFrame, now: Column, days: int = ARCHIVE_DAYS) -> DataFrame:
    """Archived sessions last written within the given number of days."""
    return sessions.where(F.col("archived_at") >= now - days * 86400)


def with_frame_date(frames: DataFrame) -> DataFrame:
    return frames.withColumn("dt", record_date(F.col("ts")))


def with_frame_slot(frames: DataFrame, seconds: int = FRAME_SECONDS) -> DataFrame:
    """Add ``slot``, the number of the half hour (or ``seconds``) of a frame, to partition by."""
    return frames.withColumn("slot", F.floor(F.col("ts") / seconds))


def retained_frames(
    stored: DataFrame, now: int, max_age_seconds: int = FRAME_SECONDS, seconds: int = FRAME_SECONDS
) -> DataFrame:
    """Frames of a table with slots that are not older than ``max_age_seconds``, to the second.

    The slot at the border is filtered; older ones are not opened, whether or not they have
    been dropped yet.
    """
    oldest = now - max_age_seconds
    return stored.where((F.col("slot") >= oldest // seconds) & (F.col("ts") >= oldest)).drop("slot")
