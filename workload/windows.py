"""Event-window, frame and retention queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthstream.operators import cameras as C
from hearthstream.operators import sessions as S
from hearthstream.plans.archive import expire_archive, read_archive, write_archive
from hearthstream.session import scratch_dir
from hearthstream.sources import files
from hearthstream.streaming.sessions import archive_sessions_stream
from workload import feeds
from workload.registry import query


@query("WIN4", """
SELECT camera, detection_type, eid AS event_id, start_ms, end_ms, CAST(session_no AS BIGINT) AS session_no
FROM members""", "members")
def session_members(spark, sf):
    return S.session_members(feeds.session_events(spark, sf), chunk_seconds=86400).drop("arrival")


@query("WIN4, AGG17", """
SELECT *, end_ms // 1000 + 5 AS copy_after,
  'smart/' || detection_type || '/' || camera || '/' || CAST(start_ms // 1000 AS VARCHAR) AS archive_base
FROM sess""", "sess")
def coalesce_sessions(spark, sf):
    return S.coalesce_sessions(feeds.session_events(spark, sf), chunk_seconds=86400)


@query("AGG17", """
SELECT camera, detection_type, CAST(session_no AS BIGINT) AS session_no, (r - 1) // 3 AS part,
  string_agg(eid, ',' ORDER BY r) AS event_ids
FROM (SELECT *, row_number() OVER (PARTITION BY camera, detection_type, session_no ORDER BY arrival, eid) AS r FROM members)
GROUP BY ALL""", "members")
def session_event_ids(spark, sf):
    members = S.session_members(feeds.session_events(spark, sf), chunk_seconds=86400)
    return S.session_event_ids(members, size=3, chunk_seconds=86400).select(
        "camera", "detection_type", "session_no", F.col("part").cast("bigint").alias("part"),
        F.array_join("event_ids", ",").alias("event_ids"),
    )


@query("WIN4", """
SELECT 'cam_' || CAST(user_id % 5 AS VARCHAR) AS camera, 'e' || CAST(event_id AS VARCHAR) AS event_id, hts * 1000 AS start_ms
FROM m WHERE event_type = 'purchase'""", "m")
def collapse_events(spark, sf):
    events = feeds.session_events(spark, sf)
    # A second, later message of each event must not change its start.
    again = events.withColumns(
        {"start_ms": F.col("start_ms") + 1000, "arrival": F.col("arrival") + 1}
    )
    return S.collapse_events(events.unionByName(again)).select("camera", "event_id", "start_ms")


@query("JN16, FN13", """
SELECT camera, ts, path, session_no, start_ms, end_ms FROM fis""", "fis")
def frames_in_sessions(spark, sf):
    sessions = S.coalesce_sessions(feeds.session_events(spark, sf), chunk_seconds=86400)
    matches = S.frames_in_sessions(feeds.frames(spark, sf), sessions)
    return matches.select("camera", "ts", "path", "session_no", "start_ms", "end_ms")


@query("JN16", """
SELECT f.camera, f.ts, f.path, s.session_no FROM fr f JOIN sess s ON f.camera = s.camera
  AND f.ts BETWEEN s.start_ms // 1000 - 600 AND s.end_ms // 1000 + 1200""", "fr", "sess")
def frames_in_padded_sessions(spark, sf):
    sessions = S.coalesce_sessions(feeds.session_events(spark, sf), chunk_seconds=86400)
    matches = S.frames_in_sessions(feeds.frames(spark, sf), sessions, lead=600, trail=1200)
    return matches.select("camera", "ts", "path", "session_no")


@query("AGG17", """
SELECT camera, detection_type, session_no, count(DISTINCT ts) AS frames FROM fis GROUP BY ALL""", "fis")
def session_rollup(spark, sf):
    sessions = S.coalesce_sessions(feeds.session_events(spark, sf), chunk_seconds=86400)
    return S.frames_per_session(S.frames_in_sessions(feeds.frames(spark, sf), sessions))


@query("SNK8", """
SELECT DISTINCT detection_type, camera, start_ms // 1000 AS start_sec, ts,
  'smart/' || detection_type || '/' || camera || '/' || CAST(start_ms // 1000 AS VARCHAR) || '/'
    || CAST(ts AS VARCHAR) || '.jpg' AS target
FROM fis""", "fis")
def write_archive_once(spark, sf):
    path = scratch_dir(spark, "archive")
    sessions = S.coalesce_sessions(feeds.session_events(spark, sf), chunk_seconds=86400)
    # The first run sees the even frames only; the second adds what is missing.
    seen = feeds.frames(spark, sf)
    write_archive(seen.where("ts % 2 = 0"), sessions, path, feeds.NOW_EPOCH)
    write_archive(seen, sessions, path, feeds.NOW_EPOCH, read_archive(spark, path))
    return read_archive(spark, path).select(
        "detection_type", "camera", "start_sec", "ts", "target"
    )


@query("STR9", "SELECT camera, ts, path FROM fr WHERE ts >= 1706400000 - 86400", "fr")
def retain_frames(spark, sf):
    return S.retain(feeds.frames(spark, sf), F.lit(1706400000), 86400)


@query("STR10, SNK8", """
SELECT detection_type, camera, start_ms // 1000 AS start_sec, count(DISTINCT ts) AS frames FROM fis
GROUP BY ALL HAVING max(ts) >= 1706400000 - 10 * 86400""", "fis")
def retain_archive(spark, sf):
    """Frames archived as they come; then sessions go that had none for ten days."""
    path = scratch_dir(spark, "archive")
    sessions = S.coalesce_sessions(feeds.session_events(spark, sf), chunk_seconds=86400)
    write_archive(feeds.frames(spark, sf), sessions, path, F.col("ts"))
    expire_archive(spark, path, 1706400000, 10)
    return read_archive(spark, path).groupBy("detection_type", "camera", "start_sec").agg(
        F.count(F.lit(1)).alias("frames")
    )


@query("STR9, STR11", "SELECT camera, ts, path FROM fr WHERE ts >= 1706400000 - 1800", "fr")
def expire_frames(spark, sf):
    """Frames stored by half hours; those older than half an hour go, to the second."""
    from hearthstream.sources.tables import Tables

    tables = Tables(spark, scratch_dir(spark, "frames"))
    path = f"{tables.root}/frames"
    S.with_frame_slot(feeds.frames(spark, sf)).hint("rebalance", "slot").write.partitionBy("slot").parquet(path)
    tables.expire_slots("frames", (1706400000 - 1800) // 1800)
    return S.retained_frames(spark.read.parquet(path), 1706400000).select("camera", "ts", "path")


@query("STR9, SNK1", """
SELECT camera, ts, path FROM fr WHERE ts >= 1705881600""", "fr")
def expire_frame_days(spark, sf):
    from hearthstream.sources.tables import Tables

    tables = Tables(spark, scratch_dir(spark, "frames"))
    path = f"{tables.root}/frames"
    dated = S.with_frame_date(feeds.frames(spark, sf))
    dated.hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
    tables.expire_days("frames", "2024-01-22")
    return spark.read.parquet(path).select("camera", "ts", "path")


@query("SRC9", "SELECT camera, ts FROM fr WHERE ts % 3 <> 0", "fr")
def index_frames(spark, sf):
    frames = feeds.frames(spark, sf)
    stem = F.when(F.col("ts") % 3 != 0, F.col("ts").cast("string")).otherwise("cover")
    paths = frames.select(
        F.concat(
            F.lit("file:/data/jpg/"), F.initcap(F.replace("camera", F.lit("_"), F.lit(" "))),
            F.lit("/"), stem, F.lit(".jpg"),
        ).alias("path")
    )
    return files.index_frames(paths).select("camera", "ts")


def _frame_messages(spark, sf):
    frames = feeds.frames(spark, sf).select(
        F.col("camera").alias("camera_id"), F.col("camera").alias("camera_name"), "ts",
        F.col("path").cast("binary").alias("content"),
    )
    topic = F.concat(F.lit("video."), F.col("camera_name"))
    return C.frame_messages(frames, topic).withColumns(
        {"partition": F.lit(0), "offset": F.lit(0)}
    )


@query("SRC10", """
SELECT camera, ts, path AS content FROM fr""", "fr")
def frames_from_messages(spark, sf):
    return C.frames_from_messages(_frame_messages(spark, sf)).select(
        "camera", "ts", F.col("content").cast("string").alias("content")
    )


@query("STR11, SRC10", "SELECT camera, ts FROM fr WHERE ts >= 1706400000 - 1800", "fr")
def frame_topic_retention(spark, sf):
    frames = C.frames_from_messages(_frame_messages(spark, sf))
    return S.retain(frames, F.lit(1706400000)).select("camera", "ts")


# Sessions as the stream finds them, one message or timer after the other.  A group of
# messages is one micro-batch; timers fire after it at the watermark before it, and then at
# the one after it.
_STREAMED = """
WITH RECURSIVE e AS (
  SELECT 'cam_' || CAST(user_id % 5 AS VARCHAR) AS camera, 'e' || CAST(event_id AS VARCHAR) AS eid,
    hts * 1000 AS start_ms, CASE WHEN event_id % 11 <> 0 THEN hts * 1000 + CAST(floor(value) AS BIGINT) * 60000 ELSE 0 END AS end_ms,
    hts AS arrival, {group} AS g
  FROM (SELECT *, min(hts) OVER () AS lo, max(hts) OVER () AS hi FROM m WHERE event_type = 'purchase')
), marks AS (
  SELECT g, max(max(arrival)) OVER (ORDER BY g) - 10 AS after,
    max(max(arrival)) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 10 AS before
  FROM e GROUP BY g
), items AS (
  SELECT camera, g, 0 AS part, arrival AS t, eid, start_ms, end_ms FROM e
  UNION ALL
  SELECT camera, g, part, CASE part WHEN 1 THEN before ELSE after END, NULL, NULL, NULL
  FROM (SELECT DISTINCT camera FROM e), marks, (VALUES (1), (2)) p(part)
), steps AS (
  SELECT *, row_number() OVER (PARTITION BY camera ORDER BY g, part, t, eid) AS k FROM items
), run AS (
  SELECT camera, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS s, CAST(0 AS BIGINT) AS e, CAST(0 AS BIGINT) AS n,
    CAST(NULL AS BIGINT) AS w, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS BIGINT) AS os, CAST(NULL AS BIGINT) AS oe,
    CAST(NULL AS BIGINT) AS oc
  FROM (SELECT DISTINCT camera FROM e)
  UNION ALL
  SELECT camera, k,
    CASE WHEN eid IS NULL THEN s ELSE least(coalesce(s, start_ms), start_ms) END,
    CASE WHEN eid IS NULL THEN e ELSE greatest(e, end_ms) END,
    CASE WHEN eid IS NULL THEN n ELSE n + 1 END,
    CASE WHEN eid IS NOT NULL AND s IS NULL AND end_ms = 0 THEN t ELSE w END,
    status, os, oe, oc
  FROM (
    SELECT camera, k, eid, t, start_ms, end_ms, status, os, oe, oc,
      CASE WHEN status IS NULL THEN s END AS s, CASE WHEN status IS NULL THEN e ELSE 0 END AS e,
      CASE WHEN status IS NULL THEN n ELSE 0 END AS n,
      CASE WHEN status IS NULL AND NOT (w IS NOT NULL AND now > w + 60) THEN w END AS w
    FROM (
      SELECT *, s AS os, e AS oe, n AS oc,
        CASE WHEN s IS NULL THEN NULL
          WHEN w IS NOT NULL AND now > w + 60 AND e = 0 AND n = 1 THEN 'cancelled'
          WHEN e > 0 AND now >= e // 1000 + 5 THEN 'closed' END AS status
      FROM (
        SELECT r.camera, x.k, x.eid, x.t, x.start_ms, x.end_ms, r.s, r.e, r.n, r.w,
          -- A message acts at its arrival, a timer at its own time, if the watermark has reached it.
          CASE WHEN x.eid IS NOT NULL THEN x.t
            WHEN least(coalesce(r.w + 61, 9e18), CASE WHEN r.e > 0 THEN r.e // 1000 + 5 ELSE 9e18 END) <= x.t
            THEN CAST(least(coalesce(r.w + 61, 9e18), CASE WHEN r.e > 0 THEN r.e // 1000 + 5 ELSE 9e18 END) AS BIGINT)
            ELSE -1 END AS now
        FROM run r JOIN steps x ON x.camera = r.camera AND x.k = r.k + 1
      )
    )
  )
)
SELECT camera, 'person' AS detection_type, os AS start_ms, oe AS end_ms, oc AS event_count,
  CASE WHEN oe > 0 THEN oe // 1000 + 5 ELSE 0 END AS copy_after, status
FROM run WHERE status IS NOT NULL"""


def _sessions_in_groups(spark, sf, group):
    """The session stream over messages that arrive in groups, with a restart after each."""
    events = feeds.session_events(spark, sf)
    span = events.agg(F.min("arrival").alias("lo"), F.max("arrival").alias("hi")).first()
    numbered = events.withColumn("_group", group(F.col("arrival"), span.lo, span.hi))
    inbox, out, offsets = (scratch_dir(spark, x) for x in ("inbox", "sessions", "offsets"))
    for g in range(3):
        # Files of one group are one micro-batch, and so in any order.
        numbered.where(F.col("_group") == g).drop("_group").write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(events.schema).parquet(inbox)
        run = archive_sessions_stream(stream, clock="arrival").writeStream.format("parquet").option(
            "path", out
        ).option("checkpointLocation", offsets)
        run.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def _third(arrival, lo, hi):
    return F.floor((arrival - lo) * 3 / (hi - lo + 1)).cast("int")


@query("STR6, T28, T30", _STREAMED.format(group="(hts - lo) * 3 // (hi - lo + 1)"), "m")
def sessions_streamed(spark, sf):
    return _sessions_in_groups(spark, sf, _third)


@query("STR6, STR7", _STREAMED.format(
    group="least(2, (hts - lo) * 3 // (hi - lo + 1) + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END)"), "m")
def sessions_streamed_late(spark, sf):
    """One message in thirteen comes a micro-batch late, behind the watermark."""
    late = F.when(F.substring("event_id", 2, 20).cast("bigint") % 13 == 0, 1).otherwise(0)
    return _sessions_in_groups(
        spark, sf, lambda arrival, lo, hi: F.least(F.lit(2), _third(arrival, lo, hi) + late)
    )
