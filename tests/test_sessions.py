import time

from pyspark.sql import functions as F

from hearthstream.operators import sessions as S
from hearthstream.plans.archive import expire_archive, read_archive, write_archive
from hearthstream.sources import files
from hearthstream.sources.tables import Tables
from hearthstream.streaming.sessions import archive_sessions_stream, with_archive_base
from helpers import at, rows

DDL = "camera string, detection_type string, event_id string, start_ms bigint, end_ms bigint, arrived_at timestamp, arrival bigint"


def events(spark, *values):
    """Rows (id, start, end, arrival) in seconds of one camera and type."""
    return spark.createDataFrame(
        [("cam", "person", i, s * 1000, None if e is None else e * 1000, at(a), a) for i, s, e, a in values], DDL)


def sessions(spark, *values, **kw):
    return rows(S.coalesce_sessions(events(spark, *values), **kw), "start_ms", "end_ms", "event_count")


def test_overlapping_events_merge(spark):
    # The first is due at 105 + 5; an arrival at 109 merges, one at 110 opens a new session.
    assert sessions(spark, ("a", 100, 105, 100), ("b", 108, 120, 109), ("c", 130, 140, 130)) == [
        (100000, 120000, 2), (130000, 140000, 1)]
    assert sessions(spark, ("a", 100, 105, 100), ("b", 110, 120, 110)) == [(100000, 105000, 1), (110000, 120000, 1)]


def test_messages_of_one_event_collapse(spark):
    assert sessions(spark, ("a", 100, None, 100), ("a", 100, 150, 152), ("b", 140, 141, 145)) == [(100000, 150000, 2)]


def test_lonely_endless_event_is_dropped(spark):
    assert sessions(spark, ("a", 100, None, 100)) == []
    assert sessions(spark, ("a", 100, None, 100), ("b", 100, 130, 130)) == [(100000, 130000, 2)]


def test_endless_event_does_not_inherit_an_old_maximum(spark):
    assert sessions(spark, ("a", 0, 10, 0), ("b", 1000, None, 1000), ("c", 1100, 1110, 1100)) == [
        (0, 10000, 1), (1100000, 1110000, 1)]


def test_earlier_start_moves_the_session(spark):
    assert sessions(spark, ("a", 100, 150, 100), ("b", 90, 140, 120)) == [(90000, 150000, 2)]


def test_trail_and_delay(spark):
    assert sessions(spark, ("a", 100, 105, 100), ("b", 120, 125, 120), trail=10, delay=20) == [(100000, 125000, 2)]


def test_chunk_width_does_not_matter(spark):
    values = [(f"e{i}", i * 37 % 4000, i * 37 % 4000 + i * 13 % 90, i * 37 % 4000) for i in range(300)]
    expected = sessions(spark, *values, chunk_seconds=10**9)
    for width in (1, 60, 3600):
        assert sessions(spark, *values, chunk_seconds=width) == expected


def brute_force(frames, spans):
    return sorted((c, t, n) for c, t in frames for n, (sc, a, b) in enumerate(spans) if sc == c and a <= t <= b)


def test_interval_join_equals_brute_force(spark):
    frames = [("cam" if i % 3 else "other", i * 101 % 50000) for i in range(400)]
    spans = [("cam", 0, 0), ("cam", 10, 3600), ("cam", 100, 3800), ("other", 5, 40000), ("cam", 300, 10**8), ("cam", 900, 800), ("none", 0, 10)]
    f = spark.createDataFrame([(c, t, "p") for c, t in frames], "camera string, ts bigint, path string")
    s = spark.createDataFrame([(c, "person", n, a * 1000, b * 1000) for n, (c, a, b) in enumerate(spans)],
                              "camera string, detection_type string, session_no int, start_ms bigint, end_ms bigint")
    got = rows(S.frames_in_sessions(f, s), "camera", "ts", "session_no")
    assert sorted(got) == brute_force(frames, spans)
    padded = rows(S.frames_in_sessions(f, s, lead=50, trail=70), "camera", "ts", "session_no")
    assert sorted(padded) == brute_force(frames, [(c, a - 50, b + 70) for c, a, b in spans])


def test_archive_has_no_double_copies(spark, folder):
    f = spark.createDataFrame([("cam", 101, "p1"), ("cam", 102, "p2"), ("cam", 300, "p3")], "camera string, ts bigint, path string")
    s = S.coalesce_sessions(events(spark, ("a", 100, 110, 100)))
    path = f"{folder}/archive"
    write_archive(f.where("ts < 102"), s, path, 1000)
    write_archive(f, s, path, 2000, read_archive(spark, path))
    assert rows(read_archive(spark, path), "target", "archived_at") == [
        ("smart/person/cam/100/101.jpg", 1000), ("smart/person/cam/100/102.jpg", 2000)]
    assert rows(S.retain_archive(read_archive(spark, path), F.lit(1500 + 30 * 86400)), "ts") == [(102,)]


def test_archive_forgets_whole_sessions_by_their_last_write(spark, folder):
    import os

    day = 86400
    spans = [("a", 100, 110), ("b", 500, 510), ("c", day + 5, day + 9), ("d", 3 * day, 3 * day + 5)]
    s = S.coalesce_sessions(events(spark, *[(i, a, b, a) for i, a, b in spans]))
    f = spark.createDataFrame([("cam", t, f"p{t}") for _, a, _ in spans for t in (a + 1, a + 2)], "camera string, ts bigint, path string")
    path = f"{folder}/archive"
    # The second frame of session b is written late: it keeps the first one.
    write_archive(f.where("ts <> 502"), s, path, 1000)
    write_archive(f, s, path, 40 * day, read_archive(spark, path))
    assert expire_archive(spark, path, 50 * day) == 3
    assert rows(read_archive(spark, path), "ts", "archived_at") == [(501, 1000), (502, 40 * day)]
    assert [d for d in os.listdir(path) if d.startswith("dt=")] == ["dt=1970-01-01"]
    assert expire_archive(spark, path, 50 * day) == 0


def test_frames_expire_to_the_second(spark, folder):
    f = spark.createDataFrame([("c", t, "p") for t in (0, 1799, 1800, 3599, 3600, 5000)], "camera string, ts bigint, path string")
    S.with_frame_slot(f).write.partitionBy("slot").parquet(f"{folder}/frames")
    assert Tables(spark, folder).expire_slots("frames", (5400 - 1800) // 1800) == ["slot=0", "slot=1"]
    stored = spark.read.parquet(f"{folder}/frames")
    assert rows(S.retained_frames(stored, 5400), "ts") == [(3600,), (5000,)]
    assert rows(S.retained_frames(stored, 5401), "ts") == [(5000,)]


def test_frame_retention_by_row_and_by_day(spark, folder):
    f = spark.createDataFrame([("c", t, "p") for t in (0, 86400, 90000, 200000)], "camera string, ts bigint, path string")
    assert rows(S.retain(f, F.lit(91000)), "ts") == [(200000,), (90000,)]
    tables = Tables(spark, folder)
    S.with_frame_date(f).write.partitionBy("dt").parquet(f"{folder}/frames")
    assert tables.expire_days("frames", "1970-01-02") == ["dt=1970-01-01"]
    assert rows(spark.read.parquet(f"{folder}/frames"), "ts") == [(200000,), (86400,), (90000,)]


def test_frames_from_files(spark, folder):
    import os

    for name in ("Front Door/100.jpg", "Front Door/cover.jpg", "Front Door/101.png", "b/102.jpg"):
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        open(f"{folder}/{name}", "wb").write(b"jpeg")
    assert rows(files.read_frames(spark, folder), "camera", "ts") == [("b", 102), ("front_door", 100)]
    assert rows(files.read_frames(spark, folder, with_content=True).select(F.length("content")).distinct()) == [(4,)]
    stream = files.new_images(spark, folder)

    def run():
        stream.writeStream.format("parquet").option("path", f"{folder}/seen").option(
            "checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(f"{folder}/seen").count()

    assert run() == 3
    open(f"{folder}/b/103.jpg", "wb").write(b"x")
    assert run() == 4


# ---- streaming ------------------------------------------------------------


def streamed(spark, folder, *batches, **kw):
    """Closed and cancelled sessions of batches given as lists of (id, start, end, arrival)."""
    for batch in batches:
        events(spark, *batch).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        time.sleep(0.05)
    source = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    run = archive_sessions_stream(source, clock="arrival", lateness="0 seconds", **kw).writeStream.format("parquet")
    run.option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start().awaitTermination()
    return rows(spark.read.parquet(f"{folder}/out"), "start_ms", "end_ms", "event_count", "status")


LATER = ("z", 9000, 9001, 9000)  # moves the clock on


def test_stream_equals_batch_for_ended_events(spark, folder):
    values = [(f"e{i:03}", t, t + i * 7 % 30, t) for i in range(100) for t in [1000 + i * 11]] + [LATER]
    got = streamed(spark, folder, values[:50], values[50:])
    expected = sessions(spark, *values)[:-1]
    assert [(a, b, n) for a, b, n, _ in got] == [r for r in expected if r[0] != 9000000]


def test_stream_cancels_a_lonely_endless_event_and_forgets_it(spark, folder):
    got = streamed(spark, folder, [("a", 100, None, 100)], [("b", 5000, 5001, 5000)], [("a", 100, 5100, 5100)], [LATER])
    assert got == [(100000, 0, 1, "cancelled"), (100000, 5100000, 1, "closed"), (5000000, 5001000, 1, "closed")]


def test_stream_repeated_start_keeps_the_session(spark, folder):
    # The same id twice counts as two, so the timeout no longer removes the session.
    got = streamed(spark, folder, [("a", 100, None, 100), ("a", 100, None, 110)], [("b", 100, 5000, 5000)], [LATER])
    assert got == [(100000, 5000000, 3, "closed")]


def test_stream_ignores_messages_of_closed_sessions(spark, folder):
    got = streamed(spark, folder, [("a", 100, 110, 100), ("b", 200, 210, 200)], [("a", 100, 9500, 300)], [LATER])
    assert got == [(100000, 110000, 1, "closed"), (200000, 210000, 1, "closed")]


def test_stream_forgets_ids_after_a_while(spark, folder):
    # The third message comes when the first session's id is forgotten, the fourth before the second's is.
    batches = [[("a", 100, 110, 100)], [("b", 3000, 3001, 3000)], [("a", 5000, 5001, 5000)], [("b", 6000, 6001, 6000)], [LATER]]
    got = streamed(spark, folder, *batches, keep=3500)
    assert got == [(100000, 110000, 1, "closed"), (3000000, 3001000, 1, "closed"), (5000000, 5001000, 1, "closed")]


def test_stream_keeps_ids_in_slots(spark, folder):
    from hearthstream.streaming.sessions import SLOTS

    first = [(f"e{i:05}", 1000, 1001, 1000 + i % 3) for i in range(3 * SLOTS)]
    # All of them again, when their session is closed: none counts.
    got = streamed(spark, folder, first, [("b", 5000, 5001, 5000), *[(i, 1000, 6000, 5001) for i, *_ in first]], [LATER])
    assert got == [(1000000, 1001000, 3 * SLOTS, "closed"), (5000000, 5001000, 1, "closed")]
    assert spark.read.format("statestore").option("stateVarName", "session_of").load(f"{folder}/ck").count() <= SLOTS


def test_event_ids_in_chunks(spark):
    values = [(f"e{i:02}", 100 + i, 200, 100 + i) for i in range(7)] + [("z", 900, 901, 900), ("y", 900, 901, 900)]
    members = S.session_members(events(spark, *values), chunk_seconds=2)
    got = rows(S.session_event_ids(members, size=3, chunk_seconds=2), "session_no", "part", "event_ids")
    assert got == [(1, 0, ["e00", "e01", "e02"]), (1, 1, ["e03", "e04", "e05"]), (1, 2, ["e06"]), (2, 0, ["y", "z"])]


def test_stream_by_processing_time(spark, folder):
    events(spark, ("a", 100, 110, 100), ("b", 105, 130, 105)).coalesce(1).write.parquet(f"{folder}/in")
    source = spark.readStream.schema(DDL).parquet(f"{folder}/in")
    out = with_archive_base(archive_sessions_stream(source, clock="processing"))
    query = out.writeStream.format("memory").queryName("processing_sessions").option(
        "checkpointLocation", f"{folder}/ck").trigger(processingTime="1 second").start()
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table("processing_sessions").isEmpty():
            time.sleep(0.5)
        assert rows(spark.table("processing_sessions"), "start_ms", "end_ms", "event_count", "status", "archive_base") == [
            (100000, 130000, 2, "closed", "smart/person/cam/100")]
    finally:
        query.stop()


def test_stream_keeps_late_messages(spark, folder):
    got = streamed(spark, folder, [("a", 1000, 1001, 1000)], [("b", 5000, 5001, 5000)], [("c", 3000, 3001, 3000)], [LATER])
    # The late one joins the session that is open when it arrives.
    assert got == [(1000000, 1001000, 1, "closed"), (3000000, 5001000, 2, "closed")]


def test_file_stream_reads_files_of_any_age(spark, folder):
    import os

    from helpers import messages, record

    def arrive(i, age):
        messages(spark, record(i, {"a": 1})).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        for name in os.listdir(f"{folder}/in"):
            if name.endswith(".parquet") and name not in seen:
                seen.add(name)
                then = time.time() - age
                os.utime(f"{folder}/in/{name}", (then, then))
        files.read_envelope_files(spark, f"{folder}/in", stream=True).writeStream.format("parquet").option(
            "path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start().awaitTermination()

    seen = set()
    arrive(1, 0)
    arrive(2, 400 * 86400)
    assert rows(spark.read.parquet(f"{folder}/out"), "offset") == [(1,), (2,)]
