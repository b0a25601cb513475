import pytest
from pyspark.sql import functions as F

from hearthstream import schemas
from hearthstream.operators import orphans as O
from hearthstream.operators import records as R
from hearthstream.plans.materialize import batch_tables, materialize, replay_orphans
from hearthstream.plans.replay import replay, replay_summary
from hearthstream.plans import reports
from hearthstream.sources.tables import Tables
from helpers import at, catalog, devices, message, messages, record, rows

def now():
    return F.lit("2026-01-01").cast("timestamp")


def run(spark, *msgs, known=(1, 2), entries=(), replay=True):
    return batch_tables(
        messages(spark, *msgs), devices(spark, *known), schemas.empty(spark, schemas.TAGS_DDL),
        catalog(spark, *entries) if entries else schemas.empty(spark, schemas.CATALOG_DDL),
        replay=replay, now=now())


def records(tables):
    names = tables["tags"].select(F.col("id").alias("tag_id"), "device_id", "tag_name")
    return rows(tables["records"].join(names, "tag_id"), "device_id", "tag_name", "kind", "ts", "num_value", "text_value")


def test_record_time_comes_from_the_header(spark):
    assert records(run(spark, record(1, {"ts": 5, "a": 1}, ts=1000), message(2, {"a": 2}, {"lsid": 2}))) == [
        (1, "a", "numeric", 1000, 1.0, None), (2, "a", "numeric", 0, 2.0, None)]


def test_first_seen_type_decides(spark):
    t = run(spark, record(2, {"a": "x"}, ts=2), record(1, {"a": 5}, ts=1), record(3, {"a": 6.5}, ts=3))
    assert rows(t["tags"], "tag_name", "data_type") == [("a", "numeric")]
    assert records(t) == [(1, "a", "numeric", 1, 5.0, None), (1, "a", "numeric", 3, 6.5, None)]
    assert rows(t["rejected"], "field", "reason") == [("a", "unsupported numeric type for value: string")]


@pytest.mark.parametrize("first, kind", [(1, "numeric"), (True, "numeric"), ("s", "text"), (None, "null"),
                                         ({"z": 1}, "text"), ([1], "text")])
def test_type_of_first_value(spark, first, kind):
    assert rows(run(spark, record(1, {"a": first}))["tags"], "data_type") == [(kind,)]


def test_null_goes_to_the_null_table_whatever_the_type(spark):
    t = run(spark, record(1, {"a": 5}, ts=1), record(2, {"a": None}, ts=1))
    assert records(t) == [(1, "a", "null", 1, None, None), (1, "a", "numeric", 1, 5.0, None)]


def test_bool_makes_a_tag_but_no_record(spark):
    t = run(spark, record(1, {"a": True}))
    assert rows(t["tags"], "tag_name", "data_type") == [("a", "numeric")]
    assert records(t) == []
    assert rows(t["rejected"], "reason") == [("unsupported numeric type for value: boolean",)]


def test_text_tag_rejects_other_kinds(spark):
    t = run(spark, record(1, {"a": "x"}, ts=1), record(2, {"a": 5}, ts=2), record(3, {"a": [1]}, ts=3), record(4, {"a": {}}, ts=4))
    assert records(t) == [(1, "a", "text", 1, None, "x")]
    assert len(rows(t["rejected"])) == 3


def test_tag_first_seen_null_drops_later_values(spark):
    t = run(spark, record(1, {"a": None}, ts=1), record(2, {"a": 5}, ts=2), record(3, {"a": None}, ts=3))
    assert records(t) == [(1, "a", "null", 1, None, None), (1, "a", "null", 3, None, None)]
    assert rows(t["rejected"], "reason") == [("unknown data type: null",)]


def test_first_arrival_wins_per_kind(spark):
    t = run(spark, record(2, {"a": 6}, ts=1), record(1, {"a": 5}, ts=1), record(3, {"a": None}, ts=1))
    assert records(t) == [(1, "a", "null", 1, None, None), (1, "a", "numeric", 1, 5.0, None)]


def test_unknown_device_and_bad_body(spark):
    msgs = [record(1, {"a": 1}, lsid=9), record(2, "{bad"), message(3, "{}", {}), record(4, {"a": 1})]
    live, again = run(spark, *msgs, replay=False), run(spark, *msgs, replay=True)
    assert rows(live["orphans"], "offset", "reason", "tag_name") == [(1, "missing_device", "")]
    assert rows(live["errors"], "offset") == [(2,), (3,)]
    assert rows(again["orphans"], "offset", "reason") == [(1, "missing_device"), (2, R.BAD_BODY)]
    assert R.BAD_BODY.startswith("failed to parse message body: ")
    assert rows(again["errors"], "offset") == [(1,), (2,), (3,)]


def test_catalog_enriches_new_tags(spark):
    entries = [(1, "1", "a", "float", "", "wind"), (1, "01", "b", "float", "m", "no")]
    t = run(spark, record(1, {"a": 1, "b": 2}), record(2, {"a": 1}, lsid=2, sensor_type=0), entries=entries)
    assert rows(t["tags"], "device_id", "tag_name", "unit", "description", "metadata") == [
        (1, "a", "", "wind", '{"data_structure_type":"1","field_type":"float","sensor_type":1}'),
        (1, "b", None, None, None), (2, "a", None, None, None)]


def test_raw_definition_wins_in_metadata(spark):
    raw = spark.createDataFrame([(1, "1", "a", "float", "m", "d", '{"sensor_type":"raw","units":"m"}')],
        "sensor_type int, data_structure_type string, field_name string, field_type string, units string, description string, j string")
    raw = raw.withColumn("raw_definition", F.from_json("j", "map<string,variant>")).drop("j")
    t = batch_tables(messages(spark, record(1, {"a": 1})), devices(spark, 1), schemas.empty(spark, schemas.TAGS_DDL), raw, now=now())
    assert rows(t["tags"], "metadata") == [('{"data_structure_type":"1","field_type":"float","sensor_type":"raw","units":"m"}',)]


def test_parts_add_up(spark):
    body = {"a": 1, "b": "x", "c": None, "d": True, "e": {"z": 1}, "f": [1]}
    t = run(spark, *[record(i, body, ts=i) for i in range(1, 6)])
    assert t["routed"].count() == 30
    assert t["records"].count() + t["rejected"].count() == 30


def test_infinite_numbers_are_rejected(spark):
    t = run(spark, record(1, '{"a":1e400,"b":1}'))
    assert records(t) == [(1, "b", "numeric", 1000, 1.0, None)]


# ---- stored tables --------------------------------------------------------


def stored(spark, folder, *known):
    tables = Tables(spark, folder)
    tables.replace_dimension("devices", devices(spark, *known, category="ISS"))
    return tables


def view(tables):
    names = tables.dimension("tags").select(F.col("id").alias("tag_id"), "device_id", "tag_name")
    return rows(R.records_view(tables.records()).join(names, "tag_id"), "device_id", "tag_name", "ts", "value_type", "value")


BATCH = [record(1, {"a": 1, "b": "x"}, ts=1), record(2, {"a": 2, "b": None}, ts=86401), record(3, {"a": 9}, ts=1),
         record(4, {"a": 3}, lsid=2, ts=5), record(5, {"a": 4}, lsid=7, ts=5), record(6, "{bad"), message(7, "{}", {})]


def test_materialize_writes_and_counts(spark, folder):
    tables = stored(spark, folder, 1, 2)
    summary = materialize(messages(spark, *BATCH), tables)
    assert summary.counts == {"messages": 7, "processed": 5, "errors": 2, "new_tags": 3, "numeric": 3, "text": 1, "null": 1}
    assert view(tables) == [(1, "a", 1, "numeric", "1"), (1, "a", 86401, "numeric", "2"), (1, "b", 1, "text", "x"),
                            (1, "b", 86401, "null", None), (2, "a", 5, "numeric", "3")]
    assert rows(tables.orphans(), "lsid", "reason", "reprocessed") == [(7, "missing_device", False)]


def test_second_run_changes_nothing(spark, folder):
    tables = stored(spark, folder, 1, 2)
    materialize(messages(spark, *BATCH), tables, replay=True)
    before, tags = view(tables), rows(tables.dimension("tags"), "id", "device_id", "tag_name")
    again = materialize(messages(spark, *BATCH), tables, replay=True)
    assert (view(tables), rows(tables.dimension("tags"), "id", "device_id", "tag_name")) == (before, tags)
    assert (again["numeric"], again["text"], again["null"], again["new_tags"], again["errors"]) == (0, 0, 0, 0, 3)
    assert tables.orphans().count() == 2


@pytest.mark.parametrize("cut", [1, 3, 5])
def test_any_split_gives_the_same_tables(spark, folder, cut):
    whole, parts = stored(spark, f"{folder}/w", 1, 2), stored(spark, f"{folder}/p", 1, 2)
    materialize(messages(spark, *BATCH), whole)
    materialize(messages(spark, *BATCH[:cut]), parts)
    materialize(messages(spark, *BATCH[cut:]), parts)
    assert view(parts) == view(whole)
    assert rows(parts.orphans(["reason"]), "offset", "reason") == rows(whole.orphans(["reason"]), "offset", "reason")


def test_empty_and_all_rejected_batches(spark, folder):
    tables = stored(spark, folder, 1)
    assert materialize(messages(spark, record(1, "{}")).where("false"), tables).counts == {}
    summary = materialize(messages(spark, record(1, {"a": True}), record(2, "null")), tables)
    assert (summary["messages"], summary["errors"], summary["numeric"], summary["new_tags"]) == (2, 0, 0, 1)
    summary = materialize(messages(spark, record(3, {"a": 1}, lsid=99)), tables)
    assert (summary["messages"], summary["new_tags"]) == (1, 0)


def test_garbage_times_are_stored_and_deduplicated(spark, folder):
    tables = stored(spark, folder, 1)
    for _ in range(2):
        materialize(messages(spark, record(1, {"a": 1}, ts=10**15), record(2, {"a": 2}, ts=-5), record(3, {"a": 3}, ts=4 * 10**9)), tables)
    assert [r[2] for r in view(tables)] == [-5, 10**15, 4 * 10**9]


def test_orphan_replay(spark, folder):
    tables = stored(spark, folder, 1)
    materialize(messages(spark, record(1, {"a": 1}), record(2, {"a": 2}, lsid=5, ts=7), record(3, {"a": 3}, lsid=6)), tables)
    tables.replace_dimension("devices", devices(spark, 1, 5))
    summary = replay_orphans(tables)
    assert summary["numeric"] == 1
    assert (5, "a", 7, "numeric", "2") in view(tables)
    assert rows(tables.orphans(["lsid"]), "offset", "lsid", "reprocessed") == [(2, 5, True), (3, 6, False)]
    assert O.pending_orphans(tables.orphans(["lsid"])).count() == 1


def test_orphan_upsert_keeps_reprocessed(spark):
    ddl = schemas.ORPHANS_DDL
    old = spark.createDataFrame([("t", 0, 1, 5, 9, "", "old", None, "b", at(1), True), ("t", 0, 2, 5, 9, "", "old", None, "b", at(1), False)], ddl)
    new = spark.createDataFrame([("t", 0, 1, 6, 9, "x", "new", {"h": "1"}, "c", at(2), False), ("t", 0, 3, 6, 9, "", "new", None, "c", at(2), False)], ddl)
    expected = [("t", 1, 6, "new", "c", True), ("t", 2, 5, "old", "b", False), ("t", 3, 6, "new", "c", False)]
    columns = ["topic", "offset", "lsid", "reason", "message_body", "reprocessed"]
    assert rows(O.save_orphans(old, new), *columns) == expected
    assert rows(O.latest_versions(old.unionByName(new)), *columns) == expected


def test_replay_phases(spark, folder):
    tables = Tables(spark, folder)
    sensors = message(1, {"lsid": 1, "sensor_type": 1, "category": "ISS"}, topic="weather.metadata.sensors")
    fields = message(1, {"sensor_type": 1, "data_structures": [{"data_structure_type": "1", "description": "d", "data_structure": {"a": {"type": "float", "units": "m"}}}]}, topic="weather.metadata.catalog")
    station = message(1, {"stations": [{"station_id": 3, "station_name": "Home"}]}, topic="weather.metadata.station")
    data = [record(i, {"a": i}, ts=i) for i in range(1, 6)] + [record(9, {"a": 1}, topic="weather.other")]
    done = replay(messages(spark, *data, sensors, fields, station), tables, end=4, include_metadata=True)
    assert rows(tables.dimension("devices"), "lsid", "station_id", "station_name") == [(1, 3, "Home")]
    assert rows(tables.dimension("tags"), "tag_name", "unit", "description") == [("a", "m", "d")]
    assert [r[2] for r in view(tables)] == [1, 2, 3]
    assert rows(replay_summary(done, tables)) == [("errors", 0), ("null", 0), ("numeric", 3), ("orphaned", 0), ("processed", 3), ("text", 0)]


def test_recent_reads_newest_days(spark, folder):
    tables = stored(spark, folder, 1, 2)
    materialize(messages(spark, *[record(i, {"a": i}, lsid=1 + i % 2, ts=i * 86400) for i in range(1, 9)]), tables)
    got = [r.ts for r in reports.recent_stored(tables, n=3).collect()]
    assert got == [8 * 86400, 7 * 86400, 6 * 86400]
    assert [r.value for r in reports.recent_stored(tables, lsid=2, n=2).collect()] == ["7", "5"]
    assert reports.recent_stored(tables, n=50).count() == 8
    assert tables.record_days()[0] == "1970-01-09"


def test_truncate(spark, folder):
    tables = stored(spark, folder, 1)
    materialize(messages(spark, record(1, {"a": 1}), record(2, {"a": 1}, lsid=8)), tables)
    tables.truncate()
    assert {r[1] for r in rows(tables.counts())} == {0}
    assert tables.orphans(["reason"]).count() == 1


def test_half_written_snapshot_is_ignored(spark, folder):
    tables = stored(spark, folder, 1)
    (devices(spark, 1, 2).coalesce(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
     .parquet(f"{folder}/devices/version=2"))
    assert tables.dimension("devices").count() == 1


def test_old_snapshots_are_dropped(spark, folder, monkeypatch):
    tables = Tables(spark, folder)
    monkeypatch.setattr("hearthstream.sources.tables.READERS_DONE_MS", -1)
    for n in range(1, 6):
        tables.replace_dimension("devices", devices(spark, *range(n)))
    assert tables._versions("devices") == [3, 4, 5]
    assert tables.dimension("devices").count() == 5


def test_orphans_that_fail_again_stay_pending(spark, folder):
    tables = stored(spark, folder, 1)
    bad = [record(1, "{bad", lsid=1), record(2, {"a": 2}, lsid=5), record(3, {"a": 3}, lsid=6), record(4, "{bad", lsid=5)]
    materialize(messages(spark, *bad), tables, replay=True)
    tables.replace_dimension("devices", devices(spark, 1, 5))
    replay_orphans(tables)
    assert rows(tables.orphans(["lsid"]), "offset", "reprocessed") == [(1, False), (2, True), (3, False), (4, False)]


def test_concurrent_writers_lose_nothing(spark, folder):
    """Appends of new tags and rewrites of all tags interleave; ids stay unique."""
    from concurrent.futures import ThreadPoolExecutor

    from hearthstream.plans.metadata import enrich_stored_tags

    tables = stored(spark, folder, 1)
    batches = [messages(spark, record(i, {f"f{i}": 1, "same": 2}, ts=i)) for i in range(6)]
    with ThreadPoolExecutor(4) as pool:
        jobs = [pool.submit(materialize, b, tables) for b in batches]
        jobs += [pool.submit(enrich_stored_tags, tables) for _ in range(3)]
        for job in jobs:
            job.result()
    tags = tables.dimension("tags").collect()
    assert sorted(t.tag_name for t in tags) == sorted([f"f{i}" for i in range(6)] + ["same"])
    assert len({t.id for t in tags}) == 7


def test_a_lost_claim_starts_over(spark, folder):
    """Another process wins the version: its rows are in the snapshot of the second try."""
    tables, other = stored(spark, folder, 1), Tables(spark, folder)
    tries = []

    def change(old):
        tries.append(old.count())
        if len(tries) == 1:  # as another process would, between reading and claiming
            other.update_dimension("devices", lambda d: d.unionByName(devices(spark, 2)))
        return old.unionByName(devices(spark, 3))

    tables.update_dimension("devices", change)
    assert tries == [1, 2]
    assert rows(tables.dimension("devices"), "lsid") == [(1,), (2,), (3,)]


def test_weather_other_and_all_partitions_are_replayed(spark, folder):
    data = [record(1, {"a": 1}, ts=1), record(2, {"a": 2}, ts=2, partition=3), record(3, {"a": 3}, ts=3, topic="weather.other")]
    tables = stored(spark, folder, 1)
    assert replay(messages(spark, *data), tables)["numeric"] == 3
    strict = stored(spark, f"{folder}/strict", 1)
    assert replay(messages(spark, *data), strict, partition=0, strict_topics=True)["numeric"] == 1


def test_stages_of_a_scope_go_with_it(spark, folder):
    import os

    from hearthstream.session import cut_lineage, own_stages

    kept = cut_lineage(spark.range(3))
    with own_stages(spark):
        inner = cut_lineage(spark.range(5)).inputFiles()[0]
        assert os.path.exists(inner.removeprefix("file://"))
    assert not os.path.exists(inner.removeprefix("file://")) and kept.count() == 3


def test_versions_of_orphans_are_not_sorted_before_they_are_dealt_out(spark, folder, monkeypatch):
    empty = schemas.empty(spark, schemas.ORPHANS_DDL)
    fresh = spark.range(40).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), (F.col("id") % 20).alias("offset"),
        F.col("id").alias("lsid"), F.lit("r").alias("reason"), F.lit("").alias("tag_name"),
        F.timestamp_seconds("id").alias("created_at"), (F.col("id") == 3).alias("reprocessed"))
    empty.unionByName(fresh, allowMissingColumns=True).write.parquet(f"{folder}/log")
    log = spark.read.schema(schemas.ORPHANS_DDL).parquet(f"{folder}/log")
    monkeypatch.setattr(O, "SORTED_ROWS", 10)
    current = O.latest_versions(log)
    assert sorted((r.offset, r.lsid, r.reprocessed) for r in current.collect()) == [(k, k + 20, k == 3) for k in range(20)]
    below = O.latest_versions(log)._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)[1]
    assert "Sort" not in below and "hashpartitioning(topic" in below and ", 5)" in below.split("\n")[0]
