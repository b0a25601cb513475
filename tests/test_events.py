import json
import re

import pytest

from pyspark.sql import functions as F

from hearthstream import schemas
from hearthstream.operators import cameras as C
from hearthstream.operators import commands as M
from hearthstream.operators import states as S
from hearthstream.operators.envelope import headers_map
from hearthstream.streaming.states import state_change_stream
from helpers import message, messages, rows


def raw(spark, *events):
    lines = [e if isinstance(e, str) else json.dumps(e) for e in events]
    return spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n int, raw string")


EVENT = {"id": "e1", "modelKey": "event", "type": "smart", "start": 1700000000500, "end": 0, "smartDetectTypes": ["person"], "camera": "c1"}


def test_unwrap(spark):
    out = C.unwrap_event(raw(spark, {"type": "add", "item": {"id": "x"}}, {"id": "y"}, "  ", "not json"))
    assert rows(out) == [(0, '{"id":"x"}'), (1, '{"id": "y"}'), (3, "not json")]


def test_classification_in_array_order(spark):
    cases = [(["face", "smoke", "person"], "x"), (["person", "smoke"], "x"), (["face"], "smartMotion"), ([], "MOTION"), (None, "ring"), (["babyCry"], None), (["coAlarm"], ""), (["speak"], ""), (["vehicle"], ""), (["animal"], ""), (["package"], "")]
    df = spark.createDataFrame(cases, "t array<string>, k string")
    got = [r[0] and tuple(r[0]) for r in df.select(C.classify_event(F.col("t"), F.col("k"))).collect()]
    assert got == [("audio", "smoke"), ("smart", "person"), ("motion", "motion"), ("motion", "motion"), None,
                   ("audio", "babyCry"), ("audio", "coAlarm"), ("audio", "speak"), ("smart", "vehicle"), ("smart", "animal"), ("smart", "package")]


def test_camera_messages(spark):
    cams = spark.createDataFrame([("c1", "Front Door", "CONNECTED"), ("d2", "Side-Gate", "OFF")], "id string, name string, state string")
    out = C.camera_event_messages(raw(
        spark, EVENT, {"type": "add", "item": EVENT | {"device": "d2", "start": 0, "end": 5500}},
        EVENT | {"camera": "zz", "start": 0}, EVENT | {"modelKey": "camera"}, EVENT | {"smartDetectTypes": []}), cams, F.lit(99))
    got = out.select("topic", "key", headers_map(F.col("headers")).alias("h"))
    assert rows(got.select("key", "topic", "h.camera_id", "h.source")) == [
        ("front_door:1700000000", "unifi.protect.smart", "c1", "unifi-protect"),
        ("side_gate:5", "unifi.protect.smart", "d2", "unifi-protect"), ("zz:99", "unifi.protect.smart", "zz", "unifi-protect")]
    assert C.cameras_by_state(cams).first() == (2, 1, 1)
    assert rows(C.only_connected(cams), "id") == [("c1",)]


def test_archive_event_rules(spark):
    def m(n, body, headers=None, key="Front Door:17"):
        return message(n, EVENT | body, headers, key=key)

    out = C.archive_events(messages(
        spark, m(1, {}), m(2, {"smartDetectTypes": ["Odd Type"]}, {"camera_name": "Back-Yard"}),
        m(3, {"smartDetectTypes": []}, {"detection_type": "vehicle"}), m(4, {"smartDetectTypes": []}),
        m(5, {"id": ""}), m(6, {"start": 0}), m(7, {}, None, ":17"), m(8, {"end": 1700000009000})))
    assert rows(out, "camera", "detection_type", "end_ms") == [
        ("back_yard", "odd_type", None), ("front_door", "person", 1700000009000), ("front_door", "person", None),
        ("front_door", "unknown", None), ("front_door", "vehicle", None)]


def attrs(**kw):
    return json.dumps(kw)


def test_entity_topics(spark):
    cases = [
        ("climate.a", attrs(), "thermostat.climate"), ("weather.a", attrs(), "weather"),
        ("sensor.a", attrs(device_class="Battery", unit_of_measurement="%"), "sensor.battery"),
        ("sensor.Battery_b", attrs(unit_of_measurement="°F"), "sensor.battery"),
        ("sensor.c", attrs(unit_of_measurement="F"), "sensor.temperature"),
        ("sensor.d", attrs(unit_of_measurement="°"), "sensor.temperature"),
        ("sensor.e", attrs(device_class="temperature"), "sensor.temperature"),
        ("sensor.f", attrs(unit_of_measurement="%"), "sensor.humidity"),
        ("sensor.g", attrs(device_class=5), "other"), ("sensor.h", None, "other"),
        ("binary_sensor.a", attrs(device_class="occupancy"), "sensor.presence"),
        ("binary_sensor.a_presence", attrs(), "sensor.presence"), ("binary_sensor.b", attrs(device_class="door"), "other"),
        ("switch.a", attrs(), "other"), ("noDomain", attrs(), "other")]
    df = spark.createDataFrame([(e, a) for e, a, _ in cases], "e string, a string").withColumn("m", F.from_json("a", "map<string,variant>"))
    got = [r[0] for r in df.select(S.entity_topic(F.col("e"), F.col("m"))).collect()]
    assert got == [f"homeassistant.ecobee.{t}" for _, _, t in cases]


def test_entity_keys(spark):
    cases = [("sensor.room_temperature", S.TEMPERATURE_TOPIC, "room"), ("sensor.room_humidity", S.TEMPERATURE_TOPIC, "room_humidity"),
             ("binary_sensor.hall_occupancy", S.PRESENCE_TOPIC, "hall"), ("a.b.c_battery", S.BATTERY_TOPIC, "b.c"), ("plain", S.OTHER_TOPIC, "plain")]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "e string, t string")
    assert [r[0] for r in df.select(S.entity_key(F.col("e"), F.col("t"))).collect()] == [c for _, _, c in cases]


def test_fired_epoch(spark):
    values = ["2026-01-26T18:05:00.123456789Z", "2026-01-26T13:05:00-05:00", "2026-01-26T18:05:00.5+00:00", "2026-01-26", "", None]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r[0] for r in df.select(S.fired_epoch(F.col("t"), F.lit(9))).collect()]
    assert got == [1769450700, 1769450700, 1769450700, 9, 9, 9]


def test_entity_filter_precedence(spark):
    df = spark.createDataFrame([("a.ecobee",), ("b.x",), ("c.Y",)], "entity_id string")
    found = S.discover_entities(spark.createDataFrame([("c.Y", "EcoBee"), ("b.x", "hue")], "entity_id string, platform string"), "ecobee")
    assert rows(S.entity_filter(df, ["b.x"], found)) == [("b.x",)]
    assert rows(S.entity_filter(df, [], found)) == [("c.Y",)]
    assert rows(S.entity_filter(df)) == [("a.ecobee",)]


def test_valid_state_events(spark):
    def e(entity, new):
        return json.dumps({"event_type": "state_changed", "data": {"entity_id": entity, "new_state": new}})

    df = spark.createDataFrame([(e("a.b", {"entity_id": "x"}),), (e("", {"entity_id": "c.d"}),), (e("", {}),), (e("a.b", None),)], "raw string")
    events = df.select(F.from_json("raw", schemas.STATE_EVENT_DDL).alias("e")).select("e.*")
    assert rows(S.valid_state_events(events), "entity_id") == [("a.b",), ("c.d",)]


def test_snapshot_changes(spark):
    ddl = "entity_id string, state string, last_changed string, last_updated string"
    old = spark.createDataFrame([("a", "1", "x", "x"), ("b", "1", "x", "x"), ("c", None, "x", "x")], ddl)
    new = spark.createDataFrame([("a", "1", "x", "x"), ("b", "1", "x", "y"), ("c", None, "x", "x"), ("d", "1", "x", "x")], ddl)
    out = S.as_state_changed(S.state_changes(old, new), F.lit("2026-01-01 00:00:00").cast("timestamp"))
    assert rows(out.select("entity_id", "data.old_state.last_updated", "data.new_state.last_updated", "origin", "time_fired")) == [
        ("b", "x", "y", "polling", "2026-01-01T00:00:00.000000Z"), ("d", None, "x", "polling", "2026-01-01T00:00:00.000000Z")]


def test_state_stream_remembers_across_batches(spark, folder):
    ddl = "entity_id string, state string, last_changed string, last_updated string, polled_at bigint"

    def poll(*states):
        spark.createDataFrame([(e, s, "x", "x", t) for e, s, t in states], ddl).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(ddl).parquet(f"{folder}/in")
        append(state_change_stream(stream), folder)
        return rows(spark.read.parquet(f"{folder}/out").select("entity_id", "polled_at", "state", "old_state.state"))

    assert poll(("a", "1", 10), ("a", "1", 20), ("b", "1", 10)) == [("a", 10, "1", None), ("b", 10, "1", None)]
    assert poll(("a", "1", 30), ("b", "2", 5000)) == [("a", 10, "1", None), ("b", 10, "1", None), ("b", 5000, "2", "1")]


def test_commands(spark):
    bodies = ['{"domain":"d","service":"s","entity_id":"e","data":{"t":1}}', '{"domain":"d","service":"s","entity_id":"e","data":{}}',
              '{"service":"s"}', '{"domain":"d","entity_id":"e"}', '{"domain":"d","service":"s","entity_id":""}', "{bad", "null"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "n int, value string")
    valid, invalid = M.validate_commands(df)
    assert rows(invalid, "n", "reason") == [(2, "domain is required"), (3, "service is required"), (4, "entity_id is required"),
                                            (5, M.UNREADABLE), (6, "domain is required")]
    call = '{"type":"call_service","domain":"d","service":"s","target":{"entity_id":"e"}'
    assert rows(valid.select("n", M.service_call_payload(F.col("command")))) == [(0, call + ',"service_data":{"t":1}}'), (1, call + "}")]


def test_climate_commands(spark):
    cases = [("set_temperature", "72"), ("set_hvac_mode", "heat"), ("set_preset_mode", "away"), ("set_fan_mode", "on"), ("turn_on", None), ("turn_off", None), ("set_fan_mode", ""), ("other", "x")]
    df = spark.createDataFrame(cases, "s string, v string")
    got = [r[0] and json.loads(r[0])["data"] for r in df.select(M.climate_command(F.col("s"), F.col("v"), F.lit("c"))).collect()]
    assert got == [{"temperature": 72}, {"hvac_mode": "heat"}, {"preset_mode": "away"}, {"fan_mode": "on"}, {}, {}, None, None]


STATES = "entity_id string, state string, last_changed string, last_updated string, polled_at bigint"


def append(changes, folder):
    changes.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start().awaitTermination()


def test_state_of_a_late_poll_has_its_old_state(spark, folder):
    for state, second in (("A", 100), ("B", 50), ("B", 60), ("A", 55)):
        spark.createDataFrame([("e", state, state, "", second)], STATES).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        append(state_change_stream(spark.readStream.schema(STATES).parquet(f"{folder}/in")), folder)
    log = spark.read.parquet(f"{folder}/out")
    assert sorted(rows(log.select("polled_at", "state", F.col("old_state.state").alias("old"))), key=repr) == [
        (100, "A", None), (50, "B", "A"), (55, "A", "B")]


def test_state_stream_orders_equal_times_and_starts_from_known_states(spark, folder):
    ddl = STATES + ", n int"
    polls = [("e", "on", "x", "x", 5, 2), ("e", "off", "x", "x", 5, 1), ("e", None, "x", "x", 5, 3), ("f", "on", "x", "x", 1, 1)]
    spark.createDataFrame(polls, ddl).coalesce(1).write.parquet(f"{folder}/in")
    known = spark.createDataFrame([("f", "on", "x", "x", 0), ("g", "on", "x", "x", 0)], STATES)
    append(state_change_stream(spark.readStream.schema(ddl).parquet(f"{folder}/in"), ["polled_at", "n"], known), folder)
    log = spark.read.parquet(f"{folder}/out")
    assert sorted(rows(log.select("entity_id", "state", F.col("old_state.state").alias("old"))), key=repr) == [
        ("e", "off", None), ("e", "on", "off"), ("e", None, "on")]


def test_state_stream_calls_the_processor_for_groups_of_entities(spark, folder, monkeypatch):
    from hearthstream.streaming import states

    monkeypatch.setattr(states, "GROUPS", 8)
    polls = spark.range(600).selectExpr("concat('e', id % 300) AS entity_id", "CAST(id AS string) AS state", "'x' AS last_changed",
                                        "'x' AS last_updated", "id AS polled_at")
    polls.write.parquet(f"{folder}/in")
    done = state_change_stream(spark.readStream.schema(polls.schema).parquet(f"{folder}/in")).writeStream.format("parquet").option(
        "path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    done.awaitTermination()
    log = spark.read.parquet(f"{folder}/out")
    assert log.where("old_state IS NULL AND polled_at < 300").count() == 300
    assert log.where("old_state.polled_at = polled_at - 300").count() == 300
    # One key of the operator is a group: with an entity each, there would be 300.
    keys = spark.read.format("statestore").option("stateVarName", "last").load(f"{folder}/ck")
    assert (keys.select("key").distinct().count(), keys.count()) == (8, 300)


@pytest.mark.parametrize("body, reason", [
    ('{"domain":5,"service":"s","entity_id":"e"}', "failed to parse command"),
    ('{"domain":"d","service":"s","entity_id":"e","data":[1]}', "failed to parse command"),
    ('{"domain":"d","service":"s","entity_id":"e","data":null}', None),
    ('{"domain":"","service":"s","entity_id":"e"}', "domain is required"),
    ('[1]', "failed to parse command"),
])
def test_commands_of_wrong_kinds(spark, body, reason):
    from hearthstream.operators.commands import judge_commands

    assert judge_commands(spark.createDataFrame([(body,)], "value string")).first().reason == reason


@pytest.mark.parametrize("extra, good", [
    ('"start":1000', True), ('"start":"oops"', False), ('"start":1000,"end":"bad"', False),
    ('"start":1000,"end":1.5', False), ('"start":1000,"end":1e400', False), ('"start":1000,"end":null', True),
    ('"start":1000,"smartDetectTypes":"person"', False), ('"start":1000,"smartDetectTypes":["person",null]', True),
    ('"start":1000,"smartDetectTypes":[1]', False), ('"start":1000,"type":7', False),
])
def test_events_of_wrong_kinds(spark, extra, good):
    from hearthstream.operators.cameras import only_events, parse_events

    raw = spark.createDataFrame([('{"id":"x","modelKey":"event",' + extra + "}",)], "raw string")
    assert only_events(parse_events(raw)).count() == good


@pytest.mark.parametrize("build", [
    lambda df: C.only_events(C.parse_events(C.unwrap_event(df))).select("event.id", "event.start", "event.type"),
    lambda df: C.archive_events(C.camera_event_messages(
        df, df.sparkSession.createDataFrame([], "id string, name string"), F.lit(5)
    ).withColumn("timestamp", F.lit(5).cast("timestamp"))),
    lambda df: M.judge_commands(df, "raw").where("reason is null").select("command.service"),
])
def test_every_text_is_parsed_once(spark, build):
    """A parse per step: unwrapping, reading the event, reading the archived message."""
    plan = build(raw(spark, EVENT))._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= len(re.findall("parse_?json", plan, re.I)) <= 3 and len(plan) < 40_000
