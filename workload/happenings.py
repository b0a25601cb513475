"""Camera event, smart-home state and command queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream import schemas
from hearthstream.functions import sanitize_name
from hearthstream.operators import cameras as C
from hearthstream.operators import commands as M
from hearthstream.operators import states as S
from hearthstream.operators.envelope import header, headers_map
from hearthstream.operators.ordered import with_chunk
from hearthstream.session import scratch_dir
from hearthstream.streaming.states import state_change_stream
from workload import feeds
from workload.registry import query

# ---- camera events ------------------------------------------------------


def _parsed(spark, sf) -> DataFrame:
    return C.parse_events(C.unwrap_event(feeds.camera_events(spark, sf)))


@query("PRJ20", "SELECT event_id, id, model FROM ce", "ce")
def unwrap_event(spark, sf):
    return _parsed(spark, sf).select(
        "event_id", F.col("event.id").alias("id"), F.col("event.modelKey").alias("model")
    )


@query("PRJ21", "SELECT event_id, id FROM ce WHERE model = 'event'", "ce")
def only_events(spark, sf):
    return C.only_events(_parsed(spark, sf)).select("event_id", F.col("event.id").alias("id"))


@query("PRJ22, FN12, T25", "SELECT event_id, category, detection_type FROM ceclass", "ceclass")
def classify_event(spark, sf):
    kind = C.classify_event(F.col("event.smartDetectTypes"), F.col("event.type"))
    return C.only_events(_parsed(spark, sf)).select("event_id", kind.alias("c")).select(
        "event_id", F.col("c.category").alias("category"), F.col("c.detection_type").alias("detection_type")
    )


@query("PRJ23", "SELECT category, topic, count(*) AS n FROM cenamed GROUP BY ALL", "cenamed")
def event_topic(spark, sf):
    kind = C.classify_event(F.col("event.smartDetectTypes"), F.col("event.type"))
    return (
        C.only_events(_parsed(spark, sf))
        .select(kind["category"].alias("category"))
        .where("category is not null")
        .select("category", C.event_topic(F.col("category")).alias("topic"))
        .groupBy("category", "topic")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("PRJ24, PRJ25, FN13", "SELECT event_id, camera_id, epoch FROM ceclass", "ceclass")
def event_device_and_epoch(spark, sf):
    event = F.col("event")
    return C.only_events(_parsed(spark, sf)).select(
        "event_id",
        C.event_device(event["device"], event["camera"]).alias("camera_id"),
        C.event_epoch(event["start"], event["end"], F.lit(feeds.NOW_EPOCH)).alias("epoch"),
    )


@query("PRJ26", """
SELECT id, replace(replace(lower(name), ' ', '_'), '-', '_') AS name FROM cam""", "cam")
def sanitized_names(spark, sf):
    return feeds.cameras(spark, sf).select("id", sanitize_name(F.col("name")).alias("name"))


@query("JN8", """
SELECT event_id, camera_id, coalesce(replace(replace(lower(c.name), ' ', '_'), '-', '_'), camera_id) AS camera_name
FROM ceclass e LEFT JOIN cam c ON e.camera_id = c.id""", "ceclass", "cam")
def camera_names(spark, sf):
    event = F.col("event")
    events = C.only_events(_parsed(spark, sf)).select(
        "event_id", C.event_device(event["device"], event["camera"]).alias("camera_id")
    )
    return C.with_camera_name(events, feeds.cameras(spark, sf))


@query("PRJ27, SNK7", """
SELECT topic, camera_name || ':' || CAST(epoch AS VARCHAR) AS key, camera_id, category AS event_type,
  detection_type, CAST(epoch AS VARCHAR) AS timestamp, 'unifi-protect' AS source, id
FROM cenamed""", "cenamed")
def camera_event_messages(spark, sf):
    messages = C.camera_event_messages(
        feeds.camera_events(spark, sf), feeds.cameras(spark, sf), F.lit(feeds.NOW_EPOCH)
    )
    names = ["camera_id", "event_type", "detection_type", "timestamp", "source"]
    h = headers_map(F.col("headers"))
    return messages.select(
        "topic", "key", h.alias("h"),
        F.get_json_object(F.col("value").cast("string"), "$.id").alias("id"),
    ).select("topic", "key", "id", *[F.col("h")[n].alias(n) for n in names])


@query("PRJ28, T26", """
SELECT replace(replace(lower(camera_name), ' ', '_'), '-', '_') AS camera,
  lower(CASE WHEN len(types) > 0 THEN types[1] ELSE detection_type END) AS detection_type,
  id AS event_id, start_ms, end_ms
FROM cenamed WHERE start_ms > 0""", "cenamed")
def archive_events(spark, sf):
    messages = C.camera_event_messages(
        feeds.camera_events(spark, sf), feeds.cameras(spark, sf), F.lit(feeds.NOW_EPOCH)
    ).withColumn("timestamp", feeds.now())
    # Half of the messages have lost their camera header and fall back to the key.
    bare = F.filter("headers", lambda h: h["key"] != "camera_name")
    lossy = messages.withColumn(
        "headers", F.when(F.crc32("value") % 2 == 0, bare).otherwise(F.col("headers"))
    )
    return C.archive_events(lossy).select(
        "camera", "detection_type", "event_id", "start_ms", "end_ms"
    )


@query("AGG15", """
SELECT count(*) AS cameras, count(*) FILTER (state = 'CONNECTED') AS online,
  count(*) FILTER (state <> 'CONNECTED') AS offline FROM cam""", "cam")
def cameras_by_state(spark, sf):
    return C.cameras_by_state(feeds.cameras(spark, sf))


@query("PRJ44", "SELECT id FROM cam WHERE state = 'CONNECTED'", "cam")
def only_connected(spark, sf):
    return C.only_connected(feeds.cameras(spark, sf)).select("id")


# ---- states -------------------------------------------------------------


def _attributes():
    """Device class and unit by event number."""
    i = F.col("event_id") % 7
    device_class = (
        F.when(i == 0, "Temperature").when(i == 1, "humidity").when(i == 2, "battery")
        .when(i == 3, "motion")
    )
    unit = F.when(i == 4, "°F").when(i == 5, "%").when(i == 2, "%")
    attributes = F.to_json(
        F.struct(device_class.alias("device_class"), unit.alias("unit_of_measurement"))
    )
    return F.from_json(attributes, "map<string,variant>")


_TOPIC = """CASE
  WHEN entity_id LIKE 'climate.%' THEN 'homeassistant.ecobee.thermostat.climate'
  WHEN entity_id LIKE 'weather.%' THEN 'homeassistant.ecobee.weather'
  WHEN entity_id LIKE 'sensor.%' AND (event_id % 7 = 2 OR entity_id LIKE '%battery%') THEN 'homeassistant.ecobee.sensor.battery'
  WHEN entity_id LIKE 'sensor.%' AND event_id % 7 IN (0, 4) THEN 'homeassistant.ecobee.sensor.temperature'
  WHEN entity_id LIKE 'sensor.%' AND event_id % 7 IN (1, 5) THEN 'homeassistant.ecobee.sensor.humidity'
  WHEN entity_id LIKE 'binary_sensor.%' AND event_id % 7 = 3 THEN 'homeassistant.ecobee.sensor.presence'
  ELSE 'homeassistant.ecobee.other' END"""

_NAME = "CASE WHEN strpos(entity_id, '.') > 0 THEN substr(entity_id, strpos(entity_id, '.') + 1) ELSE entity_id END"

_KEY = f"""CASE
  WHEN topic LIKE '%.temperature' AND name LIKE '%\\_temperature' ESCAPE '\\' THEN left(name, length(name) - 12)
  WHEN topic LIKE '%.humidity' AND name LIKE '%\\_humidity' ESCAPE '\\' THEN left(name, length(name) - 9)
  WHEN topic LIKE '%.battery' AND name LIKE '%\\_battery' ESCAPE '\\' THEN left(name, length(name) - 8)
  ELSE name END"""


@query("PRJ33, T24", f"SELECT event_id, entity_id, {_TOPIC} AS topic FROM st", "st")
def entity_topic(spark, sf):
    return feeds.states(spark, sf).withColumn("attributes", _attributes()).select(
        "event_id", "entity_id", S.entity_topic(F.col("entity_id"), F.col("attributes")).alias("topic")
    )


@query("PRJ34, FN10", f"""
SELECT event_id, {_KEY} AS key FROM (SELECT *, {_TOPIC} AS topic, {_NAME} AS name FROM st)""", "st")
def entity_key(spark, sf):
    topic = S.entity_topic(F.col("entity_id"), F.col("attributes"))
    return (
        feeds.states(spark, sf)
        .withColumn("attributes", _attributes())
        .withColumn("topic", topic)
        .select("event_id", S.entity_key(F.col("entity_id"), F.col("topic")).alias("key"))
    )


@query("PRJ32", """
SELECT DISTINCT entity_id, CASE WHEN strpos(entity_id, '.') > 0 THEN split_part(entity_id, '.', 1) ELSE '' END AS domain
FROM st""", "st")
def entity_domain(spark, sf):
    ids = feeds.states(spark, sf).select("entity_id").distinct()
    return ids.withColumn("domain", S.entity_domain(F.col("entity_id")))


@query("AGG14", """
SELECT domain, count(*) AS entities, bool_or(entity_id LIKE '%battery%') AS has_battery FROM (
  SELECT DISTINCT entity_id, CASE WHEN strpos(entity_id, '.') > 0 THEN split_part(entity_id, '.', 1) ELSE '' END AS domain
  FROM st) GROUP BY domain""", "st")
def entities_by_domain(spark, sf):
    return S.entities_by_domain(feeds.states(spark, sf).select("entity_id").distinct())


@query("PRJ29", """
SELECT 'explicit' AS rule, count(*) AS n FROM st WHERE entity_id IN ('weather.user_1_humidity', 'climate.user_6_battery')
UNION ALL SELECT 'discovered', count(*) FROM st WHERE entity_id LIKE 'climate.%'
UNION ALL SELECT 'substring', count(*) FROM st WHERE entity_id LIKE '%ecobee%'""", "st")
def entity_filter(spark, sf):
    states = feeds.states(spark, sf)
    found = states.where("entity_id like 'climate.%'").select("entity_id").distinct()
    wanted = {
        "explicit": S.entity_filter(
            states, ["weather.user_1_humidity", "climate.user_6_battery"], found
        ),
        "discovered": S.entity_filter(states, None, found),
        "substring": S.entity_filter(states),
    }
    from hearthstream.operators.audit import counted

    return counted(**wanted).withColumnRenamed("table_name", "rule").withColumnRenamed("count", "n")


@query("PRJ30, JN18", """
SELECT entity_id, count(*) AS n FROM st WHERE entity_id IN (
  SELECT entity_id FROM st WHERE event_id % 3 = 0) GROUP BY entity_id""", "st")
def discovered_entities(spark, sf):
    states = feeds.states(spark, sf)
    registry = states.select(
        "entity_id", F.when(F.col("event_id") % 3 == 0, "EcoBee").otherwise("hue").alias("platform")
    ).distinct()
    found = S.discover_entities(registry, "ecobee")
    return S.match_discovered(states, found).groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))


def state_events(spark, sf) -> DataFrame:
    """State-change events as JSON text, some without id, new state or time."""
    states = feeds.states(spark, sf).withColumn("attributes", _attributes())
    event = F.col("event_id")
    new_state = F.struct(
        "entity_id", "state", "attributes", "last_changed", "last_updated"
    )
    body = F.to_json(
        F.struct(
            F.lit("state_changed").alias("event_type"),
            F.struct(
                F.when(event % 4 != 0, F.col("entity_id")).otherwise("").alias("entity_id"),
                F.when(event % 5 != 0, new_state).alias("new_state"),
            ).alias("data"),
            F.lit("LOCAL").alias("origin"),
            F.when(
                event % 3 != 0,
                F.concat(
                    F.date_format(F.timestamp_seconds("polled_at"), "yyyy-MM-dd'T'HH:mm:ss"),
                    F.lit(".123456789+00:00"),
                ),
            ).otherwise("yesterday").alias("time_fired"),
        )
    )
    raw = states.select("event_id", body.alias("raw"))
    return raw.select("*", F.from_json("raw", schemas.STATE_EVENT_DDL).alias("e")).select(
        "event_id", "raw", "e.*"
    )


@query("PRJ31", "SELECT event_id, entity_id FROM st WHERE event_id % 5 <> 0", "st")
def valid_state_events(spark, sf):
    return S.valid_state_events(state_events(spark, sf)).select("event_id", "entity_id")


@query("PRJ35", "SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN polled_at ELSE 1767225600 END AS epoch FROM st", "st")
def fired_epoch(spark, sf):
    return state_events(spark, sf).select(
        "event_id", S.fired_epoch(F.col("time_fired"), F.lit(feeds.NOW_EPOCH)).alias("epoch")
    )


@query("PRJ36, SNK7", f"""
SELECT event_id, topic, {_KEY} || ':' || CAST(CASE WHEN event_id % 3 <> 0 THEN polled_at ELSE 1767225600 END AS VARCHAR) AS key,
  entity_id, CASE WHEN strpos(entity_id, '.') > 0 THEN split_part(entity_id, '.', 1) ELSE '' END AS domain,
  'homeassistant' AS source
FROM (SELECT *, {_TOPIC} AS topic, {_NAME} AS name FROM st WHERE event_id % 5 <> 0)""", "st")
def state_event_messages(spark, sf):
    valid = S.valid_state_events(state_events(spark, sf))
    tagged = valid.withColumn(
        "raw", F.to_json(F.struct("event_id", F.col("raw").alias("event")))
    )
    messages = S.state_event_messages(tagged, F.lit(feeds.NOW_EPOCH))
    return messages.select(
        F.get_json_object(F.col("value").cast("string"), "$.event_id").cast("bigint").alias("event_id"),
        "topic", "key", header("entity_id").alias("entity_id"), header("domain").alias("domain"),
        header("source").alias("source"),
    )


@query("JN17", """
WITH p AS (SELECT * FROM st WHERE event_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY event_id) = 1),
c AS (SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY event_id DESC) = 1)
SELECT c.entity_id, p.state AS old_state, c.state AS new_state, 'polling' AS origin, 'state_changed' AS event_type
FROM c LEFT JOIN p USING (entity_id)
WHERE p.entity_id IS NULL OR p.state <> c.state OR p.last_changed <> c.last_changed""", "st")
def state_changes(spark, sf):
    from hearthstream.operators.keyed import first_wins, last_wins

    columns = ["entity_id", "state", "last_changed", "last_updated", "event_id"]
    states = feeds.states(spark, sf).select(*columns)
    previous = first_wins(states.where("event_id % 2 = 0"), ["entity_id"], F.col("event_id"))
    current = last_wins(states, ["entity_id"], F.col("event_id"))
    changes = S.state_changes(previous.drop("event_id"), current.drop("event_id"))
    return S.as_state_changed(changes, feeds.now()).select(
        "entity_id",
        F.col("data.old_state.state").alias("old_state"),
        F.col("data.new_state.state").alias("new_state"),
        "origin", "event_type",
    )


_LOG = """
SELECT entity_id, event_id, state, old FROM (
  SELECT *, lag(state) OVER w AS old, lag(last_changed) OVER w AS oldc FROM st
  WINDOW w AS (PARTITION BY entity_id ORDER BY polled_at, event_id))
WHERE old IS NULL OR old <> state OR oldc <> last_changed"""


@query("WIN3", _LOG, "st")
def state_change_log(spark, sf):
    log = S.state_change_log(
        feeds.states(spark, sf), ["polled_at", "event_id"], F.col("polled_at"), chunk=86400
    )
    return log.select("entity_id", "event_id", "state", F.col("old_state.state").alias("old"))


@query("STR8, WIN3", _LOG.replace("event_id, state", "event_id, polled_at, state", 1).replace(
    "SELECT entity_id, event_id, polled_at", "SELECT entity_id, polled_at", 1), "st")
def state_changes_streamed(spark, sf):
    """Three groups of polls, with a restart after each; equal times in order of arrival."""
    states = feeds.states(spark, sf).select(
        "entity_id", "state", "last_changed", "last_updated", "polled_at", "event_id"
    )
    span = states.agg(F.min("polled_at").alias("lo"), F.max("polled_at").alias("hi")).first()
    group = F.floor((F.col("polled_at") - span.lo) * 3 / (span.hi - span.lo + 1))
    inbox, out, offsets = (scratch_dir(spark, x) for x in ("inbox", "changes", "offsets"))
    for g in range(3):
        states.where(group == g).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(states.schema).parquet(inbox)
        changes = state_change_stream(stream, ["polled_at", "event_id"])
        changes.writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", offsets
        ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select(
        "entity_id", "polled_at", "state", F.col("old_state.state").alias("old")
    )


@query("WIN3", "SELECT entity_id, polled_at // 86400 AS chunk, count(*) AS n FROM st GROUP BY ALL", "st")
def state_chunks(spark, sf):
    chunked = with_chunk(feeds.states(spark, sf), F.col("polled_at"), 86400)
    return chunked.groupBy("entity_id", F.col("_chunk").alias("chunk")).agg(F.count(F.lit(1)).alias("n"))


# ---- commands -----------------------------------------------------------


@query("PRJ37", "SELECT event_id, reason FROM cmd", "cmd")
def validate_commands(spark, sf):
    return M.judge_commands(feeds.commands(spark, sf)).select("event_id", "reason")


@query("PRJ37", """
SELECT event_id, CASE event_id % 8 WHEN 0 THEN NULL WHEN 5 THEN 'domain is required' WHEN 6 THEN NULL
  ELSE 'failed to parse command' END AS reason FROM m""", "m")
def commands_of_wrong_kinds(spark, sf):
    bodies = F.array(*[F.lit(b) for b in (
        '{"domain":"light","service":"turn_on","entity_id":"light.a","data":{"k":1}}',
        '{"domain":5,"service":"turn_on","entity_id":"light.a"}',
        '{"domain":"light","service":["turn_on"],"entity_id":"light.a"}',
        '{"domain":"light","service":"turn_on","entity_id":true}',
        '{"domain":"light","service":"turn_on","entity_id":"light.a","data":[1]}',
        '{"domain":null,"service":"turn_on","entity_id":"light.a"}',
        '{"domain":"light","service":"turn_on","entity_id":"light.a","data":null}',
        '{"domain":"light","service":"turn_on","entity_id":"light.a"} tail',
    )])
    events = feeds.events(spark, sf).select(
        "event_id", F.get(bodies, (F.col("event_id") % 8).cast("int")).alias("value")
    )
    return M.judge_commands(events).select("event_id", "reason")


@query("PRJ21, PRJ28", """
SELECT event_id, hts * 1000 AS start_ms FROM m WHERE event_id % 8 IN (0, 7)""", "m")
def events_of_wrong_kinds(spark, sf):
    event = feeds.events(spark, sf).select("event_id", (F.col("hts") * 1000).cast("string").alias("ms"))
    wrong = F.array(*[F.lit(b) for b in (
        '', ',"end":"bad"', ',"type":5', ',"smartDetectTypes":[1]', ',"smartDetectTypes":"person"',
        ',"end":1e400', ',"end":1.5', ',"end":null,"type":null,"smartDetectTypes":[null]',
    )])
    raw = event.select(
        "event_id",
        F.concat(
            F.lit('{"id":"x","modelKey":"event","start":'), "ms",
            F.get(wrong, (F.col("event_id") % 8).cast("int")), F.lit("}"),
        ).alias("raw"),
    )
    return C.only_events(C.parse_events(raw)).select("event_id", F.col("event.start").alias("start_ms"))


@query("PRJ38", """
SELECT event_id, '{"type":"call_service","domain":"climate","service":"set_temperature","target":{"entity_id":"'
  || entity_id || '"}' || CASE WHEN event_id % 2 = 0 THEN ',"service_data":{"temperature":' || CAST(k AS VARCHAR) || '}'
  ELSE '' END || '}' AS payload
FROM cmd WHERE reason IS NULL""", "cmd")
def service_call_payload(spark, sf):
    valid, _ = M.validate_commands(feeds.commands(spark, sf))
    return valid.select("event_id", M.service_call_payload(F.col("command")).alias("payload"))


@query("PRJ39", """
SELECT event_id, CASE event_id % 7
  WHEN 0 THEN '{"domain":"climate","service":"set_temperature","entity_id":"c","data":{"temperature":' || CAST(k AS VARCHAR) || '}}'
  WHEN 1 THEN '{"domain":"climate","service":"set_hvac_mode","entity_id":"c","data":{"hvac_mode":"' || CAST(k AS VARCHAR) || '"}}'
  WHEN 2 THEN '{"domain":"climate","service":"set_preset_mode","entity_id":"c","data":{"preset_mode":"' || CAST(k AS VARCHAR) || '"}}'
  WHEN 3 THEN '{"domain":"climate","service":"set_fan_mode","entity_id":"c","data":{"fan_mode":"' || CAST(k AS VARCHAR) || '"}}'
  WHEN 4 THEN '{"domain":"climate","service":"turn_on","entity_id":"c","data":{}}'
  WHEN 5 THEN '{"domain":"climate","service":"turn_off","entity_id":"c","data":{}}' END AS command
FROM cmd""", "cmd")
def climate_command(spark, sf):
    names = ["set_temperature", "set_hvac_mode", "set_preset_mode", "set_fan_mode", "turn_on", "turn_off", "dance"]
    service = F.get(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % 7).cast("int"))
    return feeds.commands(spark, sf).select("event_id", service.alias("service"), "k").select(
        "event_id",
        M.climate_command(F.col("service"), F.col("k").cast("string"), F.lit("c")).alias("command"),
    )
