"""Snapshot shaping queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream import schemas
from hearthstream.operators import ingest as I
from hearthstream.operators.envelope import headers_map, with_header_columns
from hearthstream.plans.ingest import shape_metadata, shape_snapshots
from hearthstream.session import scratch_dir
from hearthstream.sources import files
from hearthstream.streaming.ingest import ingest_stream
from workload import feeds
from workload.dimensions import catalog_entries
from workload.registry import query


def snapshot_lines(spark, sf) -> DataFrame:
    """Snapshot payloads of ten events each.

    A sensor entry has the event's point twice, the second time without a valid
    time where the event number divides by seven.
    """
    ev = feeds.events(spark, sf)
    point = F.struct(
        F.col("hts").alias("ts"), "value", F.col("event_type").alias("kind")
    )
    odd = F.struct(F.col("hts").cast("string").alias("ts"), "value", F.col("event_type").alias("kind"))
    second = F.when(F.col("event_id") % 7 == 0, F.to_json(odd)).otherwise(F.to_json(point))
    sensor = F.struct(
        F.col("event_id"),
        F.col("user_id").alias("lsid"),
        "sensor_type",
        F.col("dst").alias("data_structure_type"),
        F.array(F.parse_json(F.to_json(point)), F.parse_json(second)).alias("data"),
    )
    # Ten events per payload: the group size is fixed, whatever the input.
    payload = ev.groupBy(F.floor(F.col("event_id") / 10).alias("generated_at")).agg(
        F.sort_array(F.collect_list(F.struct("event_id", F.to_json(sensor).alias("s")))).alias("e")
    )
    joined = F.concat_ws(",", F.transform("e", lambda x: x["s"]))
    return payload.select(
        F.concat(
            F.lit('{"station_id":1,"generated_at":'), F.col("generated_at").cast("string"),
            F.lit(',"sensors":['), joined, F.lit("]}"),
        ).alias("value")
    )


def snapshots(spark, sf) -> DataFrame:
    path = scratch_dir(spark, "snapshots")
    snapshot_lines(spark, sf).write.text(path)
    return files.read_current_conditions(spark, path, one_per_file=False)


def points(spark, sf) -> DataFrame:
    return I.keyed_points(I.explode_points(snapshots(spark, sf)))


POINTS = """
SELECT m.*, CAST(i AS BIGINT) AS point_pos, CASE WHEN i = 1 AND event_id % 7 = 0 THEN 0 ELSE hts END AS pts
FROM m, (VALUES (0), (1)) v(i)"""

KEY = "CAST(lsid AS VARCHAR) || ':' || CAST(pts AS VARCHAR)"

TOPIC = """CASE category WHEN 'ISS' THEN 'weather.iss' WHEN 'Barometer' THEN 'weather.barometer'
  WHEN 'Inside Temp/Hum' THEN 'weather.indoor' WHEN 'HEALTH' THEN 'weather.health'
  ELSE 'weather.other' END"""


@query("SRC5, PRJ8", """
SELECT event_id // 10 AS snapshot, event_id % 10 AS sensor_pos, CAST(i AS BIGINT) AS point_pos, lsid, sensor_type, dst AS data_structure_type
FROM m, (VALUES (0), (1)) v(i)""", "m")
def explode_points(spark, sf):
    exploded = I.explode_points(snapshots(spark, sf))
    whole = ["sensor_pos", "point_pos", "sensor_type", "data_structure_type"]
    return exploded.select(
        "snapshot", "lsid", *[F.col(c).cast("bigint").alias(c) for c in whole]
    )


@query("PRJ9, PRJ10, T22", f"SELECT lsid, pts AS ts, {KEY} AS key FROM ({POINTS})", "m")
def point_keys(spark, sf):
    return points(spark, sf).select("lsid", "ts", "key")


@query("JN5", f"SELECT lsid, pts AS ts, category FROM ({POINTS}) JOIN dev USING (lsid)", "dev")
def with_sensor(spark, sf):
    return I.with_sensor(points(spark, sf), feeds.devices(spark, sf)).select("lsid", "ts", "category")


@query("DED3", f"""
SELECT {KEY} AS key, event_id // 10 AS snapshot, event_id % 10 AS sensor_pos, point_pos FROM ({POINTS})
QUALIFY row_number() OVER (PARTITION BY lsid, pts ORDER BY event_id, point_pos) = 1""", "m")
def dedup_keys(spark, sf):
    return I.dedup_keys(points(spark, sf)).select(
        "key", "snapshot", F.col("sensor_pos").cast("bigint").alias("sensor_pos"),
        F.col("point_pos").cast("bigint").alias("point_pos"),
    )


def _published(spark, sf) -> DataFrame:
    """Keys of the even events count as published."""
    return files.distinct_keys(feeds.messages(spark, sf).where(F.col("offset") % 2 == 0))


_PUBLISHED = "SELECT CAST(lsid AS VARCHAR) || ':' || CAST(hts AS VARCHAR) FROM m WHERE event_id % 2 = 0"


@query("JN6", f"""
SELECT {KEY} AS key, count(*) AS points FROM ({POINTS}) WHERE {KEY} NOT IN ({_PUBLISHED}) GROUP BY key""", "m")
def unpublished(spark, sf):
    return I.unpublished(points(spark, sf), _published(spark, sf)).groupBy("key").agg(
        F.count(F.lit(1)).alias("points")
    )


_SHAPED = f"""
SELECT {KEY} AS key, {TOPIC} AS topic, lsid, pts AS ts, sensor_type, dst AS data_structure_type, value
FROM ({POINTS}) JOIN (SELECT lsid, category FROM dev) USING (lsid)
WHERE {{where}}
QUALIFY row_number() OVER (PARTITION BY lsid, pts ORDER BY event_id, point_pos) = 1"""


def _shaped_view(messages: DataFrame) -> DataFrame:
    columns = with_header_columns(messages)
    body = F.col("value").cast("string")
    return columns.select(
        "key", "topic", "lsid", F.col("record_ts").alias("ts"), "sensor_type", "data_structure_type",
        F.get_json_object(body, "$.value").cast("double").alias("value"),
    )


@query("PRJ11, PRJ12, PRJ8, JN5, JN6, DED3", _SHAPED.format(where=f"{KEY} NOT IN ({_PUBLISHED})"), "dev")
def shaped_snapshots(spark, sf):
    return _shaped_view(
        shape_snapshots(snapshots(spark, sf), feeds.devices(spark, sf), _published(spark, sf))
    )


@query("STR5, SNK7, DED3, JN6", """
SELECT key, topic, lsid, ts, sensor_type, data_structure_type FROM (""" + _SHAPED.format(where="true") + ")", "dev")
def ingest_streamed(spark, sf):
    inbox = scratch_dir(spark, "inbox")
    order = F.get_json_object("value", "$.generated_at").cast("bigint")
    feeds.fill_inbox(snapshot_lines(spark, sf), inbox, order, "text")
    stream = (
        spark.readStream.schema(schemas.SNAPSHOT_DDL).option("maxFilesPerTrigger", 1).json(inbox)
    )
    out = scratch_dir(spark, "published")
    run = ingest_stream(stream, feeds.devices(spark, sf), out, scratch_dir(spark, "offsets"))
    run.trigger(availableNow=True).start().awaitTermination()
    return _shaped_view(files.read_envelope_files(spark, out)).drop("value")


@query("AGG8", f"""
SELECT
  (SELECT count(*) FROM (SELECT DISTINCT lsid, pts FROM p WHERE known AND NOT done)) AS published,
  (SELECT count(*) FROM p WHERE known) - (SELECT count(*) FROM (SELECT DISTINCT lsid, pts FROM p WHERE known AND NOT done)) AS skipped,
  (SELECT count(*) FROM p WHERE NOT known) AS unknown_sensor
FROM (SELECT 1)""".replace(" p ", f""" (SELECT *, lsid IN (SELECT lsid FROM dev) AS known,
  {KEY} IN ({_PUBLISHED}) AS done FROM ({POINTS})) """), "dev")
def ingest_counts(spark, sf):
    return I.ingest_counts(points(spark, sf), feeds.devices(spark, sf), _published(spark, sf))


@query("PRJ11, T21", f"SELECT DISTINCT category, {TOPIC} AS topic FROM dev", "dev")
def topic_for_category(spark, sf):
    return (
        feeds.devices(spark, sf)
        .select("category")
        .distinct()
        .withColumn("topic", I.topic_for_category(F.lower("category")))
    )


@query("PRJ12", """
SELECT off, '1' AS schema_version, CAST(lsid AS VARCHAR) AS lsid, CAST(hts AS VARCHAR) AS timestamp,
  CAST(sensor_type AS VARCHAR) AS sensor_type, CAST(dst AS VARCHAR) AS data_structure_type FROM m""", "m")
def record_headers(spark, sf):
    headers = headers_map(F.col("headers"))
    names = ["schema_version", "lsid", "timestamp", "sensor_type", "data_structure_type"]
    return (
        feeds.messages(spark, sf)
        .select(F.col("offset").alias("off"), headers.alias("h"))
        .select("off", *[F.col("h")[n].alias(n) for n in names])
    )


# ---- metadata -----------------------------------------------------------


@query("AGG13", "SELECT DISTINCT sensor_type FROM dev", "dev")
def sensor_types(spark, sf):
    return I.sensor_types(feeds.devices(spark, sf)).select(
        F.col("sensor_type").cast("bigint").alias("sensor_type")
    )


@query("JN7", """
SELECT sensor_type, structure AS data_structure_type, field AS field_name FROM cat
WHERE sensor_type IN (SELECT sensor_type FROM dev)""", "cat", "dev")
def owned_catalog(spark, sf):
    return I.owned_catalog(feeds.catalog(spark, sf), feeds.devices(spark, sf)).select(
        F.col("sensor_type").cast("bigint").alias("sensor_type"), "data_structure_type", "field_name"
    )


@query("PRJ13", """
SELECT DISTINCT user_id AS sensor_type,
  CASE WHEN user_id % 5 <> 0 THEN greatest(user_id % 4, user_id % 7) END AS max_type FROM m""", "m")
def max_data_structure_type(spark, sf):
    return catalog_entries(spark, sf).select(
        F.col("sensor_type").cast("bigint").alias("sensor_type"),
        I.max_data_structure_type(F.col("data_structures")).alias("max_type"),
    )


_WEEK = "1766966400"  # Monday before the fixed present


@query("PRJ14, DED4, JN6, JN7, T23", f"""
WITH c AS (SELECT DISTINCT user_id AS t, greatest(user_id % 4, user_id % 7) AS mx FROM m WHERE user_id % 5 <> 0
  AND user_id IN (SELECT sensor_type FROM dev)),
k AS (
  SELECT 'weather.metadata.sensors' AS topic, CAST(lsid AS VARCHAR) || ':{_WEEK}' AS key FROM dev
  UNION ALL SELECT 'weather.metadata.catalog', CAST(t AS VARCHAR) || ':' || CAST(mx AS VARCHAR) FROM c
  UNION ALL SELECT 'weather.metadata.station', '7:{_WEEK}')
SELECT key, min(CASE topic WHEN 'weather.metadata.sensors' THEN topic WHEN 'weather.metadata.catalog' THEN topic
  ELSE topic END) AS topic
FROM k WHERE key NOT IN (SELECT CAST(lsid AS VARCHAR) || ':{_WEEK}' FROM dev WHERE lsid % 2 = 0)
  AND NOT (topic = 'weather.metadata.station' AND key IN (SELECT CAST(lsid AS VARCHAR) || ':{_WEEK}' FROM dev))
GROUP BY key""", "dev")
def metadata_messages(spark, sf):
    devices = feeds.devices(spark, sf)
    stations = devices.agg(F.count(F.lit(1)).alias("devices"))
    published = devices.where("lsid % 2 = 0").select(
        I.record_key(F.col("lsid"), F.lit(int(_WEEK))).alias("key")
    )
    shaped = shape_metadata(
        devices.select("lsid", "sensor_type", "category"),
        catalog_entries(spark, sf),
        stations,
        "7",
        published,
        F.lit(feeds.NOW_EPOCH),
    )
    return shaped.select("key", "topic")


@query("DED5", """
SELECT user_id, hts, event_id, CAST(floor(value / 50) AS BIGINT) AS v FROM m
QUALIFY CAST(floor(value / 50) AS BIGINT) IS DISTINCT FROM
  lag(CAST(floor(value / 50) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY hts, event_id)""", "m")
def changed_payloads(spark, sf):
    v = F.floor(F.col("value") / 50)
    payloads = feeds.events(spark, sf).select(
        "user_id", "hts", "event_id", v.alias("v"),
        F.to_json(F.struct(v.alias("v"), F.col("hts").alias("generated_at"))).alias("doc"),
    )
    return I.changed_payloads(payloads, ["user_id"], ["hts", "event_id"], "doc").select(
        "user_id", "hts", "event_id", "v"
    )


@query("FN7", "SELECT event_id, sha256(event_type) AS hash FROM m", "m")
def payload_sha256(spark, sf):
    from hearthstream.functions import sha256_hex

    return feeds.events(spark, sf).select("event_id", sha256_hex(F.col("event_type").cast("binary")).alias("hash"))
