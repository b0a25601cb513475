import json

from pyspark.sql import functions as F

from hearthstream.operators import ingest as I
from hearthstream.operators.envelope import with_header_columns
from hearthstream.plans.ingest import shape_metadata, shape_snapshots
from hearthstream.sources import files
from hearthstream.streaming.ingest import ingest_stream
from helpers import devices, rows

SNAPSHOT = {"station_id": 1, "generated_at": 100, "sensors": [
    {"lsid": 1, "sensor_type": 43, "data_structure_type": 23, "data": [{"ts": 1000, "temp": 62.3}, {"ts": 1000, "temp": 1}, {"ts": "1001"}, {"x": None}]},
    {"lsid": 2, "sensor_type": 242, "data_structure_type": 19, "data": [{"ts": 1000.9, "bar": 29}, [1]]},
    {"lsid": 9, "sensor_type": 1, "data_structure_type": 1, "data": [{"ts": 1}]}]}


def snapshot_file(folder, payload, name="a.json"):
    import os

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        json.dump(payload, f, indent=1)
    return folder


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "key string")


def sensors(spark):
    return devices(spark, 1, 2).withColumn("category", F.when(F.col("lsid") == 1, "iss").otherwise("Attic"))


def test_points_and_keys(spark, folder):
    snaps = files.read_current_conditions(spark, snapshot_file(folder, SNAPSHOT))
    points = I.keyed_points(I.explode_points(snaps))
    assert rows(points, "lsid", "point_pos", "key") == [
        (1, 0, "1:1000"), (1, 1, "1:1000"), (1, 2, "1:0"), (1, 3, "1:0"), (2, 0, "2:1000"), (9, 0, "9:1")]


def test_shaping(spark, folder):
    snaps = files.read_current_conditions(spark, snapshot_file(folder, SNAPSHOT))
    out = with_header_columns(shape_snapshots(snaps, sensors(spark), keys(spark, "2:1000")))
    assert rows(out.select("topic", "key", "sensor_type", "data_structure_type", F.col("value").cast("string"))) == [
        ("weather.iss", "1:0", 43, 23, '{"ts":"1001"}'), ("weather.iss", "1:1000", 43, 23, '{"temp":62.3,"ts":1000}')]
    points = I.keyed_points(I.explode_points(snaps))
    assert I.ingest_counts(points, sensors(spark), keys(spark, "2:1000")).first() == (2, 3, 1)


def test_sensor_lookup_never_broadcasts_points(spark, folder):
    snaps = files.read_current_conditions(spark, snapshot_file(folder, SNAPSHOT))
    # More sensors than the points seem to have bytes, sensor 2 twice, sensor 9 unknown.
    many = spark.range(1, 100000).where("id <> 9").select(F.col("id").alias("lsid"), F.lit("ISS").alias("category"))
    sensors = many.union(spark.sql("SELECT * FROM VALUES (2L, 'Attic'), (NULL, 'Lost')"))
    found = I.with_sensor(I.keyed_points(I.explode_points(snaps)), sensors).select("lsid", "ts", "category")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildLeft" not in plan
    assert rows(found) == [
        (1, 0, "ISS"), (1, 0, "ISS"), (1, 1000, "ISS"), (1, 1000, "ISS"), (2, 1000, "Attic"), (2, 1000, "ISS")]


def test_topics(spark):
    df = spark.createDataFrame([("ISS",), ("barometer",), ("Inside Temp/Hum",), ("Health",), ("x",), (None,)], "c string")
    assert rows(df.select("c", I.topic_for_category(F.col("c")))) == sorted([
        ("ISS", "weather.iss"), ("barometer", "weather.barometer"), ("Inside Temp/Hum", "weather.indoor"),
        ("Health", "weather.health"), ("x", "weather.other"), (None, "weather.other")], key=repr)


CATALOG = {"generated_at": 7, "sensor_types": [
    {"sensor_type": 43, "category": "ISS", "data_structures": [{"data_structure_type": "3"}, {"data_structure_type": "12"}, {"data_structure_type": "x"}]},
    {"sensor_type": 44, "data_structures": [{"data_structure_type": "none"}]},
    {"sensor_type": 99, "data_structures": [{"data_structure_type": "1"}]}]}


def test_metadata_messages_share_one_key_space(spark, folder):
    cat = files.read_sensor_catalog(spark, snapshot_file(f"{folder}/c", CATALOG))
    meta = files.read_sensor_metadata(spark, snapshot_file(f"{folder}/s", {"sensors": [{"lsid": 1, "sensor_type": 43, "tx_id": None}, {"lsid": 2, "sensor_type": 44}], "generated_at": 7}))
    stations = files.read_stations(spark, snapshot_file(f"{folder}/t", {"stations": [{"station_id": 1, "station_name": "S"}], "generated_at": 7}))
    assert meta.count() == 2 and stations.first().station_name == "S"
    week = 1766966400
    now = F.lit(week + 3 * 86400)
    out = shape_metadata(meta, cat, stations, "1", keys(spark, f"2:{week}"), now)
    # Station 1 and sensor 1 have the same key; the sensors topic comes first.
    assert rows(out, "topic", "key") == [("weather.metadata.catalog", "43:12"), ("weather.metadata.sensors", f"1:{week}")]
    body = json.loads(out.where("topic like '%catalog'").first().value)
    assert body["sensor_type"] == 43 and "generated_at" not in body


def test_changed_payloads_ignore_generation_time(spark):
    docs = [(1, 10, '{"a":1,"generated_at":10}'), (1, 20, '{"generated_at":20,"a":1}'), (1, 100000, '{"a":2}'), (2, 20, '{"a":2}'), (1, 100001, '{"a":1}')]
    df = spark.createDataFrame(docs, "k int, t bigint, d string")
    assert rows(I.changed_payloads(df, ["k"], "t", "d", 50), "k", "t") == [(1, 10), (1, 100000), (1, 100001), (2, 20)]


def test_ingest_stream_dedups_across_restarts(spark, folder):
    inbox, out = f"{folder}/in", f"{folder}/out"

    def run():
        stream = files.stream_current_conditions(spark, inbox)
        ingest_stream(stream, sensors(spark), out, f"{folder}/ck").trigger(availableNow=True).start().awaitTermination()
        return rows(files.read_envelope_files(spark, out), "key")

    snapshot_file(inbox, SNAPSHOT, "a.json")
    assert run() == [("1:0",), ("1:1000",), ("2:1000",)]
    later = {"generated_at": 200, "sensors": [{"lsid": 1, "sensor_type": 43, "data_structure_type": 23, "data": [{"ts": 1000}, {"ts": 99999}]}]}
    snapshot_file(inbox, later, "b.json")
    assert run() == [("1:0",), ("1:1000",), ("1:99999",), ("2:1000",)]
