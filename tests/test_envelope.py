from pyspark.sql import functions as F

from hearthstream.operators import envelope as E
from hearthstream.sources import files, kafka
from helpers import message, messages, record, rows


def test_header_integers(spark):
    df = E.with_header_columns(messages(
        spark,
        message(1, "{}", [("lsid", "5"), ("lsid", "7"), ("timestamp", "100")]),
        message(2, "{}", {"lsid": "abc"}),
        message(3, "{}", None),
    ))
    assert rows(df, "offset", "lsid", "record_ts", "sensor_type") == [(1, 7, 100, 0), (2, 0, 0, 0), (3, 0, 0, 0)]


def test_missing_lsid_is_rejected(spark):
    usable, rejected = E.split_missing_lsid(E.with_header_columns(messages(
        spark, record(1, "{}"), message(2, "{}", {"lsid": "x"}))))
    assert rows(usable, "offset") == [(1,)]
    assert rows(rejected, "offset", "reason") == [(2, "missing lsid in message headers")]


def test_first_header_of_a_name(spark):
    df = messages(spark, message(1, "{}", [("a", "1"), ("a", "2")]))
    assert rows(df.select(E.header("a"), E.last_header("a"), E.header("b"), E.last_header("b"))) == [("1", "2", "", None)]


def test_bodies(spark):
    bodies = ['{"a":1}', "null", "[]", '"x"', "{bad", '{"a":1} tail', "", ' {"a":2}']
    parsed = E.parse_body(messages(spark, *[record(i, b) for i, b in enumerate(bodies)]))
    assert [r[0] for r in parsed.orderBy("offset").select("parse_error").collect()] == [
        False, False, True, True, True, True, True, False]


def test_melt_skips_ts_and_keeps_nulls(spark):
    df = E.melt_fields(E.parse_body(messages(spark, record(1, {"ts": 9, "a": 1, "b": None}), record(2, "null"))))
    assert rows(df.select("offset", "field", F.to_json("field_value"))) == [(1, "a", "1"), (1, "b", "null")]


def test_offset_ranges(spark):
    df = messages(spark, *[record(i, "{}") for i in range(10)])
    size = lambda s, e: E.offset_range(df, s, e).count()
    assert (size(-2, -1), size(0, -1), size(-1, -1), size(3, 7), size(-2, 0), size(0, 4)) == (10, 10, 0, 4, 0, 4)


def test_data_topics(spark):
    topics = ["weather.iss", "weather.", "weather.metadata.sensors", "weather.metadata", "other.weather.x"]
    df = spark.createDataFrame([(t,) for t in topics], "t string")
    assert rows(df.where(E.data_topics(F.col("t")))) == [("weather.iss",), ("weather.metadata",)]


def test_kafka_options():
    assert kafka.source_options("b:1", ["x", "y"]) == {
        "kafka.bootstrap.servers": "b:1", "includeHeaders": "true", "subscribe": "x,y"}
    assert kafka.source_options("b:1")["subscribePattern"] == E.DATA_TOPIC_PATTERN
    assert kafka.offset_options(["x", "y", "z"], 3, 9, {"x": [1, 0, 2], "y": [0], "z": []}) == {
        "assign": '{"x": [0, 1, 2], "y": [0]}',
        "startingOffsets": '{"x": {"0": 3, "1": 3, "2": 3}, "y": {"0": 3}}',
        "endingOffsets": '{"x": {"0": 9, "1": 9, "2": 9}, "y": {"0": 9}}'}
    bounded = kafka.offset_options(["x"], 0, 9, [0])
    assert bounded == {
        "assign": '{"x": [0]}', "startingOffsets": '{"x": {"0": -2}}', "endingOffsets": '{"x": {"0": 9}}'}
    assert kafka.offset_options(["x"], -1, -1, [0])["endingOffsets"] == '{"x": {"0": -1}}'
    assert kafka.PRODUCER_OPTIONS["kafka.compression.type"] == "lz4"
    assert kafka.PRODUCER_OPTIONS["kafka.acks"] == "all"


def test_offset_range_looks_up_partitions_once(spark):
    asked = []

    def resolve(_, broker, topics):
        asked.append((broker, topics))
        return {t: [] for t in topics}

    # Topics that the broker does not know: nothing to read, and no Kafka package needed.
    got = kafka.read_offset_range(spark, "b:1", ["x", "y"], 3, 9, resolve=resolve)
    assert got.columns == [c.split()[0] for c in ("topic", "partition", "offset", "key", "headers", "value", "timestamp")]
    assert got.isEmpty() and asked == [("b:1", ["x", "y"])]


def test_envelope_files_round_trip(spark, folder):
    df = messages(spark, record(1, {"a": 1}, key="1:1000"), record(2, {"a": 2}, key=""))
    df.write.parquet(f"{folder}/p")
    back = files.read_envelope_files(spark, f"{folder}/p")
    assert rows(back, "offset", "key") == rows(df, "offset", "key")
    assert rows(files.distinct_keys(back)) == [("1:1000",)]


def test_published_messages_can_be_read_back(spark, folder):
    df = spark.createDataFrame([(1, 5), (2, 6)], "lsid int, ts int")
    out = E.to_messages(
        df, F.lit("weather.iss"), F.concat_ws(":", "lsid", "ts"), F.to_json(F.struct("ts")),
        E.record_headers(F.col("lsid"), F.col("ts"), F.lit(3), F.lit(4)))
    files.publish_to_files(out, f"{folder}/p")
    back = E.with_header_columns(files.read_envelope_files(spark, f"{folder}/p"))
    assert rows(back, "key", "lsid", "record_ts", "sensor_type", "data_structure_type") == [
        ("1:5", 1, 5, 3, 4), ("2:6", 2, 6, 3, 4)]
    assert back.select("offset").distinct().count() == 2
