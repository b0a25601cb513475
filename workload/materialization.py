"""Envelope, materialization and record-table queries."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream import schemas
from hearthstream.functions import as_number, as_text, is_json_null, parse_json_value, value_kind
from hearthstream.operators import envelope as E
from hearthstream.operators import keyed as K
from hearthstream.operators import orphans as O
from hearthstream.operators import records as R
from hearthstream.plans.materialize import judge, materialize, points_of
from hearthstream.plans.materialize import replay_orphans as plans_replay_orphans
from hearthstream.plans.metadata import apply_catalog, learn_structure_types
from hearthstream.plans.replay import replay, replay_summary
from hearthstream.session import cut_lineage, scratch_dir
from hearthstream.sources import files
from hearthstream.sources.tables import Tables
from hearthstream.streaming.tables import BatchMetrics, materialize_stream
from workload import feeds
from workload.dimensions import catalog_payloads
from workload.registry import query
from workload.twins import NUMERIC_TEXT


def named(records: DataFrame, tags: DataFrame) -> DataFrame:
    """Records under their natural key (device, tag) instead of the serial tag id."""
    keys = tags.select(F.col("id").alias("tag_id"), F.col("device_id").alias("lsid"), "tag_name")
    return records.join(keys, "tag_id").drop("tag_id")


def _tables(spark, sf, label: str) -> Tables:
    tables = Tables(spark, scratch_dir(spark, label))
    tables.replace_dimension("devices", feeds.devices(spark, sf))
    tables.replace_dimension(
        "sensor_catalog", K.assign_ids(
            feeds.catalog(spark, sf).drop("id"),
            ["sensor_type", "data_structure_type", "field_name"],
            F.lit(0),
        )
    )
    return tables


# ---- sources ------------------------------------------------------------


@query("SRC4, SRC1", """
SELECT topic, CAST(part AS BIGINT) AS partition, count(*) AS messages, min(off) AS low,
  max(off) AS high, CAST(sum(hts) AS BIGINT) AS seconds
FROM m GROUP BY ALL""", "m")
def envelope_files(spark, sf):
    path = scratch_dir(spark, "envelope")
    feeds.messages(spark, sf).write.parquet(path)
    return (
        E.with_header_columns(files.read_envelope_files(spark, path))
        .groupBy("topic", F.col("partition").cast("bigint").alias("partition"))
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.min("offset").alias("low"),
            F.max("offset").alias("high"),
            F.sum("record_ts").alias("seconds"),
        )
    )


@query("SRC2", """
WITH t AS (SELECT DISTINCT CASE event_type WHEN 'click' THEN 'weather.click'
    WHEN 'view' THEN 'weather.metadata.view' WHEN 'purchase' THEN 'other.purchase'
    WHEN 'signup' THEN 'weather.' ELSE 'weather.metadata' END AS topic FROM events)
SELECT topic FROM t
WHERE length(topic) > 8 AND topic LIKE 'weather.%' AND topic NOT LIKE 'weather.metadata.%'""")
def data_topics(spark, sf):
    kind = F.col("event_type")
    topics = feeds.table(spark, sf, "events").select(
        F.when(kind == "click", "weather.click")
        .when(kind == "view", "weather.metadata.view")
        .when(kind == "purchase", "other.purchase")
        .when(kind == "signup", "weather.")
        .otherwise("weather.metadata")
        .alias("topic")
    )
    return topics.where(E.data_topics(F.col("topic"))).distinct()


def _half(spark, sf) -> int:
    """An offset in the middle of the messages."""
    return feeds.messages(spark, sf).agg(F.max("offset")).first()[0] // 2


@query("SRC3", """
SELECT topic, count(*) AS messages, min(off) AS low, max(off) AS high
FROM m WHERE off >= 100 AND off < (SELECT max(off) // 2 FROM m) GROUP BY topic""", "m")
def offset_range(spark, sf):
    return (
        E.offset_range(feeds.messages(spark, sf), 100, _half(spark, sf))
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.min("offset").alias("low"),
            F.max("offset").alias("high"),
        )
    )


@query("SRC11", "SELECT id, lsid, sensor_type, category, product_name FROM dev", "dev")
def load_devices(spark, sf):
    tables = Tables(spark, scratch_dir(spark, "devices"))
    stored = tables.replace_dimension("devices", feeds.devices(spark, sf))
    return stored.select(
        "id", "lsid", F.col("sensor_type").cast("bigint").alias("sensor_type"), "category",
        "product_name",
    )


@query("SRC12", "SELECT DISTINCT CAST(user_id AS VARCHAR) || ':' || CAST(hts AS VARCHAR) AS key FROM m", "m")
def published_keys(spark, sf):
    return files.distinct_keys(feeds.messages(spark, sf))


# ---- projections --------------------------------------------------------


@query("PRJ1", "SELECT off, lsid, hts AS record_ts, sensor_type, dst AS data_structure_type FROM m", "m")
def header_columns(spark, sf):
    return E.with_header_columns(feeds.messages(spark, sf)).select(
        F.col("offset").alias("off"), "lsid", "record_ts", "sensor_type", "data_structure_type"
    )


@query("PRJ2", """
SELECT off, CAST(lsid AS VARCHAR) AS lsid, '' AS absent FROM m""", "m")
def first_header(spark, sf):
    return feeds.messages(spark, sf).select(
        F.col("offset").alias("off"),
        E.header("lsid").alias("lsid"),
        E.header("camera_name").alias("absent"),
    )


@query("PRJ3", """
SELECT off, lsid = 0 AS rejected,
  CASE WHEN lsid = 0 THEN 'missing lsid in message headers' END AS reason FROM m""", "m")
def missing_lsid(spark, sf):
    return E.with_header_columns(feeds.messages(spark, sf)).select(
        F.col("offset").alias("off"),
        E.lsid_problem().isNotNull().alias("rejected"),
        E.lsid_problem().alias("reason"),
    )


@query("PRJ4", """
SELECT off, off % 4 = 0 OR off % 4 = 1 AS parse_error FROM m""", "m")
def parse_body(spark, sf):
    kind = F.col("offset") % 4
    body = F.col("value").cast("string")
    damaged = F.when(kind == 0, F.concat(body, F.lit(" tail"))).when(
        kind == 1, F.concat(F.lit("["), body, F.lit("]"))
    ).when(kind == 2, F.lit("null")).otherwise(body)
    messages = feeds.messages(spark, sf).withColumn("value", damaged.cast("binary"))
    return E.parse_body(messages).select(F.col("offset").alias("off"), "parse_error")


@query("PRJ5", "SELECT lsid, hts AS ts, off, field FROM pts", "pts")
def melt_fields(spark, sf):
    judged = judge(feeds.messages(spark, sf), feeds.devices(spark, sf))
    melted = E.melt_fields(judged.where("verdict = 'good'"))
    return melted.select("lsid", F.col("record_ts").alias("ts"), F.col("offset").alias("off"), "field")


@query("PRJ6, T5", "SELECT field, vkind AS kind, count(*) AS n FROM pts GROUP BY ALL", "pts")
def value_kinds(spark, sf):
    judged = judge(feeds.messages(spark, sf), feeds.devices(spark, sf))
    return points_of(judged).groupBy("field", F.col("value_kind").alias("kind")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("PRJ7", "SELECT field, rkind AS route, count(*) AS n FROM routed GROUP BY ALL", "routed")
def route_records(spark, sf):
    return (
        feeds.built(spark, sf)["routed"]
        .groupBy("field", F.col("kind").alias("route"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("PRJ7, T7, T8", """
SELECT lsid, field, off,
  CASE data_type WHEN 'numeric' THEN 'unsupported numeric type for value: ' || vkind
    WHEN 'text' THEN 'expected string value, got ' || vkind
    ELSE 'unknown data type: ' || data_type END AS reason
FROM routed WHERE rkind = 'rejected'""", "routed")
def rejected_values(spark, sf):
    return feeds.built(spark, sf)["rejected"].select(
        "lsid", "field", F.col("offset").alias("off"), "reason"
    )


# ---- joins of the path --------------------------------------------------


@query("JN1", """
SELECT off, m.lsid, id AS device_id FROM m LEFT JOIN dev USING (lsid)""", "dev")
def with_device(spark, sf):
    messages = E.with_header_columns(feeds.messages(spark, sf))
    return R.with_device(messages, feeds.devices(spark, sf)).select(
        F.col("offset").alias("off"), "lsid", "device_id"
    )


@query("JN2, T2", """
SELECT topic, off, lsid, hts AS record_ts, reason, tag_name FROM orph""", "orph")
def missing_device(spark, sf):
    usable, _ = E.split_missing_lsid(E.with_header_columns(feeds.messages(spark, sf)))
    unknown = R.missing_device(usable, feeds.devices(spark, sf))
    return R.as_orphans(unknown, F.lit(R.MISSING_DEVICE), feeds.now()).select(
        "topic", F.col("offset").alias("off"), "lsid", "record_ts", "reason", "tag_name"
    )


@query("JN3", """
SELECT lsid, field, data_type, count(*) AS points FROM routed GROUP BY ALL""", "routed")
def with_tag(spark, sf):
    judged = judge(feeds.messages(spark, sf), feeds.devices(spark, sf))
    tagged = R.with_tag(points_of(judged), feeds.built(spark, sf)["tags"])
    return tagged.groupBy("lsid", "field", "data_type").agg(F.count("tag_id").alias("points"))


@query("JN4, T11, T12", """
SELECT lsid, tag_name, unit, description FROM tags""", "tags")
def with_catalog(spark, sf):
    judged = judge(feeds.messages(spark, sf), feeds.devices(spark, sf))
    seen = R.first_seen_types(points_of(judged))
    return R.with_catalog(seen, feeds.catalog(spark, sf)).select(
        F.col("device_id").alias("lsid"), "tag_name", "unit", "description"
    )


@query("PRJ19, T13", """
SELECT lsid, tag_name, '{"data_structure_type":"' || structure || '","field_type":"' || field_type
  || '","sensor_type":' || CAST(catalog_type AS VARCHAR) || '}' AS metadata
FROM tags WHERE unit IS NOT NULL""", "tags")
def tag_metadata(spark, sf):
    tags = feeds.built(spark, sf)["tags"]
    return tags.where(F.col("metadata").isNotNull()).select(
        F.col("device_id").alias("lsid"), "tag_name", "metadata"
    )


# ---- typing, dedup, ids -------------------------------------------------


@query("AGG16, T31", "SELECT lsid, field AS tag_name, data_type FROM seen", "seen")
def first_seen_types(spark, sf):
    judged = judge(feeds.messages(spark, sf), feeds.devices(spark, sf))
    return R.first_seen_types(points_of(judged)).select(
        F.col("device_id").alias("lsid"), "tag_name", "data_type"
    )


@query("DED1, T10", """
SELECT lsid, field AS tag_name, rkind AS kind, hts AS ts, num AS num_value, txt AS text_value
FROM recd""", "recd")
def first_wins(spark, sf):
    tables = feeds.built(spark, sf, duplicated=True)
    return named(tables["records"], tables["tags"]).select(
        "lsid", "tag_name", "kind", "ts", "num_value", "text_value"
    )


@query("DED2", """
SELECT lsid, topic, off, value FROM md
QUALIFY row_number() OVER (PARTITION BY lsid ORDER BY ts DESC, topic DESC, part DESC, off DESC) = 1""", "md")
def last_wins(spark, sf):
    messages = E.with_header_columns(feeds.duplicated_messages(spark, sf))
    latest = K.last_wins(messages, ["lsid"], E.arrival_order(), keep=["topic", "offset", "value"])
    body = parse_json_value(F.col("value").cast("string"))
    return latest.select(
        "lsid", "topic", F.col("offset").alias("off"),
        F.try_variant_get(body, "$.value", "double").alias("value"),
    )


@query("WIN1", """
SELECT count(*) AS tags, count(*) AS distinct_ids, CAST(1 AS BIGINT) AS low, count(*) AS high FROM seen""", "seen")
def assign_ids(spark, sf):
    return feeds.built(spark, sf)["tags"].agg(
        F.count(F.lit(1)).alias("tags"),
        F.countDistinct("id").alias("distinct_ids"),
        F.min("id").alias("low"),
        F.max("id").alias("high"),
    )


# ---- record tables ------------------------------------------------------


@query("SET1, T6, PRJ7", """
SELECT lsid, field AS tag_name, num AS value, hts AS ts FROM rec WHERE rkind = 'numeric'""", "rec")
def records_numeric(spark, sf):
    tables = feeds.built(spark, sf)
    return named(R.records_numeric(tables["records"]), tables["tags"]).select(
        "lsid", "tag_name", "value", "ts"
    )


@query("SET1, PRJ7", """
SELECT lsid, field AS tag_name, txt AS value, hts AS ts FROM rec WHERE rkind = 'text'""", "rec")
def records_text(spark, sf):
    tables = feeds.built(spark, sf)
    return named(R.records_text(tables["records"]), tables["tags"]).select(
        "lsid", "tag_name", "value", "ts"
    )


@query("SET1, T6", """
SELECT lsid, field AS tag_name, hts AS ts FROM rec WHERE rkind = 'null'""", "rec")
def records_null(spark, sf):
    tables = feeds.built(spark, sf)
    return named(R.records_null(tables["records"]), tables["tags"]).select("lsid", "tag_name", "ts")


@query("SET1, FN1, T9", f"""
SELECT lsid, field AS tag_name, hts AS ts, rkind AS value_type,
  CASE rkind WHEN 'numeric' THEN {NUMERIC_TEXT} WHEN 'text' THEN txt END AS value
FROM rec""", "rec")
def records_view(spark, sf):
    tables = feeds.built(spark, sf)
    return named(R.records_view(tables["records"]), tables["tags"]).select(
        "lsid", "tag_name", "ts", "value_type", "value"
    )


@query("SET1", """
SELECT rkind AS kind, count(*) AS n, CAST(min(hts) AS BIGINT) AS low, CAST(max(hts) AS BIGINT) AS high
FROM rec GROUP BY rkind""", "rec")
def union_records(spark, sf):
    records = feeds.built(spark, sf)["records"]
    together = R.union_records(
        R.records_numeric(records), R.records_text(records), R.records_null(records)
    )
    return together.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("low"), F.max("ts").alias("high")
    )


# ---- sinks --------------------------------------------------------------

_RECORD_DAYS = """
SELECT rkind AS kind, hts // 86400 AS day, count(*) AS records, count(DISTINCT lsid) AS devices
FROM {r} GROUP BY ALL"""


def _record_days(tables: Tables) -> DataFrame:
    return named(tables.records(), tables.dimension("tags")).groupBy(
        "kind", F.unix_date("dt").cast("bigint").alias("day")
    ).agg(F.count(F.lit(1)).alias("records"), F.countDistinct("lsid").alias("devices"))


@query("SNK1, SNK5, SNK6, JN1, AGG16", _RECORD_DAYS.format(r="recd"), "recd")
def materialize_batch(spark, sf):
    tables = _tables(spark, sf, "materialize")
    materialize(feeds.duplicated_messages(spark, sf), tables, now=feeds.now())
    return _record_days(tables)


@query("SNK1, SNK2", _RECORD_DAYS.format(r="rec"), "rec")
def append_records_twice(spark, sf):
    tables = _tables(spark, sf, "append")
    source = feeds.messages(spark, sf)
    materialize(source, tables, now=feeds.now())
    # The second run finds everything stored and must add nothing.
    materialize(source, tables, now=feeds.now())
    return _record_days(tables)


@query("STR1, STR7, T30", _RECORD_DAYS.format(r="recd"), "recd")
def materialize_streamed(spark, sf):
    tables = _tables(spark, sf, "stream")
    inbox = scratch_dir(spark, "inbox")
    # All files are one micro-batch, in which the arrival decides whatever file a message is in.
    feeds.duplicated_messages(spark, sf).write.parquet(inbox)
    stream = files.read_envelope_files(spark, inbox, stream=True)
    run = materialize_stream(stream, tables, scratch_dir(spark, "offsets"))
    run.trigger(availableNow=True).start().awaitTermination()
    return _record_days(tables)


@query("STR4, AGG11", """
SELECT metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 'processed' AS metric, count(*) AS value FROM known WHERE off < (SELECT max(off) // 2 FROM m)
  UNION ALL SELECT 'errors', count(*) FROM m WHERE off < (SELECT max(off) // 2 FROM m) AND lsid NOT IN (SELECT lsid FROM dev)
  UNION ALL SELECT 'numeric', count(*) FROM rec5 WHERE rkind = 'numeric'
  UNION ALL SELECT 'text', count(*) FROM rec5 WHERE rkind = 'text'
  UNION ALL SELECT 'null', count(*) FROM rec5 WHERE rkind = 'null'
  UNION ALL SELECT 'orphaned', count(*) FROM orph WHERE off < (SELECT max(off) // 2 FROM m))""".replace("rec5", """(
    SELECT p.*, CASE WHEN p.vkind = 'null' THEN 'null'
      WHEN s.data_type = 'numeric' AND p.vkind = 'number' THEN 'numeric'
      WHEN s.data_type = 'text' AND p.vkind = 'string' THEN 'text' END AS rkind
    FROM pts p JOIN (
      SELECT lsid, field, CASE WHEN vkind IN ('number', 'boolean') THEN 'numeric'
        WHEN vkind = 'null' THEN 'null' ELSE 'text' END AS data_type
      FROM pts WHERE off < (SELECT max(off) // 2 FROM m)
      QUALIFY row_number() OVER (PARTITION BY lsid, field ORDER BY ts, topic, part, off) = 1
    ) s USING (lsid, field) WHERE p.off < (SELECT max(off) // 2 FROM m)
    QUALIFY row_number() OVER (PARTITION BY lsid, field, hts, rkind ORDER BY ts, topic, part, off) = 1)"""),
       "pts", "orph")
def replay_range(spark, sf):
    tables = _tables(spark, sf, "replay")
    topics = [f"events.{t}" for t in ("click", "view", "purchase", "signup", "error")]
    done = replay(
        feeds.messages(spark, sf), tables, topics, 0, _half(spark, sf), partition=None, now=feeds.now()
    )
    return replay_summary(done, tables)


@query("STR4, AGG11, SNK6", """
SELECT 'processed' AS metric, count(*) AS value FROM known
UNION ALL SELECT 'errors', count(*) FROM m WHERE lsid NOT IN (SELECT lsid FROM dev)
UNION ALL SELECT rkind, count(*) FROM rec GROUP BY rkind
UNION ALL SELECT 'orphaned', count(*) FROM orph""", "known", "rec", "orph")
def replay_all_partitions(spark, sf):
    tables = _tables(spark, sf, "replay-all")
    # The five record topics, in the order of the event topics.
    topics = dict(zip(
        ("click", "error", "purchase", "signup", "view"),
        ("barometer", "health", "indoor", "iss", "other"), strict=True,
    ))
    names = F.create_map(*[F.lit(x) for k, v in topics.items() for x in (f"events.{k}", f"weather.{v}")])
    messages = feeds.messages(spark, sf).withColumn("topic", names[F.col("topic")])
    return replay_summary(replay(messages, tables, now=feeds.now()), tables)


@query("STR7, SRC4", "SELECT topic, count(*) AS messages FROM m GROUP BY topic", "m")
def late_files_streamed(spark, sf):
    inbox, seen, offsets = (scratch_dir(spark, x) for x in ("inbox", "seen", "offsets"))
    messages = feeds.messages(spark, sf)

    def arrive(part: DataFrame, days_ago: int) -> None:
        part.write.mode("append").parquet(inbox)
        folder = spark._jvm.org.apache.hadoop.fs.Path(inbox)
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for f in fs.listStatus(folder):
            if f.getPath().getName() not in known:
                known[f.getPath().getName()] = True
                fs.setTimes(f.getPath(), f.getModificationTime() - days_ago * 86_400_000, -1)
        stream = files.read_envelope_files(spark, inbox, stream=True)
        run = stream.writeStream.format("parquet").option("path", seen)
        run.option("checkpointLocation", offsets).trigger(availableNow=True).start().awaitTermination()

    known: dict[str, bool] = {}
    arrive(messages.where("offset % 2 = 0"), 0)
    arrive(messages.where("offset % 2 = 1"), 30)
    return spark.read.parquet(seen).groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


@query("SNK3, SNK4, SNK5, STR1, STR2, STR3", """
SELECT lsid AS device_id, field AS tag_name, data_type, CAST(1 AS BIGINT) AS tags_of_id FROM seen""", "seen")
def concurrent_dimensions(spark, sf):
    """Records, device types and catalog written at once: no tag is lost and no id given twice."""
    tables = _tables(spark, sf, "concurrent")
    messages = feeds.messages(spark, sf)
    middle = messages.agg(F.expr("percentile_approx(unix_micros(timestamp), 0.5)")).first()[0]
    micros = F.unix_micros("timestamp")

    def records() -> None:
        for part in (messages.where(micros <= middle), messages.where(micros > middle)):
            materialize(part, tables, now=feeds.now())

    def fields() -> None:
        for _ in range(2):
            apply_catalog(catalog_payloads(spark, sf), tables, now=feeds.now())

    def things() -> None:
        for _ in range(2):
            learn_structure_types(E.with_header_columns(messages), tables)

    with ThreadPoolExecutor(3) as pool:
        for done in [pool.submit(f) for f in (records, fields, things)]:
            done.result()
    tags = tables.dimension("tags")
    shared = tags.groupBy("id").agg(F.count(F.lit(1)).alias("tags_of_id"))
    return tags.join(shared, "id").select("device_id", "tag_name", "data_type", "tags_of_id")


@query("AGG9, WIN2", """
SELECT metric, CAST(sum(n) AS BIGINT) AS total FROM (
  SELECT 'processed' AS metric, count(*) AS n FROM m WHERE lsid <> 0
  UNION ALL SELECT 'errors', count(*) FROM m WHERE lsid = 0
  UNION ALL SELECT rkind, count(*) FROM rec GROUP BY rkind) GROUP BY metric""", "rec")
def materialize_metrics(spark, sf):
    tables = _tables(spark, sf, "metrics")
    inbox = scratch_dir(spark, "inbox")
    feeds.messages(spark, sf).write.parquet(inbox)
    metrics = BatchMetrics(tables, scratch_dir(spark, "counters"))
    stream = files.read_envelope_files(spark, inbox, stream=True)
    run = materialize_stream(stream, tables, scratch_dir(spark, "offsets"), on_batch=metrics)
    run.trigger(availableNow=True).start().awaitTermination()
    return metrics.read().groupBy("metric").agg(F.sum("n").alias("total"))


@query("SNK10, SET2", """
SELECT table_name, CAST(before AS BIGINT) AS before, CAST(0 AS BIGINT) AS after FROM (
  SELECT 'devices' AS table_name, (SELECT count(*) FROM dev) AS before
  UNION ALL SELECT 'tags', (SELECT count(*) FROM seen) UNION ALL SELECT 'sensor_catalog', (SELECT count(*) FROM cat)
  UNION ALL SELECT 'records_' || k, (SELECT count(*) FROM rec WHERE rkind = k)
  FROM (VALUES ('numeric'), ('text'), ('null')) v(k))""", "rec", "cat")
def truncate_data(spark, sf):
    tables = _tables(spark, sf, "truncate")
    materialize(feeds.messages(spark, sf), tables, now=feeds.now())
    before = tables.counts().withColumnRenamed("count", "before")
    before = cut_lineage(before)
    tables.truncate()
    return before.join(tables.counts().withColumnRenamed("count", "after"), "table_name")


@query("SNK7", """
SELECT topic, count(*) AS messages, count(DISTINCT key) AS keys, CAST(sum(lsid) AS BIGINT) AS lsids FROM (
  SELECT *, CAST(user_id AS VARCHAR) || ':' || CAST(hts AS VARCHAR) AS key FROM m) GROUP BY topic""", "m")
def publish_messages(spark, sf):
    path = scratch_dir(spark, "published")
    files.publish_to_files(feeds.messages(spark, sf), path, feeds.now())
    return (
        E.with_header_columns(files.read_envelope_files(spark, path))
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.countDistinct("key").alias("keys"),
            F.sum("lsid").alias("lsids"),
        )
    )


# ---- orphans ------------------------------------------------------------


@query("SNK6, T18", """
SELECT topic, part AS partition, off, lsid, reason, off % 2 = 0 AS reprocessed FROM orph""", "orph")
def save_orphans(spark, sf):
    rows = feeds.built(spark, sf)["orphans"]
    # The old rows: half of them reprocessed, all with an outdated reason.
    old = rows.withColumn("reason", F.lit("old")).withColumn("reprocessed", F.col("offset") % 2 == 0)
    return O.save_orphans(old, rows).select(
        "topic", F.col("partition").cast("bigint").alias("partition"),
        F.col("offset").alias("off"), "lsid", "reason", "reprocessed",
    )


@query("AGG5, PRJ45, TOP2", """
SELECT topic, lsid, tag_name, reason, count(*) AS count FROM orph GROUP BY ALL""", "orph")
def orphan_summary(spark, sf):
    return O.orphan_summary(feeds.built(spark, sf)["orphans"])


@query("AGG6", "SELECT reason, count(*) AS count FROM orph GROUP BY reason", "orph")
def orphan_reasons(spark, sf):
    return O.orphan_reasons(feeds.built(spark, sf)["orphans"])


@query("TOP3", """
SELECT topic, part AS partition, off FROM orph ORDER BY topic, part, off DESC LIMIT 10""", "orph")
def latest_orphans(spark, sf):
    return O.latest_orphans(feeds.built(spark, sf)["orphans"]).select(
        "topic", F.col("partition").cast("bigint").alias("partition"), F.col("offset").alias("off")
    )


@query("PRJ45", """
SELECT off, reason FROM orph WHERE off % 3 <> 0""", "orph")
def pending_orphans(spark, sf):
    orphans = feeds.built(spark, sf)["orphans"].withColumn(
        "reprocessed", F.col("offset") % 3 == 0
    )
    return O.pending_orphans(orphans).select(F.col("offset").alias("off"), "reason")


@query("JN19, T19", """
SELECT topic, off, lsid, lsid % 2 = 0 AND off % 10 <> 0 AS reprocessed FROM orph""", "orph")
def replay_orphans(spark, sf):
    orphans = feeds.built(spark, sf)["orphans"]
    # By now the unknown devices with even numbers have appeared; every tenth of
    # their bodies cannot be read.
    broken = (F.col("lsid") % 2 == 0) & (F.col("offset") % 10 == 0)
    tables = Tables(spark, scratch_dir(spark, "orphans"))
    appeared = orphans.where("lsid % 2 = 0").select("lsid").distinct()
    tables.replace_dimension(
        "devices",
        schemas.empty(spark, schemas.DEVICES_DDL).unionByName(
            appeared.select(F.col("lsid").alias("id"), "lsid"), allowMissingColumns=True
        ),
    )
    tables.append_orphans(
        orphans.withColumn("message_body", F.when(broken, "{broken").otherwise(F.col("message_body")))
    )
    plans_replay_orphans(tables, feeds.now())
    return tables.orphans(["lsid"]).select(
        "topic", F.col("offset").alias("off"), "lsid", "reprocessed"
    )


@query("JN19", """
SELECT lsid, hts AS ts, count(*) AS fields FROM (
  SELECT lsid, hts, unnest(['value', 'kind', 'k', 'flag', 'note']) AS field FROM m
  WHERE lsid <> 0 AND lsid NOT IN (SELECT lsid FROM dev)) GROUP BY ALL""", "dev")
def orphans_as_messages(spark, sf):
    messages = O.as_messages(feeds.built(spark, sf)["orphans"])
    melted = E.melt_fields(E.parse_body(E.with_header_columns(messages)))
    return melted.groupBy("lsid", F.col("record_ts").alias("ts")).agg(
        F.count(F.lit(1)).alias("fields")
    )


@query("FN11, T6", """
SELECT off, CAST(k AS DOUBLE) AS k, event_type AS kind,
  off % 5 = 0 AS note_is_null, CASE WHEN off % 5 = 0 THEN 'null' ELSE 'string' END AS note_kind
FROM m""", "m")
def json_access(spark, sf):
    body = E.parse_body(feeds.messages(spark, sf))
    note = F.try_variant_get("body", "$.note", "variant")
    return body.select(
        F.col("offset").alias("off"),
        as_number(F.try_variant_get("body", "$.k", "variant")).alias("k"),
        as_text(F.try_variant_get("body", "$.kind", "variant")).alias("kind"),
        is_json_null(note).alias("note_is_null"),
        value_kind(note).alias("note_kind"),
    )


@query("DED1, SNK1", """
SELECT lsid, hts, count(*) AS fields FROM pts GROUP BY ALL""", "pts")
def points_per_message_second(spark, sf):
    judged = judge(feeds.messages(spark, sf), feeds.devices(spark, sf))
    return points_of(judged).groupBy("lsid", F.col("ts").alias("hts")).agg(
        F.count(F.lit(1)).alias("fields")
    )


_BENCH_FIELDS = {
    "l_quantity": "num", "l_extendedprice": "num", "l_discount": "num", "l_tax": "num",
    "l_returnflag": "txt", "l_linestatus": "txt",
}


def _bench_union() -> str:
    return " UNION ALL ".join(
        f"SELECT l_suppkey AS lsid, '{f}' AS tag_name, epoch_us(l_shipdate) // 1000000 AS ts,"
        f" l_orderkey * 8 + l_linenumber AS pos,"
        f" {f if kind == 'num' else 'NULL::DOUBLE'} AS num_value,"
        f" {f if kind == 'txt' else 'NULL::VARCHAR'} AS text_value FROM lineitem"
        # Number 0 is no device.
        " WHERE l_suppkey <> 0"
        for f, kind in _BENCH_FIELDS.items()
    )


def bench_records(spark, sf) -> dict[str, DataFrame]:
    from hearthstream.plans.materialize import batch_tables

    return batch_tables(
        feeds.bench_messages(spark, sf),
        feeds.bench_devices(spark, sf),
        schemas.empty(spark, schemas.TAGS_DDL),
        schemas.empty(spark, schemas.CATALOG_DDL),
        now=feeds.now(),
    )


@query("DED1, PRJ5, PRJ7", f"""
SELECT lsid, tag_name, ts, num_value, text_value FROM ({_bench_union()})
QUALIFY row_number() OVER (PARTITION BY lsid, tag_name, ts ORDER BY pos) = 1""")
def lineitem_records(spark, sf):
    tables = bench_records(spark, sf)
    return named(tables["records"], tables["tags"]).select(
        "lsid", "tag_name", "ts", "num_value", "text_value"
    )
