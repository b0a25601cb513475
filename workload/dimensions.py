"""Device, tag, catalog and station queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream.operators import dimensions as D
from hearthstream.operators.envelope import with_header_columns
from hearthstream.plans.metadata import apply_metadata
from hearthstream.session import cut_lineage, scratch_dir
from hearthstream.sources import files
from hearthstream.sources.tables import Tables
from hearthstream.streaming.tables import catalog_stream, metadata_stream
from workload import feeds
from workload.registry import query


def as_envelope(df: DataFrame, topic: str, offset, body) -> DataFrame:
    """Rows as metadata messages: arrival follows the offset."""
    return df.select(
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.cast("bigint").alias("offset"),
        F.lit(None).cast("string").alias("key"),
        F.array().cast("array<struct<key:string,value:binary>>").alias("headers"),
        body.cast("binary").alias("value"),
        F.timestamp_seconds(offset).alias("timestamp"),
    )


def metadata_messages(spark, sf) -> DataFrame:
    """A device message per event; every 20th event a station, unreadable or odd one."""
    ev = feeds.events(spark, sf)
    event, user = F.col("event_id"), F.col("user_id")
    device = F.to_json(
        F.struct(
            user.alias("lsid"),
            F.col("sensor_type"),
            feeds.category(user).alias("category"),
            F.col("event_type").alias("product_name"),
            F.when(event % 3 != 0, event % 3).otherwise(0).alias("tx_id"),
            (event % 2 == 0).alias("active"),
            F.when(event % 4 != 0, F.concat(F.lit("u"), user.cast("string")))
            .otherwise("")
            .alias("station_id_uuid"),
            F.col("value").alias("latitude"),
        )
    )
    station = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    (user % 3).cast("int").alias("station_id"),
                    F.concat(F.lit("station "), event.cast("string")).alias("station_name"),
                )
            ).alias("stations")
        )
    )
    body = (
        F.when(event % 20 == 1, station)
        .when(event % 20 == 2, "{broken")
        .when(event % 20 == 3, '{"lsid":"text"}')
        .otherwise(device)
    )
    return as_envelope(ev, "weather.metadata.sensors", event, body)


_DEVICE_ROWS = """
SELECT event_id AS off, user_id AS lsid, sensor_type,
  CASE user_id % 5 WHEN 0 THEN 'ISS' WHEN 1 THEN 'Barometer' WHEN 2 THEN 'Inside Temp/Hum'
    WHEN 3 THEN 'HEALTH' ELSE 'Other' END AS category,
  event_type AS product_name, '' AS manufacturer, nullif(event_id % 3, 0) AS tx_id,
  event_id % 2 = 0 AS active,
  CASE WHEN event_id % 4 <> 0 THEN 'u' || CAST(user_id AS VARCHAR) END AS station_id_uuid,
  nullif(value, 0) AS latitude
FROM m WHERE event_id % 20 NOT IN (1, 2, 3)"""


@query("PRJ16", """
SELECT CASE event_id % 20 WHEN 1 THEN 'station' WHEN 2 THEN 'failed to parse metadata: not a JSON object'
  WHEN 3 THEN 'missing or invalid lsid in metadata' ELSE 'device' END AS class, count(*) AS messages
FROM events GROUP BY class""")
def split_metadata(spark, sf):
    classified = D.classify_metadata(metadata_messages(spark, sf))
    shown = F.coalesce("reason", "class").alias("class")
    return classified.groupBy(shown).agg(F.count(F.lit(1)).alias("messages"))


_DEVICE_COLUMNS = [
    "lsid", "category", "product_name", "manufacturer", "active", "station_id_uuid",
]


def _device_view(df: DataFrame, *extra) -> DataFrame:
    return df.select(
        *extra,
        *_DEVICE_COLUMNS,
        F.col("sensor_type").cast("bigint").alias("sensor_type"),
        F.col("tx_id").cast("bigint").alias("tx_id"),
        F.col("latitude").cast("double").alias("latitude"),
    )


@query("PRJ17, FN9, T16", _DEVICE_ROWS, "m")
def device_rows(spark, sf):
    rows = D.device_rows(D.split_metadata(metadata_messages(spark, sf)).devices)
    return _device_view(rows, F.col("offset").alias("off"))


@query("PRJ18", f"""
SELECT lsid, sensor_type, category, manufacturer, product_name, count(*) AS n
FROM ({_DEVICE_ROWS}) GROUP BY ALL""", "m")
def device_brief(spark, sf):
    rows = D.device_rows(D.split_metadata(metadata_messages(spark, sf)).devices)
    brief = D.device_brief(rows).withColumn("sensor_type", F.col("sensor_type").cast("bigint"))
    return brief.groupBy(*brief.columns).agg(F.count(F.lit(1)).alias("n"))


_UPSERTED = f"""
SELECT * EXCLUDE (off) FROM ({_DEVICE_ROWS})
QUALIFY row_number() OVER (PARTITION BY lsid ORDER BY off DESC) = 1"""


@query("SNK3, DED2, T16", f"""
SELECT u.*, CAST(CASE WHEN d.lsid IS NOT NULL AND u.lsid % 2 = 0 THEN 1 END AS BIGINT) AS rt, d.lsid IS NOT NULL AS existed
FROM ({_UPSERTED}) u LEFT JOIN dev d USING (lsid)""", "dev")
def upsert_devices(spark, sf):
    old = feeds.devices(spark, sf)
    messages = D.split_metadata(metadata_messages(spark, sf)).devices
    merged = D.upsert_devices(old, cut_lineage(D.latest_devices(messages)), feeds.now())
    return _device_view(
        merged,
        F.col("rt_data_structure_type").cast("bigint").alias("rt"),
        (F.col("created_at") < feeds.now()).alias("existed"),
    )


def _metadata_twin() -> str:
    """Devices after three batches: each upserts its devices, then its stations claim theirs."""
    parts = [
        "span AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM m)",
        f"r AS (SELECT *, (off - lo) * 3 // (hi - lo + 1) AS g FROM ({_DEVICE_ROWS}), span)",
        "s AS (SELECT event_id AS off, user_id % 3 AS sid, 'station ' || CAST(event_id AS VARCHAR) AS name, "
        "(event_id - lo) * 3 // (hi - lo + 1) AS g FROM m, span WHERE event_id % 20 = 1)",
    ]
    for g in range(3):
        before = f"UNION ALL SELECT * FROM b{g - 1} WHERE lsid NOT IN (SELECT lsid FROM u{g})" if g else ""
        parts += [
            f"u{g} AS (SELECT * EXCLUDE (off, g, lo, hi) FROM r WHERE g = {g} "
            "QUALIFY row_number() OVER (PARTITION BY lsid ORDER BY off DESC) = 1)",
            f"a{g} AS (SELECT *, CAST(NULL AS BIGINT) AS station_id, CAST(NULL AS VARCHAR) AS station_name FROM u{g} {before})",
            f"b{g} AS (SELECT a.* REPLACE (CASE WHEN l.sid IS NULL THEN station_id_uuid END AS station_id_uuid, "
            "coalesce(l.sid, station_id) AS station_id, coalesce(l.name, station_name) AS station_name) "
            f"FROM a{g} a LEFT JOIN (SELECT sid, arg_max(name, off) AS name FROM s WHERE g = {g} GROUP BY sid) l "
            f"ON coalesce(a.station_id, (SELECT arg_min(sid, off) FROM s WHERE g = {g})) = l.sid)",
        ]
    return f"WITH {', '.join(parts)}\nSELECT * FROM b2"


def _metadata_run(spark, sf) -> Tables:
    """All metadata messages through the stream in three groups, with a restart after each."""
    tables = Tables(spark, scratch_dir(spark, "metadata"))
    messages = metadata_messages(spark, sf)
    span = messages.agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).first()
    group = F.floor((F.col("offset") - span.lo) * 3 / (span.hi - span.lo + 1))
    inbox, offsets = scratch_dir(spark, "inbox"), scratch_dir(spark, "offsets")
    for g in range(3):
        messages.where(group == g).write.mode("append").parquet(inbox)
        stream = files.read_envelope_files(spark, inbox, stream=True)
        run = metadata_stream(stream, tables, offsets)
        run.trigger(availableNow=True).start().awaitTermination()
    return tables


@query("STR2, SNK3, JN15", _metadata_twin(), "m")
def metadata_streamed(spark, sf):
    return _device_view(
        _metadata_run(spark, sf).dimension("devices"),
        F.col("station_id").cast("bigint").alias("station_id"),
        F.nullif("station_name", F.lit("")).alias("station_name"),
    )


@query("STR2, SNK6", """
SELECT CASE event_id % 20 WHEN 2 THEN 'failed to parse metadata: not a JSON object'
  ELSE 'missing or invalid lsid in metadata' END AS reason, event_id AS off
FROM events WHERE event_id % 20 IN (2, 3)""")
def metadata_dead_letters(spark, sf):
    return _metadata_run(spark, sf).orphans(["reason"]).select("reason", F.col("offset").alias("off"))


# ---- stations -----------------------------------------------------------


def _stations(spark, sf) -> DataFrame:
    return D.station_updates(D.split_metadata(metadata_messages(spark, sf)).stations)


@query("JN15, T17", """
WITH st AS (SELECT event_id, user_id % 3 AS sid, 'station ' || CAST(event_id AS VARCHAR) AS name
  FROM m WHERE event_id % 20 = 1),
first AS (SELECT arg_min(sid, event_id) AS sid FROM st),
last AS (SELECT sid, arg_max(name, event_id) AS name FROM st GROUP BY sid)
SELECT d.lsid, l.sid AS station_id, l.name AS station_name
FROM (SELECT lsid, coalesce(station_id, (SELECT sid FROM first)) AS sid FROM dev) d JOIN last l ON d.sid = l.sid
""", "dev")
def station_update(spark, sf):
    updated = D.update_station_info(feeds.devices(spark, sf), _stations(spark, sf), feeds.now())
    return updated.where(F.col("updated_at") == feeds.now()).select(
        "lsid", F.col("station_id").cast("bigint").alias("station_id"), "station_name"
    )


@query("AGG21", """
WITH st AS (SELECT event_id, user_id % 3 AS sid FROM m WHERE event_id % 20 = 1),
first AS (SELECT arg_min(sid, event_id) AS sid FROM st),
d AS (SELECT lsid, coalesce(station_id, (SELECT sid FROM first)) AS sid FROM dev)
SELECT event_id AS off, sid AS station_id, (SELECT count(*) FROM d WHERE d.sid = st.sid) AS updated
FROM st""", "dev")
def station_update_counts(spark, sf):
    counts = D.station_update_counts(feeds.devices(spark, sf), _stations(spark, sf))
    return counts.select(
        F.col("offset").alias("off"),
        F.col("station_id").cast("bigint").alias("station_id"),
        "updated",
    )


@query("JN22, T15", """
SELECT d.lsid, coalesce(s.dst, d.rt) AS rt FROM dev d LEFT JOIN (
  SELECT lsid, arg_max(CASE WHEN value >= 25 THEN dst END, ROW(ts, topic, part, off)) AS dst
  FROM m WHERE value >= 25 GROUP BY lsid) s USING (lsid)""", "dev")
def set_rt_type(spark, sf):
    messages = with_header_columns(feeds.messages(spark, sf))
    value = F.get_json_object(F.col("value").cast("string"), "$.value").cast("double")
    # Cheap events carry no structure type.
    marked = messages.withColumn(
        "data_structure_type", F.when(value >= 25, F.col("data_structure_type")).otherwise(0)
    )
    return D.set_rt_type(feeds.devices(spark, sf), marked).select(
        "lsid", F.col("rt_data_structure_type").cast("bigint").alias("rt")
    )


# ---- catalog ------------------------------------------------------------


def catalog_payloads(spark, sf) -> DataFrame:
    """Catalog messages per event, wrapped or single, some of the wrong shape."""
    ev = feeds.events(spark, sf)
    event = F.col("event_id")
    definition = F.struct(
        F.struct(F.lit("float").alias("type"), F.col("event_type").alias("units")).alias("value"),
        F.struct(F.lit("integer").alias("type")).alias("k"),
        F.lit("no definition").alias("skipped"),
    )
    entry = F.struct(
        F.col("sensor_type"),
        F.when(
            event % 10 != 3,
            F.array(
                F.struct(
                    F.when(event % 2 == 0, "1").otherwise("x2").alias("data_structure_type"),
                    F.concat(F.lit("from "), event.cast("string")).alias("description"),
                    definition.alias("data_structure"),
                )
            ),
        ).alias("data_structures"),
    )
    body = (
        F.when(event % 10 == 1, F.to_json(F.struct(F.array(entry).alias("sensor_types"))))
        .when(event % 10 == 2, "[1]")
        .when(event % 10 == 4, '{"other":1}')
        .otherwise(F.to_json(entry))
    )
    return as_envelope(ev, "weather.metadata.catalog", event, body)


_CATALOG_ROWS = """
SELECT event_id AS off, sensor_type, CASE WHEN event_id % 2 = 0 THEN '1' ELSE 'x2' END AS structure,
  f AS field_name, CASE f WHEN 'value' THEN 'float' ELSE 'integer' END AS field_type,
  CASE f WHEN 'value' THEN event_type ELSE '' END AS units,
  'from ' || CAST(event_id AS VARCHAR) AS description
FROM m, (VALUES ('value'), ('k')) v(f) WHERE event_id % 10 NOT IN (2, 3, 4)"""


@query("PRJ15", _CATALOG_ROWS, "m")
def flatten_catalog(spark, sf):
    entries, _ = D.flatten_catalog(catalog_payloads(spark, sf))
    return entries.select(
        F.col("offset").alias("off"),
        F.col("sensor_type").cast("bigint").alias("sensor_type"),
        F.col("data_structure_type").alias("structure"),
        "field_name", "field_type", "units", "description",
    )


@query("PRJ15", """
SELECT event_id AS off, CASE event_id % 10 WHEN 2 THEN 'failed to parse catalog: not a JSON object'
  WHEN 4 THEN 'missing sensor_type in catalog message'
  ELSE 'missing data_structures in catalog message' END AS reason
FROM m WHERE event_id % 10 IN (2, 3, 4)""", "m")
def invalid_catalog(spark, sf):
    _, invalid = D.flatten_catalog(catalog_payloads(spark, sf))
    return invalid.select(F.col("offset").alias("off"), "reason")


_UPSERTED_CATALOG = f"""
SELECT * EXCLUDE (off) FROM ({_CATALOG_ROWS})
QUALIFY row_number() OVER (PARTITION BY sensor_type, structure, field_name ORDER BY off DESC) = 1"""


def _catalog_view(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("sensor_type").cast("bigint").alias("sensor_type"),
        F.col("data_structure_type").alias("structure"),
        "field_name", "field_type", "units", "description",
    )


@query("SNK4", f"""
SELECT coalesce(u.sensor_type, c.sensor_type) AS sensor_type, coalesce(u.structure, c.structure) AS structure,
  coalesce(u.field_name, c.field) AS field_name, coalesce(u.field_type, c.field_type) AS field_type,
  coalesce(u.units, c.units) AS units, coalesce(u.description, c.description) AS description
FROM ({_UPSERTED_CATALOG}) u FULL JOIN cat c
  ON u.sensor_type = c.sensor_type AND u.structure = c.structure AND u.field_name = c.field""", "cat")
def upsert_catalog(spark, sf):
    entries = cut_lineage(D.flatten_catalog(catalog_payloads(spark, sf))[0])
    stored = feeds.catalog(spark, sf).withColumn("id", F.lit(0).cast("bigint"))
    return _catalog_view(D.upsert_catalog(stored, entries, feeds.now()))


@query("STR3, SNK4", _UPSERTED_CATALOG, "m")
def catalog_streamed(spark, sf):
    """The earlier and the later half of the messages, with a restart between them."""
    tables = Tables(spark, scratch_dir(spark, "catalog"))
    inbox, offsets = scratch_dir(spark, "inbox"), scratch_dir(spark, "offsets")
    messages = catalog_payloads(spark, sf)
    middle = messages.agg((F.min("offset") + F.max("offset")) / 2).first()[0]
    for part in (messages.where(F.col("offset") <= middle), messages.where(F.col("offset") > middle)):
        # Files of one half are one micro-batch, in which the arrival decides, and so in any order.
        part.write.mode("append").parquet(inbox)
        stream = files.read_envelope_files(spark, inbox, stream=True)
        run = catalog_stream(stream, tables, offsets)
        run.trigger(availableNow=True).start().awaitTermination()
    return _catalog_view(tables.dimension("sensor_catalog"))


@query("STR4, SNK3, SNK4", """
SELECT 'devices' AS table_name, count(DISTINCT user_id) AS count FROM m WHERE event_id % 20 NOT IN (1, 2, 3)
UNION ALL SELECT 'orphans', count(*) FROM m WHERE event_id % 20 IN (2, 3)""", "m")
def metadata_phase(spark, sf):
    from hearthstream.operators.audit import counted

    tables = Tables(spark, scratch_dir(spark, "phase"))
    apply_metadata(metadata_messages(spark, sf), tables, feeds.now())
    return counted(
        devices=tables.dimension("devices"), orphans=tables.orphans(["reason"])
    )


# ---- tags ---------------------------------------------------------------


def _bare_tags(spark, sf) -> DataFrame:
    """The tags of a first run without what the catalog gave them, but for one field."""
    tags = feeds.built(spark, sf)["tags"]
    bare = {
        c: F.when(F.col("tag_name") == "kind", F.lit("kept")).cast("string")
        for c in ("unit", "description")
    }
    return tags.withColumns(bare).withColumn("metadata", F.lit(None).cast("string"))


@query("SNK5, T14", """
SELECT lsid, tag_name, CASE WHEN lsid % 2 = 0 THEN 'numeric' ELSE data_type END AS data_type,
  CASE WHEN lsid % 4 = 0 THEN 'new' WHEN tag_name = 'kind' THEN 'kept' END AS unit
FROM tags""", "tags")
def upsert_tags(spark, sf):
    old = _bare_tags(spark, sf)
    candidates = old.where("device_id % 2 = 0").select(
        "device_id", "tag_name", F.lit("numeric").alias("data_type"),
        F.when(F.col("device_id") % 4 == 0, "new").alias("unit"),
        F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("string").alias("metadata"),
    )
    return D.upsert_tags(old, candidates, feeds.now()).select(
        F.col("device_id").alias("lsid"), "tag_name", "data_type", "unit"
    )


@query("JN9, T15", """
SELECT t.lsid, tag_name, d.sensor_type, d.rt AS data_structure_type
FROM tags t JOIN dev d USING (lsid) WHERE d.rt IS NOT NULL""", "tags", "dev")
def tags_needing_enrichment(spark, sf):
    needing = D.tags_needing_enrichment(_bare_tags(spark, sf), feeds.devices(spark, sf))
    return needing.select(
        F.col("device_id").alias("lsid"), "tag_name", "sensor_type", "data_structure_type"
    )


_ENRICHED = """
SELECT t.lsid, tag_name,
  coalesce(CASE WHEN tag_name = 'kind' THEN 'kept' END, c.units) AS unit,
  coalesce(CASE WHEN tag_name = 'kind' THEN 'kept' END, c.description) AS description,
  c.field IS NOT NULL AS enriched
FROM tags t JOIN dev d USING (lsid) LEFT JOIN cat c
  ON c.sensor_type = d.sensor_type AND c.structure = CAST(d.rt AS VARCHAR) AND c.field = t.tag_name"""


@query("JN10, T14", _ENRICHED, "tags", "dev", "cat")
def enrich_tags(spark, sf):
    done = D.enrich_tags(
        _bare_tags(spark, sf), feeds.devices(spark, sf), feeds.catalog(spark, sf), feeds.now()
    )
    return done.select(
        F.col("device_id").alias("lsid"), "tag_name", "unit", "description",
        F.col("metadata").isNotNull().alias("enriched"),
    )


@query("JN11", f"""
SELECT * FROM ({_ENRICHED}) WHERE lsid = 2 AND tag_name = 'value'""", "tags", "dev", "cat")
def enrich_tag(spark, sf):
    tags = _bare_tags(spark, sf)
    tag_id = tags.where("device_id = 2 and tag_name = 'value'").first()["id"]
    done = D.enrich_tag(
        tags, feeds.devices(spark, sf), feeds.catalog(spark, sf), tag_id, feeds.now()
    )
    return done.select(
        F.col("device_id").alias("lsid"), "tag_name", "unit", "description",
        F.col("metadata").isNotNull().alias("enriched"),
    )


# ---- payload files ------------------------------------------------------


def _json_lines(spark, df: DataFrame, label: str) -> str:
    path = scratch_dir(spark, label)
    df.write.text(path)
    return path


@query("SRC6", """
SELECT lsid, sensor_type, category, station_id FROM dev""", "dev")
def read_sensor_metadata(spark, sf):
    sensors = feeds.devices(spark, sf).select("lsid", "sensor_type", "category", "station_id")
    payload = sensors.groupBy((F.col("lsid") / 10).cast("int").alias("b")).agg(
        F.collect_list(F.struct(*sensors.columns)).alias("sensors")
    )
    path = _json_lines(spark, payload.select(F.to_json(F.struct("sensors"))), "sensors")
    rows = files.read_sensor_metadata(spark, path, one_per_file=False)
    return rows.select(
        "lsid", F.col("sensor_type").cast("bigint").alias("sensor_type"), "category",
        F.col("station_id").cast("bigint").alias("station_id"),
    )


@query("SRC8", """
SELECT DISTINCT user_id AS station_id, 'station ' || CAST(user_id AS VARCHAR) AS station_name FROM m""", "m")
def read_stations(spark, sf):
    users = feeds.events(spark, sf).select("user_id").distinct()
    station = F.struct(
        F.col("user_id").alias("station_id"),
        F.concat(F.lit("station "), F.col("user_id").cast("string")).alias("station_name"),
    )
    body = F.to_json(F.struct(F.array(station).alias("stations"), F.lit(1).alias("generated_at")))
    path = _json_lines(spark, users.select(body), "stations")
    return files.read_stations(spark, path, one_per_file=False).select(
        F.col("station_id").cast("bigint").alias("station_id"), "station_name"
    )


def catalog_entries(spark, sf) -> DataFrame:
    """Catalog API entries read back from JSON: one per user number as sensor type."""
    users = feeds.events(spark, sf).select("user_id").distinct()
    structures = F.when(
        F.col("user_id") % 5 != 0,
        F.array(
            F.struct((F.col("user_id") % 4).cast("string").alias("data_structure_type")),
            F.struct(F.concat(F.lit("x"), F.col("user_id").cast("string")).alias("data_structure_type")),
            F.struct((F.col("user_id") % 7).cast("string").alias("data_structure_type")),
        ),
    ).otherwise(F.array(F.struct(F.lit("none").alias("data_structure_type"))))
    entry = F.struct(F.col("user_id").alias("sensor_type"), structures.alias("data_structures"))
    body = F.to_json(F.struct(F.array(entry).alias("sensor_types"), F.lit(77).alias("generated_at")))
    path = _json_lines(spark, users.select(body), "catalog")
    return files.read_sensor_catalog(spark, path, one_per_file=False)


@query("SRC7", """
SELECT DISTINCT user_id AS sensor_type, CAST(77 AS BIGINT) AS generated_at,
  CAST(CASE WHEN user_id % 5 <> 0 THEN 3 ELSE 1 END AS BIGINT) AS structures FROM m""", "m")
def read_sensor_catalog(spark, sf):
    return catalog_entries(spark, sf).select(
        F.col("sensor_type").cast("bigint").alias("sensor_type"), "generated_at",
        F.size("data_structures").cast("bigint").alias("structures"),
    )


