"""Reporting and audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthstream import schemas
from hearthstream.operators import audit as A
from hearthstream.operators import dimensions as D
from hearthstream.operators.envelope import with_header_columns
from hearthstream.plans import reports
from hearthstream.plans.deletion import delete_device
from hearthstream.session import scratch_dir
from hearthstream.sources.tables import Tables
from workload import feeds
from workload.registry import query
from workload.twins import NUMERIC_TEXT


def _dims(spark, sf):
    tables = feeds.built(spark, sf)
    return feeds.devices(spark, sf), tables["tags"], tables["records"], tables["orphans"]


@query("AGG1, SET2", """
SELECT 'Devices' AS type, CAST(count(*) AS VARCHAR) AS count FROM dev
UNION ALL SELECT 'Tags', CAST(count(*) AS VARCHAR) FROM seen
UNION ALL SELECT 'Numeric Records', CAST(count(*) AS VARCHAR) FROM rec WHERE rkind = 'numeric'
UNION ALL SELECT 'Text Records', CAST(count(*) AS VARCHAR) FROM rec WHERE rkind = 'text'
UNION ALL SELECT 'Null Records', CAST(count(*) AS VARCHAR) FROM rec WHERE rkind = 'null'
UNION ALL SELECT 'Orphaned (pending)', CAST(count(*) AS VARCHAR) FROM orph""", "rec", "orph")
def table_stats(spark, sf):
    return reports.table_stats(*_dims(spark, sf))


@query("AGG2, JN14, TOP2", """
SELECT lsid, category, product_name, (SELECT count(*) FROM seen s WHERE s.lsid = dev.lsid) AS tags
FROM dev ORDER BY lsid""", "seen")
def device_list(spark, sf):
    devices, tags, _, _ = _dims(spark, sf)
    return reports.device_list(devices, tags)


@query("AGG3, JN13", """
SELECT dev.lsid, category, count(s.field) AS tag_count
FROM dev LEFT JOIN seen s ON dev.lsid = s.lsid
GROUP BY dev.lsid, category ORDER BY dev.lsid""", "seen")
def tags_per_device(spark, sf):
    devices, tags, _, _ = _dims(spark, sf)
    return reports.tags_per_device(devices, tags)


@query("AGG4, JN14", """
SELECT s.lsid, s.field AS tag_name, s.data_type,
  (SELECT count(*) FROM rec r WHERE r.lsid = s.lsid AND r.field = s.field) AS record_count
FROM seen s""", "rec")
def tag_record_counts(spark, sf):
    devices, tags, records, _ = _dims(spark, sf)
    return reports.tag_record_counts(devices, tags, records)


@query("AGG4, TOP2", """
SELECT s.lsid, s.field AS tag_name, s.data_type,
  (SELECT count(*) FROM rec r WHERE r.lsid = s.lsid AND r.field = s.field) AS record_count
FROM seen s WHERE s.lsid = 8""", "rec")
def tag_record_counts_device(spark, sf):
    devices, tags, records, _ = _dims(spark, sf)
    return reports.tag_record_counts(devices, tags, records, lsid=8)


@query("JN12", f"""
SELECT r.lsid, category, field AS tag_name, hts AS ts, rkind AS value_type,
  CASE rkind WHEN 'numeric' THEN {NUMERIC_TEXT} WHEN 'text' THEN txt END AS value
FROM rec r JOIN dev USING (lsid)""", "rec")
def joined_records(spark, sf):
    devices, tags, records, _ = _dims(spark, sf)
    return reports.joined_records(records, tags, devices).select(
        "lsid", "category", "tag_name", "ts", "value_type", "value"
    )


_RECENT = f"""
SELECT {{extra}}field AS tag_name, CASE rkind WHEN 'numeric' THEN {NUMERIC_TEXT}
  WHEN 'text' THEN txt END AS value, rkind AS value_type, hts AS ts, make_timestamp(hts * 1000000) AS time
FROM rec r JOIN dev USING (lsid) {{where}}
ORDER BY hts DESC, r.lsid, field, rkind LIMIT 20"""


@query("TOP1, JN12, FN6", _RECENT.format(extra="r.lsid, category, ", where=""), "rec")
def recent_records(spark, sf):
    devices, tags, records, _ = _dims(spark, sf)
    rows = reports.recent_records(records, tags, devices)
    return rows.withColumn("time", F.col("time").cast("timestamp_ntz"))


@query("TOP1", _RECENT.format(extra="", where="WHERE lsid = 8"), "rec")
def recent_records_device(spark, sf):
    devices, tags, records, _ = _dims(spark, sf)
    rows = reports.recent_records(records, tags, devices, lsid=8)
    return rows.withColumn("time", F.col("time").cast("timestamp_ntz"))


@query("AGG7", """
SELECT lsid, field AS tag_name, hts AS ts, count(*) AS count
FROM routedd WHERE rkind <> 'rejected' GROUP BY lsid, field, hts, rkind HAVING count(*) > 1""", "routedd")
def duplicate_records(spark, sf):
    # Before first-wins, so that there are duplicates to find.
    routed = feeds.built(spark, sf, duplicated=True)["routed"].where("kind <> 'rejected'")
    tags = feeds.built(spark, sf, duplicated=True)["tags"]
    keys = tags.select(F.col("id").alias("tag_id"), F.col("device_id").alias("lsid"), "tag_name")
    return (
        A.duplicate_records(routed).join(keys, "tag_id").select("lsid", "tag_name", "ts", "count")
    )


@query("AGG10", """
SELECT topic, min(off) AS start_offset, max(off) + 1 AS current_offset, count(*) AS messages,
  round((max(off) + 1 - min(off)) / ((SELECT 2 * max(off) FROM m) - min(off)) * 100.0, 1) AS percent
FROM m GROUP BY topic""", "m")
def topic_progress(spark, sf):
    messages = feeds.messages(spark, sf)
    end = 2 * messages.agg(F.max("offset")).first()[0]
    return A.topic_progress(messages, end)


@query("AGG12", """
SELECT topic, CAST(part AS BIGINT) AS partition, min(off) AS low, max(off) + 1 AS high,
  max(off) + 1 - min(off) AS size FROM m GROUP BY topic, part""", "m")
def topic_sizes(spark, sf):
    return A.topic_sizes(feeds.messages(spark, sf)).withColumn(
        "partition", F.col("partition").cast("bigint")
    )


@query("AGG18", """
SELECT count(*) AS tags, count(unit) AS tags_with_unit, (SELECT count(*) FROM cat) AS catalog_entries
FROM tags""", "tags")
def unit_coverage(spark, sf):
    _, tags, _, _ = _dims(spark, sf)
    return A.unit_coverage(tags, feeds.catalog(spark, sf))


@query("AGG19", """
SELECT count(DISTINCT lsid) AS sensors, count(DISTINCT hts // 86400) AS days, count(*) AS messages,
  CAST(sum(strlen(props)) AS BIGINT) AS bytes,
  round(count(DISTINCT lsid) * (count(*) / count(DISTINCT lsid) / count(DISTINCT hts // 86400)) * 365
    * (sum(strlen(props)) / count(*)) * 0.5 / 1e6, 6) AS mb_per_year
FROM m JOIN (SELECT event_id, props FROM events) USING (event_id)""", "m")
def storage_projection(spark, sf):
    # The bodies are the JSON documents of the table, as they are.
    events = feeds.table(spark, sf, "events").select("event_id", F.col("props").cast("binary").alias("value"))
    messages = with_header_columns(feeds.messages(spark, sf)).drop("value")
    sized = messages.join(events, F.col("offset") == F.col("event_id"))
    return A.storage_projection(sized, 0.5).withColumn(
        "mb_per_year", F.round("mb_per_year", 6)
    )


@query("JN20", """
SELECT 'tags' AS table_name, count(*) AS dangling FROM seen WHERE lsid % 3 = 0 AND field NOT IN ('value', 'note')
UNION ALL SELECT 'records_' || k, (SELECT count(*) FROM rec WHERE rkind = k AND field IN ('value', 'note'))
FROM (VALUES ('numeric'), ('text'), ('null')) v(k)""", "rec")
def integrity_audit(spark, sf):
    devices, tags, records, _ = _dims(spark, sf)
    # Every third device and the tags value and note are gone: both leave dangling rows.
    return A.integrity_audit(
        devices.where("lsid % 3 <> 0"), tags.where("tag_name not in ('value', 'note')"), records
    )


@query("JN21", """
SELECT 'devices' AS table_name, count(*) AS count FROM dev WHERE lsid <> 8
UNION ALL SELECT 'tags', count(*) FROM seen WHERE lsid <> 8
UNION ALL SELECT 'records', count(*) FROM rec WHERE lsid <> 8""", "rec")
def delete_device_cascade(spark, sf):
    devices, tags, records, _ = _dims(spark, sf)
    left = D.delete_device_cascade(devices, tags, records, 8)
    return A.counted(devices=left[0], tags=left[1], records=left[2])


@query("WIN2", """
WITH c AS (SELECT event_type AS metric, epoch_us(ts) // 86400000000 AS tick, count(*) AS n FROM events GROUP BY ALL),
r AS (SELECT metric, tick, CAST(sum(n) OVER (PARTITION BY metric ORDER BY tick) AS BIGINT) AS value FROM c)
SELECT metric, tick, value,
  value - coalesce(lag(value) OVER (PARTITION BY metric ORDER BY tick), 0) AS delta FROM r""")
def metric_deltas(spark, sf):
    daily = (
        feeds.events(spark, sf)
        .groupBy(
            F.col("event_type").alias("metric"),
            F.floor(F.col("hts") / 86400).alias("tick"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return A.metric_deltas(A.cumulative_metrics(daily))


@query("SRC11", """
SELECT s.lsid AS device_id, s.field AS tag_name, s.data_type FROM seen s""", "seen")
def load_tags(spark, sf):
    tables = Tables(spark, scratch_dir(spark, "tags"))
    tables.replace_dimension("tags", _dims(spark, sf)[1])
    return tables.dimension("tags").select("device_id", "tag_name", "data_type")


@query("SRC11", """
SELECT sensor_type, structure AS data_structure_type, field AS field_name, field_type, units, description
FROM cat""", "cat")
def load_catalog(spark, sf):
    tables = Tables(spark, scratch_dir(spark, "catalog"))
    tables.replace_dimension("sensor_catalog", feeds.catalog(spark, sf))
    columns = [c.split()[0] for c in schemas.CATALOG_DDL.split(", ")][1:7]
    return tables.dimension("sensor_catalog").select(
        *[F.col(c).cast("bigint").alias(c) if c == "sensor_type" else F.col(c) for c in columns]
    )


@query("JN21", """
SELECT 'devices' AS table_name, count(*) AS count FROM dev WHERE lsid <> 8
UNION ALL SELECT 'tags', count(*) FROM seen WHERE lsid <> 8
UNION ALL SELECT 'records_' || k, (SELECT count(*) FROM rec WHERE rkind = k AND lsid <> 8)
FROM (VALUES ('numeric'), ('text'), ('null')) v(k)""", "rec")
def delete_stored_device(spark, sf):
    devices, tags, records, _ = _dims(spark, sf)
    tables = Tables(spark, scratch_dir(spark, "deletion"))
    tables.replace_dimension("devices", devices)
    tables.replace_dimension("tags", tags)
    tables.append_records(records)
    delete_device(tables, 8)
    return tables.counts().where("table_name <> 'sensor_catalog'")
