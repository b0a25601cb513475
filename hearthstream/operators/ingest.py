"""Shaping polled API snapshots into keyed, deduplicated messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthstream.functions import as_number, sha256_hex, start_of_week, value_kind
from hearthstream.operators.envelope import record_headers, string_headers
from hearthstream.operators.keyed import first_wins
from hearthstream.operators.ordered import previous_row, with_chunk

# Sensor category (upper case) -> topic.
CATEGORY_TOPICS = {
    "ISS": "weather.iss",
    "BAROMETER": "weather.barometer",
    "INSIDE TEMP/HUM": "weather.indoor",
    "HEALTH": "weather.health",
}
OTHER_TOPIC = "weather.other"
SENSORS_TOPIC = "weather.metadata.sensors"
CATALOG_TOPIC = "weather.metadata.catalog"
STATION_TOPIC = "weather.metadata.station"

# The publisher of the records also replays only the first group.
STRICT_RECORD_TOPICS = list(CATEGORY_TOPICS.values())
RECORD_TOPICS = [*STRICT_RECORD_TOPICS, OTHER_TOPIC]
METADATA_TOPICS = [SENSORS_TOPIC, CATALOG_TOPIC, STATION_TOPIC]


def topic_for_category(category: Column) -> Column:
    upper = F.upper(category)
    chosen = None
    for name, topic in CATEGORY_TOPICS.items():
        chosen = F.when(upper == name, topic) if chosen is None else chosen.when(upper == name, topic)
    return chosen.otherwise(OTHER_TOPIC)


def explode_points(snapshots: DataFrame, sequence: str = "generated_at") -> DataFrame:
    """One row per sensor and data point, with its position for ordering.

    ``sequence`` orders the snapshots among each other.
    """
    sensors = snapshots.select(
        F.col(sequence).alias("snapshot"), F.posexplode("sensors").alias("sensor_pos", "sensor")
    )
    return sensors.select(
        "snapshot",
        "sensor_pos",
        F.col("sensor.lsid").alias("lsid"),
        F.col("sensor.sensor_type").alias("sensor_type"),
        F.col("sensor.data_structure_type").alias("data_structure_type"),
        F.posexplode("sensor.data").alias("point_pos", "point"),
    )


POINT_ORDER = ["snapshot", "sensor_pos", "point_pos"]


def point_timestamp(point: Column) -> Column:
    """``ts`` of a point when it is a number (cut to an integer), else 0."""
    ts = F.try_variant_get(point, "$.ts", "variant")
    return F.coalesce(
        F.when(value_kind(ts) == "number", as_number(ts).try_cast("bigint")),
        F.lit(0).cast("bigint"),
    )


def record_key(lsid: Column, ts: Column) -> Column:
    return F.concat_ws(":", lsid, ts)


def keyed_points(points: DataFrame) -> DataFrame:
    """Add ``ts`` and ``key``; a point that is not an object is dropped."""
    readable = points.where(value_kind(F.col("point")).isin("object", "null"))
    return readable.withColumn("ts", point_timestamp(F.col("point"))).withColumn(
        "key", record_key(F.col("lsid"), F.col("ts"))
    )


def with_sensor(points: DataFrame, sensors: DataFrame) -> DataFrame:
    """Inner lookup of the sensor's category; unknown sensors are skipped.

    Spark counts on 2 KB for each variant, so points without theirs seem a hundred
    times smaller than they are, and an inner join broadcasts them through the driver.
    These two joins can broadcast the sensors only.
    """
    known = points.join(sensors.select("lsid"), "lsid", "left_semi")
    return known.join(sensors.select("lsid", "category"), "lsid", "left")


def dedup_keys(points: DataFrame) -> DataFrame:
    """First point per ``lsid:ts`` key."""
    return first_wins(points, ["key"], F.struct(*POINT_ORDER))


def unpublished(rows: DataFrame, published: DataFrame) -> DataFrame:
    """Rows whose key has not been published yet."""
    return rows.join(published.select("key"), "key", "left_anti")


def record_messages(points: DataFrame) -> DataFrame:
    """Data messages of deduplicated, looked-up points."""
    return points.select(
        topic_for_category(F.col("category")).alias("topic"),
        "key",
        F.to_json("point").cast("binary").alias("value"),
        record_headers(
            F.col("lsid"), F.col("ts"), F.col("sensor_type"), F.col("data_structure_type")
        ).alias("headers"),
    )


def ingest_counts(points: DataFrame, sensors: DataFrame, published: DataFrame) -> DataFrame:
    """One row: published, skipped (duplicates) and unknown-sensor points.

    Duplicates are counted from per-key sums, so nothing larger than one row per
    key leaves a map task.
    """
    known = sensors.select("lsid").withColumn("_known", F.lit(True))
    done = published.select("key").distinct().withColumn("_done", F.lit(True))
    per_key = (
        points.join(known, "lsid", "left")
        .groupBy("key", F.coalesce("_known", F.lit(False)).alias("known"))
        .agg(F.count(F.lit(1)).alias("n"))
        .join(done, "key", "left")
    )
    fresh = F.when(F.col("known") & F.col("_done").isNull(), 1).otherwise(0)
    return per_key.agg(
        F.coalesce(F.sum(fresh), F.lit(0)).alias("published"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("n") - fresh)), F.lit(0)).alias("skipped"),
        F.coalesce(F.sum(F.when(~F.col("known"), F.col("n"))), F.lit(0)).alias("unknown_sensor"),
    )


# ---- metadata -----------------------------------------------------------


def sensor_types(sensors: DataFrame) -> DataFrame:
    return sensors.select("sensor_type").distinct()


def owned_catalog(catalog: DataFrame, sensors: DataFrame) -> DataFrame:
    """Catalog entries of sensor types that occur among the sensors."""
    return catalog.join(sensors.select("sensor_type"), "sensor_type", "left_semi")


def max_data_structure_type(structures: Column) -> Column:
    """Largest structure type that reads as an integer, NULL when none does."""
    return F.array_max(
        F.transform(
            structures,
            lambda d: F.when(
                d["data_structure_type"].rlike(r"\A[+-]?[0-9]+\z"),
                d["data_structure_type"].try_cast("bigint"),
            ),
        )
    )


def sensor_metadata_messages(sensors: DataFrame, now: Column) -> DataFrame:
    """One message per sensor, keyed ``lsid:week``."""
    return sensors.select(
        F.lit(SENSORS_TOPIC).alias("topic"),
        record_key(F.col("lsid"), start_of_week(now)).alias("key"),
        F.to_json(F.struct(*sensors.columns), {"ignoreNullFields": "false"})
        .cast("binary")
        .alias("value"),
        string_headers(schema_version="1").alias("headers"),
    )


def catalog_messages(entries: DataFrame, sensors: DataFrame, generated_at: Column) -> DataFrame:
    """One message per owned catalog entry, keyed ``sensor_type:maxStructure``."""
    owned = owned_catalog(entries, sensors).withColumn(
        "_max", max_data_structure_type(F.col("data_structures"))
    )
    return owned.where(F.col("_max").isNotNull()).select(
        F.lit(CATALOG_TOPIC).alias("topic"),
        record_key(F.col("sensor_type"), F.col("_max")).alias("key"),
        F.to_json(F.struct(*[c for c in entries.columns if c != "generated_at"]))
        .cast("binary")
        .alias("value"),
        string_headers(schema_version="1", generated_at=generated_at).alias("headers"),
    )


def station_messages(response: DataFrame, station_id: str, now: Column) -> DataFrame:
    """The station payload as one message, keyed ``station_id:week``."""
    return response.select(
        F.lit(STATION_TOPIC).alias("topic"),
        record_key(F.lit(station_id), start_of_week(now)).alias("key"),
        F.to_json(F.struct(*response.columns)).cast("binary").alias("value"),
        string_headers(schema_version="1", station_id=station_id).alias("headers"),
    )


def dedup_metadata(messages: DataFrame, published: DataFrame) -> DataFrame:
    """One message per metadata key, across restarts.

    The three metadata topics share one key space.
    """
    by_topic_order = F.struct(
        F.array_position(F.array(*[F.lit(t) for t in METADATA_TOPICS]), F.col("topic")),
        F.col("value"),
    )
    return unpublished(first_wins(messages, ["key"], by_topic_order), published)


def payload_hash(document: Column) -> Column:
    """SHA-256 of a JSON document without its top-level ``generated_at``."""
    fields = F.from_json(document, "map<string,variant>")
    kept = F.map_filter(fields, lambda k, _: k != "generated_at")
    return sha256_hex(F.to_json(kept).cast("binary"))


def changed_payloads(
    payloads: DataFrame, keys: list[str], order: str | list[str], document: str, chunk_seconds: int = 86400
) -> DataFrame:
    """Payloads that differ from the previous one of the same key.

    ``order`` is a time in seconds, or that and what orders equal times.
    """
    order = [order] if isinstance(order, str) else order
    hashed = with_chunk(
        payloads.withColumn("payload_hash", payload_hash(F.col(document))),
        F.col(order[0]),
        chunk_seconds,
    )
    with_previous = previous_row(hashed, keys, order, ["payload_hash"], "_previous")
    changed = ~F.col("_previous.payload_hash").eqNullSafe(F.col("payload_hash"))
    return with_previous.where(changed).drop("_previous", "_chunk")
