"""Devices, tags and the field catalog: parsing, upserts, enrichment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthstream.functions import (
    enveloped,
    field,
    is_json_null,
    is_kind,
    nullif_empty,
    nullif_zero,
    only_value,
)
from hearthstream.operators.envelope import ARRIVAL
from hearthstream.operators.keyed import last_wins, upsert
from hearthstream.operators.records import with_catalog
from hearthstream.session import cut_lineage

# Reasons stored with dead letters.
BAD_METADATA = "failed to parse metadata: not a JSON object"
BAD_LSID = "missing or invalid lsid in metadata"
BAD_CATALOG = "failed to parse catalog: not a JSON object"
NO_SENSOR_TYPE = "missing sensor_type in catalog message"
NO_STRUCTURES = "missing data_structures in catalog message"

TEXT_FIELDS = [
    "category", "manufacturer", "product_name", "product_number", "parent_device_type",
    "parent_device_name", "parent_device_id_hex", "station_name",
]
INT_FIELDS = ["rain_collector_type", "tx_id", "port_number", "station_id"]
LONG_FIELDS = ["parent_device_id", "created_date", "modified_date"]
PLACE_FIELDS = {"latitude": "decimal(10,6)", "longitude": "decimal(10,6)", "elevation": "decimal(10,3)"}


def _object(messages: DataFrame, out: str = "doc") -> DataFrame:
    # One-element explode: the text is parsed once, whatever refers to the result.
    parsed = messages.withColumn("_envelope", F.explode(F.array(enveloped(F.col("value").cast("string")))))
    return parsed.withColumn(out, only_value(F.col("_envelope"))).drop("_envelope")


@dataclass
class Metadata:
    """A metadata topic split by what each message is."""

    devices: DataFrame
    stations: DataFrame
    invalid: DataFrame


def classify_metadata(messages: DataFrame) -> DataFrame:
    """Add ``doc``, ``class`` (device, station, invalid) and ``reason``.

    A ``stations`` array makes a station message; otherwise a numeric ``lsid``
    makes a device message.
    """
    parsed = _object(messages)
    doc = F.col("doc")
    stations = F.try_variant_get(doc, "$.stations", "variant")
    has_stations = F.coalesce(is_kind(stations, "array"), F.lit(False))
    has_lsid = field(doc, "lsid", "number", "double").isNotNull()
    readable = F.coalesce(is_kind(doc, "object") | is_json_null(doc), F.lit(False))
    invalid = F.col("class") == "invalid"
    return parsed.withColumn(
        "class", F.when(has_stations, "station").when(has_lsid, "device").otherwise("invalid")
    ).withColumn(
        "reason", F.when(invalid & readable, F.lit(BAD_LSID)).when(invalid, F.lit(BAD_METADATA))
    )


def split_metadata(messages: DataFrame) -> Metadata:
    """Station messages, device messages, and the rest with a reason."""
    return _split(classify_metadata(messages))


def staged_metadata(messages: DataFrame) -> Metadata:
    """The same out of one pass that parses the messages and stages them by class.

    The text of a message is kept where it is invalid, and only its fields elsewhere.
    """
    marked = classify_metadata(messages)
    invalid = F.col("class") == "invalid"
    lean = {c: F.when(invalid, F.col(c)) for c in ("key", "headers", "value")}
    return _split(cut_lineage(marked.withColumns({**lean, "doc": F.when(~invalid, F.col("doc"))})))


def _split(marked: DataFrame) -> Metadata:
    return Metadata(
        devices=marked.where(F.col("class") == "device").drop("class", "reason"),
        stations=marked.where(F.col("class") == "station").drop("class", "reason"),
        invalid=marked.where(F.col("class") == "invalid").drop("class", "doc"),
    )


def device_rows(device_messages: DataFrame) -> DataFrame:
    """One typed device row per device message.

    Numeric zero means unknown (NULL), missing text is '', an empty station uuid
    is NULL and a missing ``active`` is false.
    """
    doc = F.col("doc")

    def number(name: str, kind: str) -> Column:
        # Through double, as the fraction of a whole-number field is cut off.
        return F.coalesce(field(doc, name, "number", "double"), F.lit(0.0)).cast(kind)

    def text(name: str) -> Column:
        return F.coalesce(field(doc, name, "string", "string"), F.lit(""))

    columns = {"lsid": number("lsid", "bigint"), "sensor_type": number("sensor_type", "int")}
    columns.update({name: text(name) for name in TEXT_FIELDS})
    columns.update({name: nullif_zero(number(name, "int")) for name in INT_FIELDS})
    columns.update({name: nullif_zero(number(name, "bigint")) for name in LONG_FIELDS})
    columns.update(
        {name: nullif_zero(number(name, "double")).cast(kind) for name, kind in PLACE_FIELDS.items()}
    )
    columns["station_id_uuid"] = nullif_empty(text("station_id_uuid"))
    columns["active"] = F.coalesce(field(doc, "active", "boolean", "boolean"), F.lit(False))
    columns["metadata"] = F.to_json(doc)
    return device_messages.select(*[c.alias(n) for n, c in columns.items()], *ARRIVAL)


def latest_devices(device_messages: DataFrame) -> DataFrame:
    """The last message of each device as a typed row.

    Messages are reduced before their fields are read: only the winners are
    taken apart.
    """
    number = field(F.col("doc"), "lsid", "number", "double").cast("bigint")
    winners = last_wins(
        device_messages.withColumn("_number", number), ["_number"], F.struct(*ARRIVAL),
        keep=["doc", *ARRIVAL],
    )
    return device_rows(winners)


def device_brief(rows: DataFrame) -> DataFrame:
    """The five-column device used by lookups."""
    return rows.select("lsid", "sensor_type", "category", "manufacturer", "product_name")


def upsert_devices(devices: DataFrame, rows: DataFrame, now: Column) -> DataFrame:
    """Last message per device overwrites everything it carries.

    ``id``, ``created_at`` and ``rt_data_structure_type`` survive.
    """
    latest = last_wins(rows, ["lsid"], F.struct(*ARRIVAL)).drop(*ARRIVAL)
    overwritten = {c: F.col(f"new.{c}") for c in latest.columns if c != "lsid"}
    overwritten["updated_at"] = now
    overwritten["created_at"] = F.coalesce(F.col("old.created_at"), now)
    return upsert(devices, latest, ["lsid"], overwritten)


def flatten_catalog(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, invalid) of catalog messages.

    Accepts ``{"sensor_types": [...]}`` and a single ``{"sensor_type": ...}``.
    Nested parts of the wrong shape are skipped.  An entry keeps its raw field
    definition and the description of its data structure.
    """
    parsed = _object(messages)
    doc = F.col("doc")
    wrapped = F.try_variant_get(doc, "$.sensor_types", "array<variant>")
    is_wrapped = F.coalesce(
        is_kind(F.try_variant_get(doc, "$.sensor_types", "variant"), "array"), F.lit(False)
    )
    is_object = F.coalesce(is_kind(doc, "object") | is_json_null(doc), F.lit(False))
    single = F.when(is_object & ~is_wrapped, F.array(doc))
    types = parsed.withColumn("_wrapped", is_wrapped).select(
        *messages.columns, "_wrapped", F.explode_outer(F.coalesce(
            F.when(is_wrapped, wrapped), single, F.array(F.lit(None).cast("variant"))
        )).alias("entry"), is_object.alias("_object"),
    )
    entry = F.col("entry")
    sensor_type = field(entry, "sensor_type", "number", "double")
    structures = F.try_variant_get(entry, "$.data_structures", "variant")
    problem = (
        F.when(~F.col("_object"), BAD_CATALOG)
        .when(sensor_type.isNull(), NO_SENSOR_TYPE)
        .when(~F.coalesce(is_kind(structures, "array"), F.lit(False)), NO_STRUCTURES)
    )
    checked = types.withColumn("reason", problem)
    # Inside a wrapper a bad element is only skipped.
    invalid = checked.where(F.col("reason").isNotNull() & ~F.col("_wrapped")).select(
        *messages.columns, "reason"
    )
    parts = (
        checked.where(F.col("reason").isNull())
        .select(
            *ARRIVAL,
            sensor_type.cast("int").alias("sensor_type"),
            F.posexplode(
                F.try_variant_get(entry, "$.data_structures", "array<variant>")
            ).alias("_position", "structure"),
        )
        .select(
            *ARRIVAL,
            "_position",
            "sensor_type",
            field(F.col("structure"), "data_structure_type", "string", "string").alias(
                "data_structure_type"
            ),
            F.coalesce(
                field(F.col("structure"), "description", "string", "string"), F.lit("")
            ).alias("description"),
            F.try_variant_get("structure", "$.data_structure", "variant").alias("fields"),
        )
        .where(
            F.col("data_structure_type").isNotNull() & is_kind(F.col("fields"), "object")
        )
    )
    fields = parts.lateralJoin(
        parts.sparkSession.tvf.variant_explode(F.col("fields").outer()).select(
            F.col("key").alias("field_name"), F.col("value").alias("definition")
        )
    ).where(is_kind(F.col("definition"), "object"))
    entries = fields.select(
        "sensor_type",
        "data_structure_type",
        "field_name",
        F.coalesce(field(F.col("definition"), "type", "string", "string"), F.lit("")).alias(
            "field_type"
        ),
        F.coalesce(field(F.col("definition"), "units", "string", "string"), F.lit("")).alias(
            "units"
        ),
        "description",
        F.try_variant_get("definition", "$", "map<string,variant>").alias("raw_definition"),
        *ARRIVAL,
        "_position",
    )
    return entries, invalid


CATALOG_KEYS = ["sensor_type", "data_structure_type", "field_name"]


def latest_catalog(entries: DataFrame) -> DataFrame:
    """Last arriving definition per catalog key, raw definition included."""
    latest = last_wins(entries, CATALOG_KEYS, F.struct(*ARRIVAL, "_position"))
    return latest.drop(*ARRIVAL, "_position")


def upsert_catalog(catalog: DataFrame, entries: DataFrame, now: Column) -> DataFrame:
    """Overwrite type, units and description per (sensor type, structure, field)."""
    latest = latest_catalog(entries).drop("raw_definition")
    overwritten = {c: F.col(f"new.{c}") for c in ("field_type", "units", "description")}
    overwritten["updated_at"] = now
    overwritten["created_at"] = F.coalesce(F.col("old.created_at"), now)
    return upsert(catalog, latest, CATALOG_KEYS, overwritten)


def upsert_tags(tags: DataFrame, candidates: DataFrame, now: Column) -> DataFrame:
    """Get or create tags.

    The type is overwritten; unit, description and metadata only where the
    candidate has one.
    """
    overwritten = {
        "data_type": F.col("new.data_type"),
        "updated_at": now,
        "created_at": F.coalesce(F.col("old.created_at"), now),
    }
    for c in ("unit", "description", "metadata"):
        overwritten[c] = F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}"))
    return upsert(tags, candidates, ["device_id", "tag_name"], overwritten)


def tags_needing_enrichment(tags: DataFrame, devices: DataFrame) -> DataFrame:
    """Tags lacking unit, description or metadata, of devices with a known structure."""
    owner = devices.select(
        F.col("id").alias("device_id"),
        F.col("sensor_type").cast("bigint").alias("sensor_type"),
        F.col("rt_data_structure_type").cast("bigint").alias("data_structure_type"),
    ).where(F.col("data_structure_type").isNotNull())
    lacking = tags.where(
        F.col("unit").isNull() | F.col("description").isNull() | F.col("metadata").isNull()
    )
    return lacking.join(owner, "device_id").select(
        F.col("id").alias("tag_id"), "device_id", "tag_name", "sensor_type", "data_structure_type"
    )


def enrich_tags(tags: DataFrame, devices: DataFrame, catalog: DataFrame, now: Column) -> DataFrame:
    """Fill unit, description and metadata from the catalog; present values stay."""
    found = (
        with_catalog(tags_needing_enrichment(tags, devices), catalog)
        .where(F.col("unit").isNotNull())
        .select(
            F.col("tag_id").alias("id"),
            F.col("unit").alias("_unit"),
            F.col("description").alias("_description"),
            F.col("metadata").alias("_metadata"),
        )
    )
    hit = F.col("_unit").isNotNull()
    return (
        tags.join(found, "id", "left")
        .withColumns(
            {
                "unit": F.coalesce("unit", "_unit"),
                "description": F.coalesce("description", "_description"),
                "metadata": F.coalesce("metadata", "_metadata"),
                "updated_at": F.when(hit, now).otherwise(F.col("updated_at")),
            }
        )
        .select(*tags.columns)
    )


def enrich_tag(
    tags: DataFrame, devices: DataFrame, catalog: DataFrame, tag_id: int, now: Column
) -> DataFrame:
    """Enrich one tag; a tag without a catalog row is an error."""
    one = tags.where(F.col("id") == tag_id)
    owner = devices.select(
        F.col("id").alias("device_id"),
        F.col("sensor_type").cast("bigint").alias("sensor_type"),
        F.col("rt_data_structure_type").cast("bigint").alias("data_structure_type"),
    )
    keys = one.select("device_id", "tag_name").join(owner, "device_id")
    if with_catalog(keys, catalog).where(F.col("unit").isNotNull()).isEmpty():
        raise LookupError(f"no catalog metadata found for tag {tag_id}")
    return enrich_tags(one, devices, catalog, now)


def station_updates(station_messages: DataFrame) -> DataFrame:
    """One row per station of each message, in message and array order."""
    exploded = station_messages.select(
        *ARRIVAL,
        F.posexplode(F.try_variant_get("doc", "$.stations", "array<variant>")).alias(
            "position", "station"
        ),
    )
    station = F.col("station")
    return exploded.select(
        *ARRIVAL,
        "position",
        field(station, "station_id", "number", "double").cast("int").alias("station_id"),
        F.coalesce(field(station, "station_name", "string", "string"), F.lit("")).alias(
            "station_name"
        ),
        nullif_empty(field(station, "station_id_uuid", "string", "string")).alias(
            "station_id_uuid"
        ),
    ).where(F.col("station_id").isNotNull())


def _adopted(devices: DataFrame, updates: DataFrame) -> DataFrame:
    """Devices with the station they belong to once all updates are applied.

    Applying updates one by one, the very first captures every device without a
    station; after that nobody is without one.  So the outcome depends only on
    the first update and, per station, on the last: no loop is needed.
    """
    first = updates.agg(
        F.min_by("station_id", F.struct(*ARRIVAL, "position")).alias("s")
    ).scalar()
    return devices.withColumn("_station", F.coalesce(F.col("station_id"), first))


def update_station_info(devices: DataFrame, updates: DataFrame, now: Column) -> DataFrame:
    """Set station id, name and uuid on each station's devices."""
    latest = last_wins(updates, ["station_id"], F.struct(*ARRIVAL, "position")).select(
        F.col("station_id").alias("_station"),
        F.col("station_name").alias("_name"),
        F.col("station_id_uuid").alias("_uuid"),
        F.lit(True).alias("_hit"),
    )
    hit = F.col("_hit")
    return (
        _adopted(devices, updates)
        .join(latest, "_station", "left")
        .withColumns(
            {
                "station_id": F.when(hit, F.col("_station")).otherwise(F.col("station_id")),
                "station_name": F.when(hit, F.col("_name")).otherwise(F.col("station_name")),
                "station_id_uuid": F.when(hit, F.col("_uuid")).otherwise(
                    F.col("station_id_uuid")
                ),
                "updated_at": F.when(hit, now).otherwise(F.col("updated_at")),
            }
        )
        .select(*devices.columns)
    )


def station_update_counts(devices: DataFrame, updates: DataFrame) -> DataFrame:
    """How many devices each station update touches."""
    sizes = _adopted(devices, updates).groupBy("_station").agg(F.count(F.lit(1)).alias("_n"))
    return updates.join(
        sizes.withColumnRenamed("_station", "station_id"), "station_id", "left"
    ).select(*ARRIVAL, "position", "station_id", F.coalesce("_n", F.lit(0)).alias("updated"))


def set_rt_type(devices: DataFrame, messages: DataFrame) -> DataFrame:
    """Latest positive structure type seen in the headers of each device's messages."""
    latest = (
        messages.where(F.col("data_structure_type") > 0)
        .groupBy("lsid")
        .agg(F.max_by("data_structure_type", F.struct(*ARRIVAL)).cast("int").alias("_seen"))
    )
    return (
        devices.join(latest, "lsid", "left")
        .withColumn("rt_data_structure_type", F.coalesce("_seen", "rt_data_structure_type"))
        .select(*devices.columns)
    )


def delete_device_cascade(
    devices: DataFrame, tags: DataFrame, records: DataFrame, lsid: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What is left after deleting a device, its tags and their records."""
    doomed = devices.where(F.col("lsid") == lsid).select(F.col("id").alias("device_id"))
    doomed_tags = tags.join(doomed, "device_id", "left_semi")
    return (
        devices.where(~F.col("lsid").eqNullSafe(F.lit(lsid))),
        tags.join(doomed, "device_id", "left_anti"),
        records.join(doomed_tags.select(F.col("id").alias("tag_id")), "tag_id", "left_anti"),
    )
