"""Materialization operators: device lookup, tag typing, routing, insert-if-absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthstream.functions import (
    as_number,
    as_text,
    merge_json,
    numeric_text,
    record_date,
    tag_type,
    value_kind,
)
from hearthstream.operators.envelope import ARRIVAL, headers_map
from hearthstream.operators.keyed import first_wins
from hearthstream.session import cut_lineage

# Reasons stored with dead letters.
MISSING_DEVICE = "missing_device"
BAD_BODY = "failed to parse message body: not a JSON object"

# Kinds of record and the tag types that accept a value of that kind.  The
# aliases are accepted on existing tags.
NUMERIC_TYPES = ["numeric", "float", "integer"]
TEXT_TYPES = ["text", "string"]

# Numbers first: sorting compares them without touching strings.
RECORD_KEYS = ["tag_id", "ts", "kind"]


# Dimension joins carry no hint on purpose: Spark broadcasts a dimension when its
# measured size is below spark.sql.autoBroadcastJoinThreshold, and otherwise sorts
# and merges, splitting hot keys (adaptive skew join).


def with_device(messages: DataFrame, devices: DataFrame) -> DataFrame:
    """Left lookup by device number: adds ``device_id`` (NULL when unknown)."""
    lookup = devices.select("lsid", F.col("id").alias("device_id"))
    return messages.join(lookup, "lsid", "left")


def missing_device(messages: DataFrame, devices: DataFrame) -> DataFrame:
    """Messages of devices not in the dimension."""
    return messages.join(devices.select("lsid"), "lsid", "left_anti")


def as_orphans(messages: DataFrame, reason: Column, now: Column, tag_name: str = "") -> DataFrame:
    """Dead-letter rows for messages that carry header columns."""
    return messages.select(
        "topic",
        "partition",
        "offset",
        "lsid",
        "record_ts",
        F.lit(tag_name).alias("tag_name"),
        reason.alias("reason"),
        headers_map(F.col("headers")).alias("message_headers"),
        F.col("value").cast("string").alias("message_body"),
        now.alias("created_at"),
        F.lit(False).alias("reprocessed"),
    )


def melted_points(melted: DataFrame) -> DataFrame:
    """The narrow form that later steps shuffle: values decoded, bodies gone."""
    facts = [
        "device_id", "lsid", "sensor_type", "data_structure_type", "field",
    ]
    value, kind = F.col("field_value"), F.col("value_kind")
    kinds = melted.select(
        *facts, value_kind(value).alias("value_kind"), value,
        F.col("record_ts").alias("ts"), *ARRIVAL,
    )
    # Guarded by kind: a bare conversion would turn true into 1.0 and "5" into 5.0,
    # and would render every number as text only to drop it again.
    return kinds.select(
        *facts,
        "value_kind",
        F.when(kind == "number", as_number(value)).alias("num_value"),
        F.when(kind == "string", as_text(value)).alias("text_value"),
        "ts",
        *ARRIVAL,
    )


def first_seen_types(points: DataFrame) -> DataFrame:
    """Type of the first value ever seen per (device, field).

    The header types of that first message come along, because a new tag is
    enriched by them.  The earliest time of each type of a tag is found by an aggregate
    over numbers, which no sort of the points precedes.  Only where two types of a tag
    share its earliest time does the rest of the arrival decide, and only the points of
    those tags and times are ordered by it.  ``points`` are read twice: stage them where
    that is dear.
    """
    # A time that is missing comes first, as it does in the order of arrival.
    micros = F.coalesce(F.unix_micros("timestamp"), F.lit(-(2**63)))
    timed = points.withColumn("_micros", micros)
    types = ["value_kind", "sensor_type", "data_structure_type"]
    by_type = cut_lineage(
        timed.groupBy("device_id", "field", *types).agg(F.min("_micros").alias("_earliest"))
    )
    # The least and the greatest type of the earliest time: more than one, if they differ.
    by_tag = by_type.groupBy("device_id", "field").agg(
        F.min(F.struct("_earliest", *types)).alias("_least"),
        F.max(F.struct(F.bitwise_not("_earliest").alias("_latest"), *types)).alias("_greatest"),
    )
    alone = F.struct(*[F.col(f"_least.{c}") for c in types]) == F.struct(
        *[F.col(f"_greatest.{c}") for c in types]
    )
    tied = cut_lineage(
        by_tag.where(~alone).select(
            F.col("device_id").alias("_device"), F.col("field").alias("_field"), "_least._earliest"
        )
    )
    candidates = timed.join(
        tied,
        F.col("device_id").eqNullSafe(F.col("_device"))
        & (F.col("field") == F.col("_field"))
        & (F.col("_micros") == F.col("_earliest")),
        "left_semi",
    )
    ordered = candidates.groupBy("device_id", "field").agg(
        F.min_by(F.struct(*types), F.struct(*ARRIVAL)).alias("first")
    )
    first = by_tag.where(alone).select(
        "device_id", "field", F.struct(*[F.col(f"_least.{c}") for c in types]).alias("first")
    ).unionByName(ordered)
    return first.select(
        "device_id",
        F.col("field").alias("tag_name"),
        tag_type(F.col("first.value_kind")).alias("data_type"),
        "first.sensor_type",
        "first.data_structure_type",
    )


def with_catalog(candidates: DataFrame, catalog: DataFrame) -> DataFrame:
    """Left lookup of field definitions by (sensor type, structure, field).

    The catalog's structure type is text and the header's a number: they are
    compared as decimal text, so ``01`` never matches, and only where both
    header numbers are positive.
    """
    definitions = catalog.select(
        F.col("sensor_type").cast("bigint").alias("sensor_type"),
        F.col("data_structure_type").alias("_structure"),
        F.col("field_name").alias("tag_name"),
        "field_type",
        "units",
        F.col("description").alias("_description"),
        *([F.col("raw_definition")] if "raw_definition" in catalog.columns else []),
    )
    structure = F.when(
        (F.col("sensor_type") > 0) & (F.col("data_structure_type") > 0),
        F.col("data_structure_type").cast("string"),
    )
    hit = F.col("_structure").isNotNull()
    raw = (
        F.col("raw_definition")
        if "raw_definition" in catalog.columns
        else F.lit(None).cast("map<string,variant>")
    )
    joined = candidates.withColumn("_wanted", structure).join(
        definitions.withColumnRenamed("sensor_type", "_sensor_type").withColumnRenamed(
            "tag_name", "_tag_name"
        ),
        (F.col("sensor_type") == F.col("_sensor_type"))
        & (F.col("_wanted") == F.col("_structure"))
        & (F.col("tag_name") == F.col("_tag_name")),
        "left",
    )
    return joined.withColumns(
        {
            "unit": F.when(hit, F.coalesce("units", F.lit(""))),
            "description": F.when(hit, F.coalesce("_description", F.lit(""))),
            "metadata": F.when(
                hit,
                tag_metadata(
                    F.col("field_type"), F.col("_structure"), F.col("_sensor_type"), raw
                ),
            ),
        }
    ).drop(
        "_wanted", "_structure", "_sensor_type", "_tag_name", "field_type", "units",
        "_description", "raw_definition",
    )


def tag_metadata(field_type: Column, structure: Column, sensor_type: Column, raw: Column) -> Column:
    """Catalog facts and the raw field definition as one JSON object; raw wins."""
    base = F.create_map(
        F.lit("data_structure_type"), structure.cast("variant"),
        F.lit("field_type"), field_type.cast("variant"),
        F.lit("sensor_type"), sensor_type.cast("variant"),
    )
    return merge_json(base, raw)


def new_tag_rows(seen: DataFrame, tags: DataFrame, catalog: DataFrame) -> DataFrame:
    """(device_id, tag_name, data_type, unit, description, metadata) of unseen tags."""
    unseen = seen.join(tags.select("device_id", "tag_name"), ["device_id", "tag_name"], "left_anti")
    return with_catalog(unseen, catalog).select(
        "device_id", "tag_name", "data_type", "unit", "description", "metadata"
    )


def with_tag(points: DataFrame, tags: DataFrame) -> DataFrame:
    """Left lookup of the tag of a point: adds ``tag_id`` and ``data_type``."""
    lookup = tags.select(
        "device_id", F.col("tag_name").alias("field"), F.col("id").alias("tag_id"), "data_type"
    )
    return points.join(lookup, ["device_id", "field"], "left")


def route(kind: Column, data_type: Column, number: Column) -> Column:
    """Record kind of a value under its tag's type, NULL when it must be dropped."""
    finite = ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
    return (
        F.when(kind == "null", "null")
        .when(data_type.isin(NUMERIC_TYPES) & (kind == "number") & finite, "numeric")
        .when(data_type.isin(TEXT_TYPES) & (kind == "string"), "text")
    )


def rejection(kind: Column, data_type: Column) -> Column:
    """Why a value was dropped."""
    return (
        F.when(
            data_type.isin(NUMERIC_TYPES),
            F.concat(F.lit("unsupported numeric type for value: "), kind),
        )
        .when(data_type.isin(TEXT_TYPES), F.concat(F.lit("expected string value, got "), kind))
        .otherwise(F.concat(F.lit("unknown data type: "), F.coalesce(data_type, F.lit(""))))
    )


def route_records(points: DataFrame) -> DataFrame:
    """Add ``kind`` (numeric, text, null or rejected) and ``reason`` for rejected values."""
    kind = route(F.col("value_kind"), F.col("data_type"), F.col("num_value"))
    routed = points.withColumn("kind", F.coalesce(kind, F.lit("rejected")))
    return routed.withColumn(
        "reason",
        F.when(F.col("kind") == "rejected", rejection(F.col("value_kind"), F.col("data_type"))),
    )


def accepted_records(routed: DataFrame) -> DataFrame:
    """First arrival per (kind, tag, ts), in the layout of the fact table."""
    narrow = routed.where(F.col("kind") != "rejected").select(
        "kind",
        "tag_id",
        "ts",
        F.when(F.col("kind") == "numeric", F.col("num_value")).alias("num_value"),
        F.when(F.col("kind") == "text", F.col("text_value")).alias("text_value"),
        *ARRIVAL,
    )
    winners = first_wins(
        narrow, RECORD_KEYS, F.struct(*ARRIVAL), keep=["num_value", "text_value"]
    )
    return winners.select(
        "tag_id", "ts", "num_value", "text_value", "kind", record_date(F.col("ts")).alias("dt")
    )


def unrecorded(records: DataFrame, stored: DataFrame) -> DataFrame:
    """Records whose (kind, tag, ts) is not stored yet: insert-if-absent.

    The join keys are exactly the keys of :func:`accepted_records`, so its
    partitioning is reused.
    """
    return records.join(stored.select(*RECORD_KEYS), RECORD_KEYS, "left_anti").select(
        *records.columns
    )


def records_numeric(records: DataFrame) -> DataFrame:
    return records.where(F.col("kind") == "numeric").select(
        "tag_id", F.col("num_value").alias("value"), "ts", "dt"
    )


def records_text(records: DataFrame) -> DataFrame:
    return records.where(F.col("kind") == "text").select(
        "tag_id", F.col("text_value").alias("value"), "ts", "dt"
    )


def records_null(records: DataFrame) -> DataFrame:
    return records.where(F.col("kind") == "null").select("tag_id", "ts", "dt")


def records_view(records: DataFrame) -> DataFrame:
    """Every record with its value as text and its kind as ``value_type``."""
    return records.select(
        "tag_id",
        F.when(F.col("kind") == "numeric", numeric_text(F.col("num_value")))
        .when(F.col("kind") == "text", F.col("text_value"))
        .alias("value"),
        F.col("kind").alias("value_type"),
        "ts",
        "dt",
    )


def union_records(numeric: DataFrame, text: DataFrame, null: DataFrame) -> DataFrame:
    """The fact-table layout out of three separately held typed tables."""
    def shaped(df: DataFrame, kind: str, num: Column, txt: Column) -> DataFrame:
        return df.select(
            F.col("tag_id").cast("bigint").alias("tag_id"),
            F.col("ts").cast("bigint").alias("ts"),
            num.cast("double").alias("num_value"),
            txt.cast("string").alias("text_value"),
            F.lit(kind).alias("kind"),
            record_date(F.col("ts")).alias("dt"),
        )

    none = F.lit(None)
    return (
        shaped(numeric, "numeric", F.col("value"), none)
        .unionByName(shaped(text, "text", none, F.col("value")))
        .unionByName(shaped(null, "null", none, none))
    )
