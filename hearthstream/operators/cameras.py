"""Camera events: unwrapping, classification, naming, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthstream.functions import (
    first_matching,
    millis_to_seconds,
    nullif_empty,
    parse_json_value,
    sanitize_name,
)
from hearthstream.functions.documents import (
    bound,
    has_kind_or_none,
    is_kind,
    is_text_list,
    is_whole_or_none,
    with_once,
)
from hearthstream.operators.envelope import header, string_headers

# Detection types, topics and the source header.
AUDIO_TYPES = ["babyCry", "coAlarm", "smoke", "speak"]
VIDEO_TYPES = ["person", "vehicle", "animal", "package"]
EVENT_TOPICS = {
    "smart": "unifi.protect.smart",
    "audio": "unifi.protect.audio",
    "motion": "unifi.protect.motion",
}
EVENT_SOURCE = "unifi-protect"
FRAME_SOURCE = "unifi-protect-video"


def unwrap_event(raw: DataFrame, column: str = "raw") -> DataFrame:
    """``{type, item}`` envelopes become their item; blank lines are dropped."""
    item = bound(
        F.try_parse_json(F.col(column)), lambda parsed: F.try_variant_get(parsed, "$.item", "variant")
    )
    inner = bound(item, lambda i: F.when(i.isNotNull(), F.to_json(i)))
    return with_once(raw.where(F.col(column).rlike(r"\S")), column, F.coalesce(inner, F.col(column)))


def parse_events(raw: DataFrame, column: str = "raw") -> DataFrame:
    """Typed event columns next to the raw text; NULL struct for unreadable ones."""
    return with_event(raw, F.col(column))


def with_event(df: DataFrame, text: Column) -> DataFrame:
    """Add ``event``: the typed event in a JSON text, parsed once."""
    return with_once(df, "event", bound(parse_json_value(text), event_of))


def event_of(document: Column) -> Column:
    """The typed event of a parsed document, NULL as a whole if any field is of the wrong kind."""
    readable = is_kind(document, "object")
    for name in ("id", "modelKey", "type", "camera", "device"):
        readable = readable & has_kind_or_none(document, name, "string")
    for name in ("start", "end"):
        readable = readable & is_whole_or_none(document, name)
    readable = readable & is_text_list(document, "smartDetectTypes")

    def value(name: str, kind: str = "string") -> Column:
        return F.try_variant_get(document, f"$.{name}", kind).alias(name)

    return F.when(
        readable,
        F.struct(
            value("id"), value("modelKey"), value("type"), value("start", "bigint"), value("end", "bigint"),
            value("smartDetectTypes", "array<string>"), value("camera"), value("device"),
        ),
    )


def only_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event.modelKey") == "event")


def classify_event(types: Column, event_type: Column) -> Column:
    """struct(category, detection_type), NULL for an event of no interest.

    The first known detection type in array order decides; only then does a
    ``type`` containing "motion" count.
    """
    known = first_matching(types, AUDIO_TYPES + VIDEO_TYPES)
    audio = F.struct(F.lit("audio").alias("category"), known.alias("detection_type"))
    smart = F.struct(F.lit("smart").alias("category"), known.alias("detection_type"))
    motion = F.struct(
        F.lit("motion").alias("category"), F.lit("motion").alias("detection_type")
    )
    return (
        F.when(known.isin(AUDIO_TYPES), audio)
        .when(known.isin(VIDEO_TYPES), smart)
        .when(F.lower(event_type).contains("motion"), motion)
    )


def event_topic(category: Column) -> Column:
    return (
        F.when(category == "smart", EVENT_TOPICS["smart"])
        .when(category == "audio", EVENT_TOPICS["audio"])
        .otherwise(EVENT_TOPICS["motion"])
    )


def event_device(device: Column, camera: Column) -> Column:
    return F.coalesce(nullif_empty(device), camera, F.lit(""))


def event_epoch(start_ms: Column, end_ms: Column, now: Column) -> Column:
    """Start of the event in seconds, else its end, else the processing time."""
    return (
        F.when(start_ms > 0, millis_to_seconds(start_ms))
        .when(end_ms > 0, millis_to_seconds(end_ms))
        .otherwise(now)
    )


def with_camera_name(events: DataFrame, cameras: DataFrame, id_column: str = "camera_id") -> DataFrame:
    """Add ``camera_name``: the sanitized name, or the id of an unknown camera."""
    lookup = cameras.select(F.col("id").alias(id_column), F.col("name").alias("_name"))
    return (
        events.join(lookup, id_column, "left")
        .withColumn("camera_name", F.coalesce(sanitize_name(F.col("_name")), F.col(id_column)))
        .drop("_name")
    )


def camera_event_messages(raw: DataFrame, cameras: DataFrame, now: Column) -> DataFrame:
    """Raw event lines to routed messages with key ``camera:epoch`` and seven headers."""
    events = only_events(parse_events(unwrap_event(raw)))
    classified = events.withColumns(
        {
            "class": classify_event(F.col("event.smartDetectTypes"), F.col("event.type")),
            "camera_id": event_device(F.col("event.device"), F.col("event.camera")),
            "epoch": event_epoch(F.col("event.start"), F.col("event.end"), now),
        }
    ).where(F.col("class").isNotNull())
    named = with_camera_name(classified, cameras)
    return named.select(
        event_topic(F.col("class.category")).alias("topic"),
        F.concat_ws(":", "camera_name", "epoch").alias("key"),
        F.col("raw").cast("binary").alias("value"),
        string_headers(
            schema_version="1",
            camera_id=F.col("camera_id"),
            camera_name=F.col("camera_name"),
            event_type=F.col("class.category"),
            detection_type=F.col("class.detection_type"),
            timestamp=F.col("epoch"),
            source=EVENT_SOURCE,
        ).alias("headers"),
    )


def archive_events(messages: DataFrame) -> DataFrame:
    """Events to archive, out of routed messages.

    The camera comes from its header, else from the key before the colon.  The
    detection type is the first array element even if unknown, else the header,
    else ``unknown`` (a different rule than :func:`classify_event`).  Events
    without id, start or camera are dropped.
    """
    from_key = F.when(F.instr("key", ":") > 1, F.substring_index("key", ":", 1))
    parsed = with_event(messages, F.col("value").cast("string")).withColumns(
        {
            "camera": F.coalesce(nullif_empty(header("camera_name")), from_key),
            "detection_type": F.coalesce(
                nullif_empty(F.get("event.smartDetectTypes", F.lit(0))),
                nullif_empty(header("detection_type")),
                F.lit("unknown"),
            ),
        }
    )
    return parsed.where(
        (F.col("event.id") != "")
        & (F.col("event.start") > 0)
        & F.col("camera").isNotNull()
    ).select(
        sanitize_name(F.col("camera")).alias("camera"),
        sanitize_name(F.col("detection_type")).alias("detection_type"),
        F.col("event.id").alias("event_id"),
        F.col("event.start").alias("start_ms"),
        F.when(F.col("event.end") > 0, F.col("event.end")).alias("end_ms"),
        F.col("timestamp").alias("arrived_at"),
        F.unix_timestamp("timestamp").alias("arrival"),
    )


def only_connected(cameras: DataFrame) -> DataFrame:
    return cameras.where(F.col("state") == "CONNECTED")


def cameras_by_state(cameras: DataFrame) -> DataFrame:
    """One row: cameras in all, online and offline."""
    online = F.coalesce(F.col("state") == "CONNECTED", F.lit(False))
    return cameras.agg(
        F.count(F.lit(1)).alias("cameras"),
        F.count_if(online).alias("online"),
        F.count_if(~online).alias("offline"),
    )


def frame_messages(frames: DataFrame, topic: Column) -> DataFrame:
    """Binary frames in publishing form: key ``camera_id:ts`` and six headers."""
    return frames.select(
        topic.alias("topic"),
        F.concat_ws(":", "camera_id", "ts").alias("key"),
        F.col("content").alias("value"),
        string_headers(
            schema_version="1",
            camera_id=F.col("camera_id"),
            camera_name=F.col("camera_name"),
            timestamp=F.col("ts"),
            source=FRAME_SOURCE,
            content_type="image/jpeg",
        ).alias("headers"),
    )


def frames_from_messages(messages: DataFrame) -> DataFrame:
    """Frame rows out of a frame topic; a key without a time is dropped."""
    return (
        messages.select(
            header("camera_name").alias("camera"),
            F.substring_index("key", ":", -1).try_cast("bigint").alias("ts"),
            F.concat_ws("/", "topic", "partition", "offset").alias("path"),
            F.col("value").alias("content"),
        )
        .where(F.col("ts").isNotNull())
    )
