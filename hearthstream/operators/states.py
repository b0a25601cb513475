"""Smart-home states: filtering, change detection, classification, commands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthstream.functions import as_text, nullif_empty, strip_suffix, text_before, value_kind
from hearthstream.operators.envelope import string_headers
from hearthstream.operators.ordered import previous_row, with_chunk

# Topics, key suffixes, the fallback substring and the source header.
CLIMATE_TOPIC = "homeassistant.ecobee.thermostat.climate"
WEATHER_TOPIC = "homeassistant.ecobee.weather"
TEMPERATURE_TOPIC = "homeassistant.ecobee.sensor.temperature"
HUMIDITY_TOPIC = "homeassistant.ecobee.sensor.humidity"
PRESENCE_TOPIC = "homeassistant.ecobee.sensor.presence"
BATTERY_TOPIC = "homeassistant.ecobee.sensor.battery"
OTHER_TOPIC = "homeassistant.ecobee.other"
KEY_SUFFIXES = {
    TEMPERATURE_TOPIC: "_temperature",
    HUMIDITY_TOPIC: "_humidity",
    PRESENCE_TOPIC: "_occupancy",
    BATTERY_TOPIC: "_battery",
}
PRESENCE_CLASSES = ["occupancy", "presence", "motion"]
FALLBACK_NAME = "ecobee"
EVENT_SOURCE = "homeassistant"

STATE_FIELDS = ["state", "last_changed", "last_updated"]


def discover_entities(registry: DataFrame, platform: str) -> DataFrame:
    """Entities of a platform; case does not matter."""
    return registry.where(F.lower("platform") == platform.lower()).select("entity_id")


def entity_filter(
    df: DataFrame, explicit: list[str] | None = None, discovered: DataFrame | None = None
) -> DataFrame:
    """Keep wanted entities: an explicit list beats a discovered set beats a substring."""
    if explicit:
        return df.where(F.col("entity_id").isin(explicit))
    if discovered is not None:
        return match_discovered(df, discovered)
    return df.where(F.lower("entity_id").contains(FALLBACK_NAME))


def match_discovered(df: DataFrame, discovered: DataFrame) -> DataFrame:
    return df.join(discovered.select("entity_id"), "entity_id", "left_semi")


def valid_state_events(events: DataFrame) -> DataFrame:
    """Events that name an entity and have a new state; adds ``entity_id``."""
    return events.withColumn(
        "entity_id",
        F.coalesce(
            nullif_empty(F.col("data.entity_id")), nullif_empty(F.col("data.new_state.entity_id"))
        ),
    ).where(F.col("entity_id").isNotNull() & F.col("data.new_state").isNotNull())


def entity_domain(entity_id: Column) -> Column:
    return text_before(entity_id, ".")


def _attribute(attributes: Column, name: str) -> Column:
    """A text attribute in lower case, '' when absent or not text."""
    value = F.try_element_at(attributes, F.lit(name))
    return F.coalesce(F.when(value_kind(value) == "string", F.lower(as_text(value))), F.lit(""))


def entity_topic(entity_id: Column, attributes: Column) -> Column:
    """Topic of a state by domain, device class, unit and name.

    Battery is tested before temperature before humidity, so a battery in
    percent is not a humidity.
    """
    domain = entity_domain(entity_id)
    device_class = _attribute(attributes, "device_class")
    unit = _attribute(attributes, "unit_of_measurement")
    name = F.lower(entity_id)
    battery = (device_class == "battery") | name.contains("battery")
    temperature = (device_class == "temperature") | unit.contains("°") | unit.isin("f", "c")
    humidity = (device_class == "humidity") | (unit == "%")
    presence = (
        device_class.isin(PRESENCE_CLASSES) | name.contains("occupancy") | name.contains("presence")
    )
    return (
        F.when(domain == "climate", CLIMATE_TOPIC)
        .when(domain == "weather", WEATHER_TOPIC)
        .when((domain == "sensor") & battery, BATTERY_TOPIC)
        .when((domain == "sensor") & temperature, TEMPERATURE_TOPIC)
        .when((domain == "sensor") & humidity, HUMIDITY_TOPIC)
        .when((domain == "binary_sensor") & presence, PRESENCE_TOPIC)
        .otherwise(OTHER_TOPIC)
    )


def entity_key(entity_id: Column, topic: Column) -> Column:
    """The name without its domain and without a suffix its topic already says."""
    dot = F.instr(entity_id, ".")
    name = F.when(dot > 0, F.substring(entity_id, dot + 1, F.length(entity_id))).otherwise(entity_id)
    short = None
    for t, suffix in KEY_SUFFIXES.items():
        value = strip_suffix(name, suffix)
        short = F.when(topic == t, value) if short is None else short.when(topic == t, value)
    return short.otherwise(name)


def fired_epoch(time_fired: Column, now: Column) -> Column:
    """RFC 3339 text as epoch seconds, else the processing time."""
    shape = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})\z"
    # Nanoseconds are cut to what a timestamp holds.
    trimmed = F.regexp_replace(time_fired, r"(\.\d{6})\d+", "$1")
    return F.coalesce(
        F.when(time_fired.rlike(shape), F.unix_timestamp(F.try_to_timestamp(trimmed))), now
    )


def state_event_messages(events: DataFrame, now: Column) -> DataFrame:
    """State-change events to routed messages with six headers; the body stays raw.

    ``events`` has the parsed columns, ``entity_id`` and the ``raw`` text.
    """
    routed = events.withColumns(
        {
            "topic": entity_topic(F.col("entity_id"), F.col("data.new_state.attributes")),
            "epoch": fired_epoch(F.col("time_fired"), now),
        }
    )
    return routed.select(
        "topic",
        F.concat_ws(":", entity_key(F.col("entity_id"), F.col("topic")), "epoch").alias("key"),
        F.col("raw").cast("binary").alias("value"),
        string_headers(
            schema_version="1",
            entity_id=F.col("entity_id"),
            domain=entity_domain(F.col("entity_id")),
            timestamp=F.col("epoch"),
            source=EVENT_SOURCE,
            event_type=F.col("event_type"),
        ).alias("headers"),
    )


def _differs(new: str, old: str) -> Column:
    changed = F.lit(False)
    for c in STATE_FIELDS:
        changed = changed | ~F.col(f"{new}{c}").eqNullSafe(F.col(f"{old}{c}"))
    return changed


def state_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Entities of the current snapshot that are new or changed, with both states."""
    old = previous.select(
        "entity_id",
        F.struct(*[c for c in previous.columns if c != "entity_id"]).alias("old_state"),
    )
    joined = current.join(old, "entity_id", "left")
    return joined.where(F.col("old_state").isNull() | _differs("", "old_state."))


def as_state_changed(changes: DataFrame, now: Column) -> DataFrame:
    """Changes wrapped as polling events of type ``state_changed``."""
    old = F.when(F.col("old_state").isNotNull(), F.struct("entity_id", "old_state.*"))
    new = F.struct("entity_id", *[c for c in changes.columns if c not in ("entity_id", "old_state")])
    return changes.select(
        F.lit("state_changed").alias("event_type"),
        F.struct("entity_id", old.alias("old_state"), new.alias("new_state")).alias("data"),
        F.lit("polling").alias("origin"),
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time_fired"),
        "entity_id",
    )


def state_change_log(
    states: DataFrame, order: list[str], position: Column, chunk: int = 3600
) -> DataFrame:
    """Every polled state that differs from the entity's previous one.

    ``position`` is a number that grows with ``order`` (poll time in seconds).
    A busy entity is scanned in chunks of it, not in one task.
    """
    chunked = with_chunk(states, position, chunk)
    values = [c for c in states.columns if c != "entity_id"]
    with_old = previous_row(chunked, ["entity_id"], order, values, "old_state").drop("_chunk")
    return with_old.where(F.col("old_state").isNull() | _differs("", "old_state."))


def entities_by_domain(entities: DataFrame) -> DataFrame:
    """Entities per domain, and whether any of them is a battery."""
    return entities.groupBy(entity_domain(F.col("entity_id")).alias("domain")).agg(
        F.count(F.lit(1)).alias("entities"),
        F.bool_or(F.lower("entity_id").contains("battery")).alias("has_battery"),
    )
