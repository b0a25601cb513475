"""Commands: validation and the service-call payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthstream import schemas
from hearthstream.functions import nullif_empty, parse_json_value, value_kind
from hearthstream.functions.documents import has_kind_or_none, with_once

UNREADABLE = "failed to parse command"


def judge_commands(messages: DataFrame, column: str = "value") -> DataFrame:
    """Add ``command`` and ``reason`` (NULL for a valid command).

    Unreadable bodies come first, then the first missing one of domain, service
    and entity id.
    """
    body = F.col(column).cast("string")
    parsed = with_once(messages, "_document", parse_json_value(body))
    document = F.col("_document")
    parsed = with_once(parsed, "_kind", value_kind(document))
    parsed = with_once(parsed, "command", F.from_json(body, schemas.COMMAND_DDL))
    missing = F.lit(None).cast("string")
    for name in ("entity_id", "service", "domain"):
        absent = nullif_empty(F.col(f"command.{name}")).isNull()
        missing = F.when(absent, f"{name} is required").otherwise(missing)
    # A field of the wrong kind makes the whole body unreadable.
    readable = F.coalesce(F.col("_kind").isin("object", "null"), F.lit(False))
    for name in ("domain", "service", "entity_id"):
        readable = readable & has_kind_or_none(document, name, "string")
    readable = readable & has_kind_or_none(document, "data", "object")
    return parsed.withColumn(
        "reason", F.when(~readable, F.lit(UNREADABLE)).otherwise(missing)
    ).drop("_kind", "_document")


def validate_commands(messages: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(valid, invalid with reason)."""
    judged = judge_commands(messages, column)
    return (
        judged.where(F.col("reason").isNull()).drop("reason"),
        judged.where(F.col("reason").isNotNull()).drop("command"),
    )


def service_call_payload(command: Column) -> Column:
    """The call as JSON; ``service_data`` only when there is any."""
    data = F.when(F.size(command["data"]) > 0, command["data"])
    return F.to_json(
        F.struct(
            F.lit("call_service").alias("type"),
            command["domain"].alias("domain"),
            command["service"].alias("service"),
            F.struct(command["entity_id"].alias("entity_id")).alias("target"),
            data.alias("service_data"),
        )
    )


# Climate services and the data field each one sets.
CLIMATE_FIELDS = {
    "set_temperature": "temperature",
    "set_hvac_mode": "hvac_mode",
    "set_preset_mode": "preset_mode",
    "set_fan_mode": "fan_mode",
}
CLIMATE_SWITCHES = ["turn_on", "turn_off"]


def climate_command(service: Column, value: Column, entity_id: Column) -> Column:
    """Command JSON of a climate service, NULL for an unknown one or a missing value."""
    given = nullif_empty(value)

    def command(data: Column) -> Column:
        return F.to_json(
            F.struct(
                F.lit("climate").alias("domain"),
                service.alias("service"),
                entity_id.alias("entity_id"),
                data.alias("data"),
            )
        )

    def with_field(name: str) -> Column:
        # The temperature is written as a bare number, the modes as text.
        typed = F.try_parse_json(given) if name == "temperature" else given.cast("variant")
        return F.when(
            given.isNotNull(), command(F.create_map(F.lit(name), typed))
        )

    empty = F.from_json(F.lit("{}"), "map<string,variant>")
    chosen = F.when(service.isin(CLIMATE_SWITCHES), command(empty))
    for name, data_field in CLIMATE_FIELDS.items():
        chosen = chosen.when(service == name, with_field(data_field))
    return chosen
