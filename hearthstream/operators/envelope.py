"""Message envelopes: headers, bodies, melting and the publishing form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthstream.functions import enveloped, integer_or_zero, only_value

# Arrival order of messages.  Offsets order one partition; the broker timestamp
# orders partitions among each other; the rest only breaks ties.
ARRIVAL = ["timestamp", "topic", "partition", "offset"]

MISSING_LSID = "missing lsid in message headers"


def arrival_order() -> Column:
    return F.struct(*ARRIVAL)


def _named(headers: Column, name: str) -> Column:
    return F.filter(headers, lambda h: h["key"] == name)


def header(name: str, headers: str = "headers") -> Column:
    """Value of the first header of that name, '' when absent."""
    return F.coalesce(
        F.get(_named(F.col(headers), name), F.lit(0))["value"].cast("string"), F.lit("")
    )


def last_header(name: str, headers: str = "headers") -> Column:
    """Value of the last header of that name, NULL when absent."""
    return F.try_element_at(_named(F.col(headers), name), F.lit(-1))["value"].cast("string")


def with_header_columns(messages: DataFrame) -> DataFrame:
    """Add ``lsid``, ``record_ts``, ``sensor_type`` and ``data_structure_type``."""
    names = {
        "lsid": "lsid",
        "record_ts": "timestamp",
        "sensor_type": "sensor_type",
        "data_structure_type": "data_structure_type",
    }
    # Two steps, so that each header is searched once and not once per use.
    texts = messages.withColumns({f"_{c}": last_header(h) for c, h in names.items()})
    return texts.withColumns({c: integer_or_zero(F.col(f"_{c}")) for c in names}).drop(
        *[f"_{c}" for c in names]
    )


def lsid_problem() -> Column:
    """The reason of a message without a device number, NULL for a usable one."""
    return F.when(F.col("lsid") == 0, MISSING_LSID)


def split_missing_lsid(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected): a message without a device number is an error, not an orphan."""
    judged = messages.withColumn("reason", lsid_problem())
    return (
        judged.where(F.col("reason").isNull()).drop("reason"),
        judged.where(F.col("reason").isNotNull()),
    )


def parse_body(messages: DataFrame) -> DataFrame:
    """Add ``body`` (VARIANT) and ``parse_error``.

    Only an object is a body.  The literal ``null`` is an empty one: no error,
    no fields.
    """
    text = F.col("value").cast("string")
    # One-element explode: later filters and projections then refer to the parsed
    # value instead of each repeating the parse.
    parsed = messages.withColumn("_envelope", F.explode(F.array(enveloped(text))))
    body = only_value(F.col("_envelope"))
    is_body = text.rlike(r"\A\s*(\{|null\s*\z)")
    return parsed.withColumns(
        {
            "body": body,
            "parse_error": ~F.coalesce(is_body & body.isNotNull(), F.lit(False)),
        }
    ).drop("_envelope")


def melt_fields(parsed: DataFrame) -> DataFrame:
    """One row per body field except ``ts``: adds ``field`` and ``field_value``."""
    exploded = parsed.lateralJoin(
        parsed.sparkSession.tvf.variant_explode(F.col("body").outer()).select(
            F.col("key").alias("field"), F.col("value").alias("field_value")
        )
    )
    return exploded.where(F.col("field") != "ts").drop("body")


def string_headers(**values: Column | str) -> Column:
    """Headers as the envelope stores them: array<struct<key, value binary>>."""
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("key"),
                (F.lit(v) if isinstance(v, str) else v.cast("string"))
                .cast("binary")
                .alias("value"),
            )
            for name, v in values.items()
        ]
    )


def record_headers(lsid: Column, ts: Column, sensor_type: Column, structure: Column) -> Column:
    """The five headers of a data message."""
    return string_headers(
        schema_version="1",
        lsid=lsid,
        timestamp=ts,
        sensor_type=sensor_type,
        data_structure_type=structure,
    )


def headers_map(headers: Column) -> Column:
    """Headers as map<string,string>; the last duplicate wins."""
    return F.map_from_entries(
        F.transform(
            headers, lambda h: F.struct(h["key"], h["value"].cast("string").alias("value"))
        )
    )


def to_messages(df: DataFrame, topic: Column, key: Column, body: Column, headers: Column) -> DataFrame:
    """The publishing form: topic, key, value, headers."""
    return df.select(
        topic.alias("topic"),
        key.alias("key"),
        body.cast("binary").alias("value"),
        headers.alias("headers"),
    )


def data_topics(topic: Column) -> Column:
    """True for record topics: below ``weather.`` but not ``weather.metadata.``."""
    return topic.rlike(r"\Aweather\.(?!metadata\.).+")


# The same rule for the Kafka source's subscribePattern option.
DATA_TOPIC_PATTERN = r"weather\.(?!metadata\.).+"


def offset_range(messages: DataFrame, start: int, end: int) -> DataFrame:
    """Bounded replay of an envelope table.

    ``start`` -2 or 0 is the earliest offset, -1 the latest, anything else
    exact; ``end`` >= 0 is exclusive, -1 leaves the range open.
    """
    if start == -1:
        return messages.where(F.lit(False))
    ranged = messages
    if start not in (-2, 0):
        ranged = ranged.where(F.col("offset") >= start)
    if end >= 0:
        ranged = ranged.where(F.col("offset") < end)
    return ranged
