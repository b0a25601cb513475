"""Kafka source and sink options.

Needs the spark-sql-kafka package on the classpath of the cluster; everything
downstream only sees the envelope schema, which the file source shares.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthstream import schemas
from hearthstream.operators.envelope import DATA_TOPIC_PATTERN

# Fixed values of the publisher.
PRODUCER_OPTIONS = {
    "kafka.compression.type": "lz4",
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.max.in.flight.requests.per.connection": "5",
    "kafka.linger.ms": "50",
    "kafka.batch.size": "100000",
    "kafka.request.timeout.ms": "30000",
    "kafka.delivery.timeout.ms": "120000",
}


def source_options(broker: str, topics: list[str] | None = None) -> dict[str, str]:
    """Options for the named topics, or for all data topics by pattern."""
    options = {"kafka.bootstrap.servers": broker, "includeHeaders": "true"}
    if topics is None:
        options["subscribePattern"] = DATA_TOPIC_PATTERN
    else:
        options["subscribe"] = ",".join(topics)
    return options


def offset_options(
    topics: list[str], start: int, end: int, partitions: list[int] | dict[str, list[int]]
) -> dict[str, str]:
    """Bounded-read options for an offset range of the given partitions.

    ``start`` -2 or 0 is the earliest, -1 the latest; ``end`` >= 0 is exclusive,
    -1 the latest.  ``partitions`` are the same for every topic, or listed by topic;
    a topic without partitions is left out.
    """
    at_start = -2 if start == 0 else start
    at_end = -1 if end < 0 else end
    listed = partitions if isinstance(partitions, dict) else {t: partitions for t in topics}
    wanted = {t: sorted(listed[t]) for t in topics if listed.get(t)}
    return {
        "assign": json.dumps(wanted),
        "startingOffsets": json.dumps({t: {str(p): at_start for p in ps} for t, ps in wanted.items()}),
        "endingOffsets": json.dumps({t: {str(p): at_end for p in ps} for t, ps in wanted.items()}),
    }


def partitions_of(spark: SparkSession, broker: str, topics: list[str]) -> dict[str, list[int]]:
    """The partitions that the broker has of each topic; a topic it does not know has none."""
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    settings.put("bootstrap.servers", broker)
    admin = jvm.org.apache.kafka.clients.admin.AdminClient.create(settings)
    try:
        known = admin.listTopics().names().get()
        wanted = jvm.java.util.ArrayList()
        for t in topics:
            if known.contains(t):
                wanted.add(t)
        described = admin.describeTopics(wanted).allTopicNames().get()
        return {
            t: [p.partition() for p in described.get(t).partitions()] if described.containsKey(t) else []
            for t in topics
        }
    finally:
        admin.close()


def _envelope(df: DataFrame) -> DataFrame:
    return df.select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        "headers",
        "value",
        "timestamp",
    )


def read_messages(
    spark: SparkSession,
    broker: str,
    topics: list[str] | None = None,
    stream: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Envelope rows of the topics, bounded or as a stream."""
    reader = spark.readStream if stream else spark.read
    reader = reader.format("kafka").options(**source_options(broker, topics))
    if stream and max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return _envelope(reader.load())


def read_offset_range(
    spark: SparkSession,
    broker: str,
    topics: list[str],
    start: int,
    end: int,
    partitions: list[int] | dict[str, list[int]] | None = None,
    resolve: Callable[[SparkSession, str, list[str]], dict[str, list[int]]] = partitions_of,
) -> DataFrame:
    """Envelope rows of an offset range of all (or the given) partitions.

    The partitions are looked up once, before the read, so that every one gets its own
    bounds and nothing outside of them is fetched.
    """
    if partitions is None:
        partitions = resolve(spark, broker, topics)
    bounds = offset_options(topics, start, end, partitions)
    if bounds["assign"] == "{}":
        return schemas.empty(spark, schemas.MESSAGE_DDL)
    options = {"kafka.bootstrap.servers": broker, "includeHeaders": "true"} | bounds
    return _envelope(spark.read.format("kafka").options(**options).load())


def published_keys(spark: SparkSession, broker: str, topics: list[str]) -> DataFrame:
    """Distinct non-empty keys up to the present end offsets."""
    from hearthstream.sources.files import distinct_keys

    options = source_options(broker, topics) | {
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }
    return distinct_keys(_envelope(spark.read.format("kafka").options(**options).load()))


def publish(messages: DataFrame, broker: str) -> None:
    """Write messages in publishing form to Kafka; the topic is a column."""
    messages.write.format("kafka").options(**PRODUCER_OPTIONS).option(
        "kafka.bootstrap.servers", broker
    ).option("includeHeaders", "true").save()
