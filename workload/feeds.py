"""The model's tables, derived from the benchmark tables by Spark.

:mod:`workload.twins` defines the same tables in SQL.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthstream import schemas
from hearthstream.operators.envelope import record_headers
from hearthstream.plans.materialize import batch_tables

NOW = "2026-01-01 00:00:00"
NOW_EPOCH = 1767225600


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with their epoch second, sensor type and structure type."""
    return table(spark, sf, "events").withColumns(
        {
            "hts": F.unix_timestamp("ts"),
            "k": F.get_json_object("props", "$.k").cast("bigint"),
            "sensor_type": sensor_type(F.col("event_type")),
            "dst": (1 + F.col("user_id") % 2).cast("int"),
        }
    )


def sensor_type(event_type: Column) -> Column:
    return (
        F.when(event_type == "click", 1)
        .when(event_type == "view", 2)
        .when(event_type == "purchase", 3)
        .when(event_type == "signup", 4)
        .otherwise(5)
    )


def as_messages(ev: DataFrame, offset: Column, value: Column) -> DataFrame:
    body = F.to_json(
        F.struct(
            F.col("hts").alias("ts"),
            value.alias("value"),
            F.col("event_type").alias("kind"),
            "k",
            (F.col("event_id") % 2 == 0).alias("flag"),
            F.when(
                F.col("event_id") % 5 != 0,
                F.concat(F.lit("n"), (F.col("event_id") % 3).cast("string")),
            ).alias("note"),
        ),
        {"ignoreNullFields": "false"},
    )
    return ev.select(
        F.concat(F.lit("events."), "event_type").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        offset.alias("offset"),
        F.concat_ws(":", "user_id", "hts").alias("key"),
        record_headers(
            F.col("user_id"), F.col("hts"), F.col("sensor_type"), F.col("dst")
        ).alias("headers"),
        body.cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """One record message per event.  User 0 has no valid device number."""
    return as_messages(events(spark, sf), F.col("event_id"), F.col("value"))


def duplicated_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages and, for every tenth event, a later copy with another value."""
    ev = events(spark, sf)
    again = as_messages(
        ev.where("event_id % 10 = 0"), F.col("event_id") + 1000000000, F.col("value") + 1
    )
    return as_messages(ev, F.col("event_id"), F.col("value")).unionByName(again)


def category(user_id: Column) -> Column:
    return (
        F.when(user_id % 5 == 0, "ISS")
        .when(user_id % 5 == 1, "Barometer")
        .when(user_id % 5 == 2, "Inside Temp/Hum")
        .when(user_id % 5 == 3, "HEALTH")
        .otherwise("Other")
    )


def devices(spark: SparkSession, sf: str) -> DataFrame:
    """A device per known user; the id is the device number."""
    users = (
        table(spark, sf, "events")
        .where("user_id % 7 <> 3 and user_id > 0")
        .select("user_id")
        .distinct()
    )
    user = F.col("user_id")
    known = users.select(
        user.alias("id"),
        user.alias("lsid"),
        (1 + user % 5).cast("int").alias("sensor_type"),
        category(user).alias("category"),
        F.lit("maker").alias("manufacturer"),
        F.concat(F.lit("product "), (user % 4).cast("string")).alias("product_name"),
        F.when(user % 3 != 0, user % 3).cast("int").alias("station_id"),
        F.lit("").alias("station_name"),
        F.when(user % 2 == 0, 1).cast("int").alias("rt_data_structure_type"),
        F.lit("2024-01-01").cast("timestamp").alias("created_at"),
        F.lit("2024-01-01").cast("timestamp").alias("updated_at"),
    )
    return schemas.empty(spark, schemas.DEVICES_DDL).unionByName(known, allowMissingColumns=True)


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Field definitions of structure 1 for the first four sensor types."""
    fields = F.array(
        *[
            F.struct(
                F.lit(n).alias("field_name"), F.lit(t).alias("field_type"), F.lit(u).alias("units")
            )
            for n, t, u in (("value", "float", "USD"), ("k", "integer", ""), ("kind", "string", "name"))
        ]
    )
    kinds = events(spark, sf).where("sensor_type <= 4").select("sensor_type", "event_type").distinct()
    entries = kinds.select(
        "sensor_type",
        F.lit("1").alias("data_structure_type"),
        F.concat(F.lit("structure of "), "event_type").alias("description"),
        F.inline(fields),
    )
    return schemas.empty(spark, schemas.CATALOG_DDL).unionByName(entries, allowMissingColumns=True)


_built: dict[tuple[str, str, bool], dict[str, DataFrame]] = {}


def built(spark: SparkSession, sf: str, duplicated: bool = False) -> dict[str, DataFrame]:
    """Tags, records, rejected values, orphans and errors of a first run.

    The tag table is written once per application; everything else is lazy.
    """
    key = (spark.sparkContext.applicationId, sf, duplicated)
    if key not in _built:
        source = duplicated_messages if duplicated else messages
        _built[key] = batch_tables(
            source(spark, sf),
            devices(spark, sf),
            schemas.empty(spark, schemas.TAGS_DDL),
            catalog(spark, sf),
            replay=True,
            now=now(),
        )
    return _built[key]


def states(spark: SparkSession, sf: str) -> DataFrame:
    """Polled states of one entity per user and event type."""
    suffix = (
        F.when(F.col("event_type") == "click", "_temperature")
        .when(F.col("event_type") == "view", "_humidity")
        .when(F.col("event_type") == "purchase", "_battery")
        .when(F.col("event_type") == "signup", "_ecobee")
        .otherwise("")
    )
    domain = (
        F.when(F.col("user_id") % 6 == 0, "climate.")
        .when(F.col("user_id") % 6 == 1, "weather.")
        .when(F.col("user_id") % 6 == 2, "binary_sensor.")
        .when(F.col("user_id") % 6 == 3, "")
        .otherwise("sensor.")
    )
    return events(spark, sf).select(
        F.concat(domain, F.lit("user_"), F.col("user_id").cast("string"), suffix).alias("entity_id"),
        F.floor(F.col("value") / 50).cast("string").alias("state"),
        F.floor(F.col("value") / 100).cast("string").alias("last_changed"),
        F.lit("x").alias("last_updated"),
        F.col("hts").alias("polled_at"),
        "event_id",
        "k",
    )


def detect_types() -> Column:
    """Arrays with known, unknown, unknown-first and no detection types."""
    i = F.col("event_id") % 6
    return (
        F.when(i == 0, F.array(F.lit("person")))
        .when(i == 1, F.array(F.lit("face"), F.lit("vehicle")))
        .when(i == 2, F.array(F.lit("smoke"), F.lit("person")))
        .when(i == 3, F.array(F.lit("face")))
        .when(i == 4, F.array().cast("array<string>"))
        .otherwise(F.array(F.lit("animal"), F.lit("babyCry")))
    )


def camera_events(spark: SparkSession, sf: str) -> DataFrame:
    """Raw camera events: one JSON line per purchase, some wrapped, some not events."""
    ev = events(spark, sf).where("event_type = 'purchase'")
    item = F.struct(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"),
        F.when(F.col("event_id") % 13 == 0, "camera").otherwise("event").alias("modelKey"),
        F.when(F.col("event_id") % 4 == 0, "smartMotionLine").otherwise("ring").alias("type"),
        F.when(F.col("event_id") % 17 != 0, F.col("hts") * 1000).alias("start"),
        F.when(
            F.col("event_id") % 11 != 0,
            F.col("hts") * 1000 + F.floor("value").cast("bigint") * 60000,
        ).alias("end"),
        detect_types().alias("smartDetectTypes"),
        F.concat(F.lit("cam-"), (F.col("user_id") % 5).cast("string")).alias("camera"),
        F.when(F.col("event_id") % 9 == 0, F.lit("dev-9")).alias("device"),
    )
    line = F.when(
        F.col("event_id") % 2 == 0, F.to_json(F.struct(F.lit("add").alias("type"), item.alias("item")))
    ).otherwise(F.to_json(item))
    return ev.select("event_id", "user_id", "hts", "value", F.col("ts").cast("timestamp").alias("timestamp"), line.alias("raw"))


def cameras(spark: SparkSession, sf: str) -> DataFrame:
    """Four named cameras; every third is offline."""
    number = F.col("user_id") % 5
    return (
        table(spark, sf, "events")
        .select(number.alias("n"))
        .where("n < 4")
        .distinct()
        .select(
            F.concat(F.lit("cam-"), F.col("n").cast("string")).alias("id"),
            F.concat(F.lit("Cam "), F.col("n").cast("string"), F.lit("-Door")).alias("name"),
            F.when(F.col("n") % 3 == 0, "DISCONNECTED").otherwise("CONNECTED").alias("state"),
        )
    )


def session_events(spark: SparkSession, sf: str) -> DataFrame:
    """Archive events of all purchases: one detection type, five cameras; one in eleven never ends."""
    ev = events(spark, sf).where("event_type = 'purchase'")
    return ev.select(
        F.concat(F.lit("cam_"), (F.col("user_id") % 5).cast("string")).alias("camera"),
        F.lit("person").alias("detection_type"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"),
        (F.col("hts") * 1000).alias("start_ms"),
        F.when(
            F.col("event_id") % 11 != 0,
            F.col("hts") * 1000 + F.floor("value").cast("bigint") * 60000,
        ).alias("end_ms"),
        F.timestamp_seconds("hts").alias("arrived_at"),
        F.col("hts").alias("arrival"),
    )


def frames(spark: SparkSession, sf: str) -> DataFrame:
    """A frame per view event."""
    return (
        events(spark, sf)
        .where("event_type = 'view'")
        .select(
            F.concat(F.lit("cam_"), (F.col("user_id") % 5).cast("string")).alias("camera"),
            F.col("hts").alias("ts"),
            F.concat(F.lit("frames/"), F.col("event_id").cast("string")).alias("path"),
        )
    )


LABELS = ["person", "car", "truck", "dog", "cat", "Backpack", "tree", "chair"]


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """Per image one labelled confidence for each element of its embedding."""
    images = table(spark, sf, "embeddings").select(
        F.concat(
            F.lit("data/smart/"),
            F.when(F.col("label") % 4 == 0, "person")
            .when(F.col("label") % 4 == 1, "vehicle")
            .when(F.col("label") % 4 == 2, "animal")
            .otherwise("fish"),
            F.lit("/cam/"),
            F.col("vec_id").cast("string"),
            F.lit(".jpg"),
        ).alias("image"),
        F.posexplode("embedding").alias("position", "confidence"),
    )
    labels = F.array(*[F.lit(x) for x in LABELS])
    return images.select(
        "image",
        "position",
        F.get(labels, F.col("position") % len(LABELS)).alias("label"),
        F.col("confidence").cast("double").alias("confidence"),
    )


def place_images(images: DataFrame, directory: str) -> None:
    """A small file for each ``path`` of ``images``, below ``directory``, written by the tasks."""

    def write(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(directory)
        made = set()
        for batch in batches:
            for path in batch["path"]:
                target = f"{root}/{path}"
                folder = target.rsplit("/", 1)[0]
                if folder not in made:
                    store.create_dir(folder)
                    made.add(folder)
                with store.open_output_stream(target) as out:
                    out.write(path.encode())
            yield batch

    images.select("path").mapInPandas(write, "path string").write.format("noop").mode("append").save()


def embedded_images(spark: SparkSession, sf: str) -> DataFrame:
    """Images (path) with the embedding that :func:`observed` reads."""
    path = (
        F.when(F.col("label") % 4 == 0, "person")
        .when(F.col("label") % 4 == 1, "vehicle")
        .when(F.col("label") % 4 == 2, "animal")
        .otherwise("fish")
    )
    return table(spark, sf, "embeddings").select(
        F.concat(
            F.lit("data/smart/"), path, F.lit("/cam/"), F.col("vec_id").cast("string"), F.lit(".jpg")
        ).alias("path"),
        "embedding",
    )


def observed(embedding: Column) -> Column:
    """The observations of an image as one array."""
    labels = F.array(*[F.lit(x) for x in LABELS])
    return F.transform(
        embedding,
        lambda c, i: F.struct(
            F.get(labels, i % len(LABELS)).alias("label"), c.cast("double").alias("confidence")
        ),
    )


def observed_images(spark: SparkSession, sf: str) -> DataFrame:
    """The same as :func:`observations` with those of an image as one array."""
    images = embedded_images(spark, sf)
    return images.select("path", observed(F.col("embedding")).alias("observations"))


def commands(spark: SparkSession, sf: str) -> DataFrame:
    """Commands, some with an empty field, some unreadable."""
    event = F.col("event_id")
    body = F.to_json(
        F.struct(
            F.when(event % 7 == 0, "").otherwise("climate").alias("domain"),
            F.when(event % 11 == 0, "").otherwise("set_temperature").alias("service"),
            F.when(event % 13 == 0, "").otherwise(
                F.concat(F.lit("climate.user_"), F.col("user_id").cast("string"))
            ).alias("entity_id"),
            F.when(event % 2 == 0, F.struct(F.col("k").alias("temperature"))).alias("data"),
        )
    )
    return table(spark, sf, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint")
    ).select(
        "event_id",
        F.when(event % 17 == 0, F.lit("{broken")).otherwise(body).alias("value"),
        "user_id",
        "k",
    )


def bench_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as messages: device is the supplier, time the shipping date."""
    li = table(spark, sf, "lineitem")
    hts = F.unix_timestamp("l_shipdate")
    position = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    body = F.to_json(
        F.struct(
            hts.alias("ts"), "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus",
        )
    )
    return li.select(
        F.lit("lineitem").alias("topic"),
        F.lit(0).alias("partition"),
        position.alias("offset"),
        F.concat_ws(":", "l_suppkey", hts).alias("key"),
        record_headers(F.col("l_suppkey"), hts, F.lit(1), F.lit(1)).alias("headers"),
        body.cast("binary").alias("value"),
        F.timestamp_seconds(position).alias("timestamp"),
    )


def bench_devices(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "lineitem").select("l_suppkey").distinct()
    rows = suppliers.select(F.col("l_suppkey").alias("id"), F.col("l_suppkey").alias("lsid"))
    return schemas.empty(spark, schemas.DEVICES_DDL).unionByName(rows, allowMissingColumns=True)




def fill_inbox(df: DataFrame, path: str, order: Column, file_format: str = "parquet") -> None:
    """The rows as files that a stream takes in ``order``: no later file holds an earlier row.

    A file stream takes files by their time of change, which tasks that write side by
    side leave to chance.  So the files get times that follow their ranges, a second apart.
    """
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    middle = df.agg((F.min(order) + F.max(order)) / 2).first()[0]
    arrived: dict[str, object] = {}
    for part in (df.where(order <= middle), df.where(order > middle)):
        part.repartitionByRange(order).write.mode("append").format(file_format).save(path)
        # A task writes its range as part-<number>, and ranges are numbered upwards.
        found = {f.getPath().getName(): f.getPath() for f in fs.listStatus(folder)}
        for name in sorted(n for n in found if n.startswith("part-") and n not in arrived):
            arrived[name] = found[name]
    now = int(time.time() * 1000)
    for later, file in enumerate(reversed(arrived.values())):
        fs.setTimes(file, now - 1000 * later, -1)
