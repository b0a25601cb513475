"""File-backed sources and sinks: envelopes, API payloads, frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthstream import schemas
from hearthstream.functions import sanitize_name


# File streams ignore files this much older than the newest one they have seen.
# Records may come arbitrarily late, so the default is a century.  A source that
# keeps millions of files should archive them (``cleanSource``) instead of
# shortening it, because every path within this age is remembered.
MAX_FILE_AGE = "36500d"


def read_envelope_files(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    stream: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Envelope rows from files, bounded or as a stream."""
    reader = spark.readStream if stream else spark.read
    reader = reader.schema(schemas.MESSAGE_DDL).format(file_format)
    if stream:
        reader = reader.option("maxFileAge", MAX_FILE_AGE)
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def publish_to_files(
    messages: DataFrame, path: str, now: Column | None = None, day: Column | None = None
) -> None:
    """Append messages in publishing form to envelope files.

    Stands in for a broker: positions are unique but not dense, and depend only
    on the message, so a retried task writes the same ones.  ``day`` adds a
    partition column ``dt``, by which readers can limit themselves.
    """
    stamped = messages.select(
        "topic",
        F.lit(0).alias("partition"),
        # 62 hash bits keep the position positive.
        F.shiftrightunsigned(F.xxhash64("topic", "key", "value"), 2).alias("offset"),
        "key",
        "headers",
        "value",
        (F.current_timestamp() if now is None else now).alias("timestamp"),
        *([] if day is None else [day.alias("dt")]),
    )
    if day is None:
        stamped.write.mode("append").parquet(path)
    else:
        stamped.hint("rebalance", "dt").write.mode("append").partitionBy("dt").parquet(path)


def distinct_keys(messages: DataFrame) -> DataFrame:
    """Distinct non-empty message keys."""
    return messages.where(F.col("key") != "").select("key").distinct()


def _payload(spark: SparkSession, path: str, ddl: str, one_per_file: bool) -> DataFrame:
    return spark.read.schema(ddl).option("multiLine", str(one_per_file).lower()).json(path)


def read_current_conditions(
    spark: SparkSession, path: str, one_per_file: bool = True
) -> DataFrame:
    """API snapshots: station, time, sensors[] with data[].

    A payload is a whole file, or one line of a file (``one_per_file=False``).
    """
    return _payload(spark, path, schemas.SNAPSHOT_DDL, one_per_file)


def stream_current_conditions(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """The same as a stream: every new snapshot file is read once."""
    return (
        spark.readStream.schema(schemas.SNAPSHOT_DDL)
        .option("multiLine", "true")
        .option("maxFileAge", MAX_FILE_AGE)
        .option("maxFilesPerTrigger", max_files)
        .json(path)
    )


def read_sensor_metadata(
    spark: SparkSession, path: str, one_per_file: bool = True
) -> DataFrame:
    """One row per sensor."""
    return _payload(spark, path, schemas.SENSORS_DDL, one_per_file).select(F.inline("sensors"))


def read_sensor_catalog(
    spark: SparkSession, path: str, one_per_file: bool = True
) -> DataFrame:
    """One row per sensor type, with the payload's generation time."""
    return _payload(spark, path, schemas.CATALOG_RESPONSE_DDL, one_per_file).select(
        "generated_at", F.inline("sensor_types")
    )


def read_stations(
    spark: SparkSession, path: str, one_per_file: bool = True
) -> DataFrame:
    """One row per station."""
    return _payload(spark, path, schemas.STATIONS_DDL, one_per_file).select(F.inline("stations"))


def index_frames(files: DataFrame) -> DataFrame:
    """Frame index of file paths ``.../{camera}/{epoch}.jpg``; other names are skipped."""
    parts = F.split("path", "/")
    stem = F.regexp_extract(F.element_at(parts, -1), r"\A([+-]?[0-9]+)\.jpg\z", 1)
    return files.select(
        sanitize_name(F.element_at(parts, -2)).alias("camera"),
        F.when(stem != "", stem.try_cast("bigint")).alias("ts"),
        "path",
        *[c for c in ("content",) if c in files.columns],
    ).where(F.col("ts").isNotNull())


def read_frames(spark: SparkSession, directory: str, with_content: bool = False) -> DataFrame:
    """Frame index of a directory tree.  Without content no image is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.jpg")
        .option("recursiveFileLookup", "true")
        .load(directory)
    )
    return index_frames(files.select("path", "content") if with_content else files.select("path"))


def new_images(
    spark: SparkSession, directory: str, latest_first: bool = False, max_files: int = 10000
) -> DataFrame:
    """Stream of image files; the checkpoint makes each path come once.

    To skip the images that exist already, run once with a no-op sink on the
    same checkpoint before starting the real query.
    """
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.jpg")
        .option("recursiveFileLookup", "true")
        .option("latestFirst", str(latest_first).lower())
        .option("maxFileAge", MAX_FILE_AGE)
        .option("maxFilesPerTrigger", max_files)
        .load(directory)
        .select("path", "modificationTime")
    )
