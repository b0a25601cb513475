"""New images to ranked detections."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthstream.functions.documents import with_once
from hearthstream.operators import detections as D
from hearthstream.sources.files import new_images

SCORED_DDL = "path string, top array<struct<label:string,confidence:double>>"

Scorer = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def best_crops(images: DataFrame) -> DataFrame:
    """Best allowed detection per image of a known event type; others are dropped."""
    kind = D.event_type_from_path(F.col("path"))
    typed = images.withColumn("event_type", kind).where(F.col("event_type").isNotNull())
    allowed = typed.withColumn("_allowed", D.allowed_labels(F.col("event_type")))
    best = D.best_in_array(F.col("observations"), F.col("_allowed"))
    # Exploding a list of at most one drops images without a hit and ranks once.
    return allowed.withColumn("best", F.explode(F.array_compact(F.array(best)))).drop("_allowed")


def scored_by_table(
    images: DataFrame, table: DataFrame, n: int = 5, observations: Column | None = None
) -> DataFrame:
    """Top labels per image, from a table (path, observations).

    ``observations`` derives the array from other columns of the table.  That and the
    ranking are done once for each image that is met, not for every row of the table.
    """
    found = F.col("observations") if observations is None else observations
    met = images.select("path").join(table, "path")
    return with_once(met, "top", D.top_labels(found, n)).select(
        F.col("path").alias("image_path"), "top"
    )


def scored_by_model(images: DataFrame, scorer: Scorer) -> DataFrame:
    """Top labels per image, from a user's model run over Arrow batches of paths."""
    return images.select("path").mapInPandas(scorer, SCORED_DDL).select(
        F.col("path").alias("image_path"), "top"
    )


def detection_stream(
    spark: SparkSession, directory: str, score: Callable[[DataFrame], DataFrame], now: Column, **options
) -> DataFrame:
    """Messages of every image that appears below ``directory``, once each.

    ``score`` turns images (path) into (image_path, top): :func:`scored_by_table` with a
    static table, :func:`scored_by_model`, or the caller's own.  Images without labels
    publish nothing.
    """
    return D.detection_messages(score(new_images(spark, directory, **options)), now)


def publish_once(messages: DataFrame, path: str, checkpoint: str):
    """A writer of a message stream that a repeated micro-batch does not write twice.

    A batch owns the folder of its number and replaces it, so one that failed
    half-way, or that is repeated after a restart, leaves each message once.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def published(spark: SparkSession, path: str) -> DataFrame:
    """The messages below ``path``; the number of their batch is dropped."""
    return spark.read.parquet(path).drop("batch")
