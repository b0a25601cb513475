"""Image detections: ranking, boxes, names, publishing form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthstream.operators.envelope import string_headers

# Event types in test order, and the labels each one accepts.
ALLOWED_LABELS = {
    "person": ["person"],
    "package": ["backpack", "handbag", "suitcase"],
    "animal": ["dog", "cat", "horse", "sheep", "cow", "elephant", "bear", "zebra", "giraffe", "bird"],
    "vehicle": ["car", "truck", "bus", "motorcycle"],
}
VEHICLE_TOPIC = "detect.vehicle"


def event_type_from_path(path: Column) -> Column:
    """Event type named below ``/smart/``, NULL when none of the known ones is."""
    chosen = None
    for name in ALLOWED_LABELS:
        inside = path.contains(f"/smart/{name}/")
        chosen = F.when(inside, name) if chosen is None else chosen.when(inside, name)
    return chosen


def allowed_labels(event_type: Column) -> Column:
    chosen = None
    for name, labels in ALLOWED_LABELS.items():
        value = F.array(*[F.lit(x) for x in labels])
        chosen = (
            F.when(event_type == name, value) if chosen is None
            else chosen.when(event_type == name, value)
        )
    return chosen.otherwise(F.array().cast("array<string>"))


def allowed_pairs(spark: SparkSession) -> DataFrame:
    """The accepted labels as rows (event_type, label)."""
    pairs = [
        F.struct(F.lit(kind).alias("event_type"), F.lit(label).alias("label"))
        for kind, labels in ALLOWED_LABELS.items()
        for label in labels
    ]
    return spark.range(1).select(F.inline(F.array(*pairs)))


def best_in_array(observations: Column, allowed: Column) -> Column:
    """Most confident observation with an allowed label; ties keep the first, NULL if none."""
    fitting = F.filter(observations, lambda o: F.array_contains(allowed, F.lower(o["label"])))
    top = F.array_max(F.transform(fitting, lambda o: o["confidence"]))
    return F.get(F.filter(fitting, lambda o: o["confidence"] == top), F.lit(0))


def best_detection(observations: DataFrame, allowed: DataFrame | list[str]) -> DataFrame:
    """Best observation per image, from rows (image, position, label, confidence).

    ``allowed`` is a list of labels, or a DataFrame (event_type, label) when the
    rows carry an event type of their own.
    """
    if isinstance(allowed, list):
        fitting = observations.where(F.lower("label").isin(allowed))
    else:
        wanted = allowed.select(F.col("event_type"), F.col("label").alias("_label"))
        fitting = observations.join(
            wanted,
            (observations["event_type"] == wanted["event_type"])
            & (F.lower(observations["label"]) == F.col("_label")),
            "left_semi",
        )
    best = fitting.groupBy("image").agg(
        # Highest confidence first, then the smallest position.
        F.max_by(
            F.struct("position", "label", "confidence"),
            F.struct(F.col("confidence"), -F.col("position")),
        ).alias("best")
    )
    return best.select("image", "best.position", "best.label", "best.confidence")


def ranked_labels(observations: DataFrame, n: int = 5) -> DataFrame:
    """The n most confident labels per image, in rank order, as rows.

    ``row_number() <= n`` is cut per map task before the shuffle.
    """
    by_confidence = Window.partitionBy("image").orderBy(F.desc("confidence"), "position")
    return observations.withColumn("rank", F.row_number().over(by_confidence)).where(
        F.col("rank") <= n
    )


def top_labels(results: Column, n: int = 5) -> Column:
    """First n of an array of (label, confidence) by falling confidence; ties keep order."""
    numbered = F.transform(
        results,
        lambda x, i: F.struct(
            (-x["confidence"]).alias("c"), i.alias("i"), x["label"].alias("label"),
            x["confidence"].alias("confidence"),
        ),
    )
    return F.transform(
        F.slice(F.array_sort(numbered), 1, n),
        lambda x: F.struct(x["label"].alias("label"), x["confidence"].alias("confidence")),
    )


def pixel_box(box: Column, width: Column, height: Column) -> Column:
    """Normalized lower-left box to upper-left pixels inside the image, NULL if empty."""
    left = box["x"] * width
    top = (F.lit(1.0) - (box["y"] + box["h"])) * height
    right = left + box["w"] * width
    bottom = top + box["h"] * height
    x0, y0 = F.greatest(left, F.lit(0.0)), F.greatest(top, F.lit(0.0))
    x1 = F.least(right, width.cast("double"))
    y1 = F.least(bottom, height.cast("double"))
    return F.when(
        (x1 > x0) & (y1 > y0),
        F.struct(x0.alias("x"), y0.alias("y"), (x1 - x0).alias("w"), (y1 - y0).alias("h")),
    )


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def crop_names(images: DataFrame, path: str = "path", boxes: str = "boxes") -> DataFrame:
    """One row per box: ``base.jpg`` for a single box, else ``base_i.jpg``."""
    base = file_stem(F.col(path))
    exploded = images.select(
        *images.columns, F.size(boxes).alias("_n"), F.posexplode(boxes).alias("index", "box")
    )
    return exploded.withColumn(
        "name",
        F.when(F.col("_n") == 1, F.concat(base, F.lit(".jpg"))).otherwise(
            F.concat(base, F.lit("_"), F.col("index").cast("string"), F.lit(".jpg"))
        ),
    ).drop("_n")


def image_epoch(path: Column, now: Column) -> Column:
    """The file stem as epoch seconds, else the processing time."""
    stem = file_stem(path)
    return F.coalesce(F.when(stem.rlike(r"\A[+-]?[0-9]+\z"), stem.try_cast("bigint")), now)


def detection_messages(results: DataFrame, now: Column) -> DataFrame:
    """Messages keyed ``vehicle:{stem}`` with body {ts, image_path, top}; empty ones dropped."""
    found = results.where(F.size("top") > 0)
    return found.select(
        F.lit(VEHICLE_TOPIC).alias("topic"),
        F.concat_ws(":", F.lit("vehicle"), file_stem(F.col("image_path"))).alias("key"),
        F.to_json(
            F.struct(image_epoch(F.col("image_path"), now).alias("ts"), "image_path", "top")
        )
        .cast("binary")
        .alias("value"),
        string_headers().cast("array<struct<key:string,value:binary>>").alias("headers"),
    )
