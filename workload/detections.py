"""Detection ranking and geometry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthstream.operators import detections as D
from hearthstream.session import scratch_dir
from hearthstream.streaming.detections import (
    best_crops,
    detection_stream,
    publish_once,
    published,
    scored_by_table,
)
from workload import feeds
from workload.registry import query


@query("PRJ40", "SELECT image, event_type FROM img", "img")
def event_type_from_path(spark, sf):
    return feeds.observed_images(spark, sf).select(
        F.col("path").alias("image"), D.event_type_from_path(F.col("path")).alias("event_type")
    )


_ALLOWED = """
SELECT * FROM (VALUES ('person', 'person'), ('vehicle', 'car'), ('vehicle', 'truck'), ('animal', 'dog'),
  ('animal', 'cat'), ('package', 'backpack')) a(event_type, allowed)"""

_BEST = f"""
SELECT image, position, label, confidence FROM obs JOIN ({_ALLOWED}) a
  ON obs.event_type = a.event_type AND lower(obs.label) = a.allowed
QUALIFY row_number() OVER (PARTITION BY image ORDER BY confidence DESC, position) = 1"""


@query("AGG20", _BEST, "obs")
def best_detection(spark, sf):
    observations = feeds.observations(spark, sf).withColumn(
        "event_type", D.event_type_from_path(F.col("image"))
    )
    return D.best_detection(observations, D.allowed_pairs(spark)).withColumn(
        "position", F.col("position").cast("bigint")
    )


@query("AGG20, STR12", f"SELECT image, label, confidence FROM ({_BEST})", "obs")
def best_crops_of_images(spark, sf):
    best = best_crops(feeds.observed_images(spark, sf))
    return best.select(F.col("path").alias("image"), "best.label", "best.confidence")


@query("TOP4", """
SELECT image, label, confidence, CAST(row_number() OVER (PARTITION BY image ORDER BY confidence DESC, position) AS BIGINT) AS rank
FROM obs QUALIFY rank <= 5""", "obs")
def top_labels(spark, sf):
    top = D.top_labels(F.col("observations"), 5)
    return feeds.observed_images(spark, sf).select(
        F.col("path").alias("image"), F.posexplode(top).alias("i", "t")
    ).select("image", "t.label", "t.confidence", (F.col("i") + 1).cast("bigint").alias("rank"))


@query("TOP4", """
SELECT image, label, CAST(row_number() OVER (PARTITION BY image ORDER BY confidence DESC, position) AS BIGINT) AS rank
FROM obs QUALIFY rank <= 3""", "obs")
def ranked_labels(spark, sf):
    return D.ranked_labels(feeds.observations(spark, sf), 3).select(
        "image", "label", F.col("rank").cast("bigint").alias("rank")
    )


_BOX = """
SELECT vec_id, greatest(x * 640, 0.0) AS x0, greatest((1.0 - (y + h)) * 480, 0.0) AS y0,
  least(x * 640 + w * 640, 640.0) AS x1, least((1.0 - (y + h)) * 480 + h * 480, 480.0) AS y1
FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 4 AS x, CAST(embedding[2] AS DOUBLE) * 4 AS y,
  CAST(embedding[3] AS DOUBLE) * 4 AS w, CAST(embedding[4] AS DOUBLE) * 4 AS h FROM embeddings)"""


def _box():
    def part(i):
        return F.get("embedding", F.lit(i)).cast("double") * 4

    return F.struct(part(0).alias("x"), part(1).alias("y"), part(2).alias("w"), part(3).alias("h"))


@query("PRJ41", f"""
SELECT vec_id, round(x0, 6) AS x, round(y0, 6) AS y, round(x1 - x0, 6) AS w, round(y1 - y0, 6) AS h
FROM ({_BOX}) WHERE x1 > x0 AND y1 > y0""")
def pixel_box(spark, sf):
    boxed = feeds.table(spark, sf, "embeddings").select("vec_id", _box().alias("box"))
    pixels = boxed.select(
        "vec_id", D.pixel_box(F.col("box"), F.lit(640), F.lit(480)).alias("p")
    ).where(F.col("p").isNotNull())
    return pixels.select("vec_id", *[F.round(F.col(f"p.{c}"), 6).alias(c) for c in "xywh"])


@query("PRJ42", """
SELECT vec_id, CAST(i AS BIGINT) AS index, CASE WHEN vec_id % 3 = 0 THEN CAST(vec_id AS VARCHAR) || '.jpg'
  ELSE CAST(vec_id AS VARCHAR) || '_' || CAST(i AS VARCHAR) || '.jpg' END AS name
FROM embeddings, (VALUES (0), (1), (2)) v(i) WHERE i <= vec_id % 3""")
def crop_names(spark, sf):
    images = feeds.table(spark, sf, "embeddings").select(
        "vec_id",
        F.concat(F.lit("/a/b.c/"), F.col("vec_id").cast("string"), F.lit(".png")).alias("path"),
        F.slice("embedding", F.lit(1), (F.col("vec_id") % 3 + 1).cast("int")).alias("boxes"),
    )
    return D.crop_names(images).select("vec_id", F.col("index").cast("bigint").alias("index"), "name")


@query("PRJ43", """
SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN vec_id ELSE 1767225600 END AS epoch FROM embeddings""")
def image_epoch(spark, sf):
    stem = F.when(F.col("vec_id") % 2 == 0, F.col("vec_id").cast("string")).otherwise("cover")
    path = F.concat(F.lit("/x/"), stem, F.lit(".jpg"))
    return feeds.table(spark, sf, "embeddings").select("vec_id", path.alias("path")).select(
        "vec_id", D.image_epoch(F.col("path"), F.lit(feeds.NOW_EPOCH)).alias("epoch")
    )


@query("SNK9, STR12", """
SELECT 'vehicle:' || CAST(vec_id AS VARCHAR) AS key, 'detect.vehicle' AS topic, vec_id AS ts, image AS image_path,
  (SELECT label FROM obs WHERE obs.image = img.image ORDER BY confidence DESC, position LIMIT 1) AS best
FROM img""", "obs")
def publish_detections(spark, sf):
    images = feeds.observed_images(spark, sf)
    scored = scored_by_table(images.select("path"), images)
    body = F.col("value").cast("string")
    return D.detection_messages(scored, F.lit(feeds.NOW_EPOCH)).select(
        "key", "topic",
        F.get_json_object(body, "$.ts").cast("bigint").alias("ts"),
        F.get_json_object(body, "$.image_path").alias("image_path"),
        F.get_json_object(body, "$.top[0].label").alias("best"),
    )


@query("STR12, SRC13, SNK9", """
SELECT 'vehicle:' || CAST(vec_id AS VARCHAR) AS key, vec_id AS ts, image AS image_path,
  (SELECT string_agg(label, ',' ORDER BY confidence DESC, position) FROM
    (SELECT * FROM obs WHERE obs.image = img.image ORDER BY confidence DESC, position LIMIT 5)) AS labels
FROM img""", "obs")
def detections_streamed(spark, sf):
    """Image files through the stream, in two runs and an idle one."""
    images = feeds.embedded_images(spark, sf)
    inbox, out, offsets = (scratch_dir(spark, x) for x in ("images", "detections", "offsets"))
    # Uniform resource names with a scheme, also for a plain local folder.
    inbox = inbox if ":" in inbox else f"file://{inbox}"
    # Paths below the inbox, as the table of observations has them.
    inside = F.regexp_extract("path", "(data/smart/.*)", 1)
    first = F.crc32("path") % 3 == 0
    for part in (images.where(first), images.where(~first), images.where("false")):
        feeds.place_images(part, inbox)
        messages = detection_stream(
            spark, inbox,
            lambda found: scored_by_table(
                found.withColumn("path", inside), images,
                observations=feeds.observed(F.col("embedding")),
            ),
            F.lit(feeds.NOW_EPOCH),
        )
        publish_once(messages, out, offsets).trigger(availableNow=True).start().awaitTermination()
    body = F.col("value").cast("string")
    return published(spark, out).select(
        "key", F.get_json_object(body, "$.ts").cast("bigint").alias("ts"),
        F.get_json_object(body, "$.image_path").alias("image_path"),
        F.array_join(F.from_json(F.get_json_object(body, "$.top[*].label"), "array<string>"), ",").alias("labels"),
    )


@query("FN14", """
SELECT image, position, CAST(round(confidence * 100) AS BIGINT) AS percent FROM obs""", "obs")
def confidence_percent(spark, sf):
    from hearthstream.functions import confidence_percent as percent

    return feeds.observations(spark, sf).select(
        "image", F.col("position").cast("bigint").alias("position"),
        percent(F.col("confidence")).cast("bigint").alias("percent"),
    )
