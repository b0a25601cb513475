import json

import pandas as pd
from pyspark.sql import functions as F

from hearthstream.operators import detections as D
from hearthstream.operators import cameras as C
from hearthstream.streaming.detections import best_crops, detection_stream, publish_once, published, scored_by_model, scored_by_table
from helpers import rows

OBS = "path string, observations array<struct<label:string,confidence:double>>"


def test_paths(spark):
    paths = ["/x/smart/person/cam/1.jpg", "/x/smart/fish/1.jpg", "/smart/vehicle/1.jpg", "/person/1.jpg"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(D.event_type_from_path(F.col("p"))).collect()] == ["person", None, "vehicle", None]


def test_best_detection_ties_keep_the_first(spark):
    df = spark.createDataFrame([
        ("/smart/vehicle/a/1.jpg", [("tree", 0.99), ("Car", 0.5), ("bus", 0.7), ("truck", 0.7)]),
        ("/smart/vehicle/a/2.jpg", [("tree", 0.9)]), ("/smart/fish/a/3.jpg", [("car", 0.9)]), ("/smart/animal/a/4.jpg", [])], OBS)
    assert rows(best_crops(df), "path", "best.label") == [("/smart/vehicle/a/1.jpg", "bus")]
    flat = df.select(F.col("path").alias("image"), F.posexplode("observations").alias("position", "o")).select("image", "position", "o.*")
    assert rows(D.best_detection(flat, D.ALLOWED_LABELS["vehicle"]), "image", "label") == [("/smart/fish/a/3.jpg", "car"), ("/smart/vehicle/a/1.jpg", "bus")]


def test_top_labels(spark):
    df = spark.createDataFrame([("p", [("a", 0.1), ("b", 0.5), ("c", 0.5), ("d", 0.9)])], OBS)
    assert [x.label for x in df.select(D.top_labels(F.col("observations"), 3)).first()[0]] == ["d", "b", "c"]


def test_pixel_boxes(spark):
    boxes = [(0.25, 0.25, 0.5, 0.5), (-0.5, 0.5, 1.0, 1.0), (1.5, 0.0, 0.2, 0.2), (0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame([(b,) for b in boxes], "b struct<x:double,y:double,w:double,h:double>")
    got = [r[0] and tuple(r[0]) for r in df.select(D.pixel_box(F.col("b"), F.lit(100), F.lit(200))).collect()]
    assert got == [(25.0, 50.0, 50.0, 100.0), (0.0, 0.0, 50.0, 100.0), None, None, (0.0, 0.0, 100.0, 200.0)]


def test_crop_names(spark):
    df = spark.createDataFrame([("/a/x.y.jpg", [1]), ("/a/z.jpg", [1, 2])], "path string, boxes array<int>")
    assert rows(D.crop_names(df), "name") == [("x.y.jpg",), ("z_0.jpg",), ("z_1.jpg",)]


def test_detection_messages(spark):
    df = spark.createDataFrame([("/a/170.jpg", [("m", 0.9)]), ("/a/b/cover.jpg", [("n", 0.8)]), ("/a/9.jpg", [])],
                               "image_path string, top array<struct<label:string,confidence:double>>")
    out = {r.key: json.loads(r.value) for r in D.detection_messages(df, F.lit(5)).collect()}
    assert out == {"vehicle:170": {"ts": 170, "image_path": "/a/170.jpg", "top": [{"label": "m", "confidence": 0.9}]},
                   "vehicle:cover": {"ts": 5, "image_path": "/a/b/cover.jpg", "top": [{"label": "n", "confidence": 0.8}]}}


def test_user_scorer(spark):
    def score(batches):
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "top": [[{"label": "x", "confidence": 0.5}]] * len(pdf)})

    df = spark.createDataFrame([("/a/1.jpg",), ("/a/2.jpg",)], "path string")
    assert rows(scored_by_model(df, score).select("image_path", F.col("top")[0]["label"])) == [("/a/1.jpg", "x"), ("/a/2.jpg", "x")]


def test_frame_messages_round_trip(spark):
    df = spark.createDataFrame([("id1", "front", 5, b"jpg")], "camera_id string, camera_name string, ts bigint, content binary")
    msgs = C.frame_messages(df, F.lit("video.front")).withColumns({"partition": F.lit(0), "offset": F.lit(3)})
    assert rows(msgs, "key") == [("id1:5",)]
    assert rows(C.frames_from_messages(msgs), "camera", "ts", "path") == [("front", 5, "video.front/0/3")]
    broken = msgs.withColumn("key", F.lit("id1:x"))
    assert C.frames_from_messages(broken).isEmpty()


def test_stream_of_images_publishes_each_once(spark, folder):
    import os

    seen = "substring_index(path, '/', -1)"
    table = spark.createDataFrame([("1.jpg", [("car", 0.2), ("dog", 0.9)]), ("2.jpg", [("cat", 0.5)]), ("3.jpg", [])], OBS)

    def put(name):
        os.makedirs(f"{folder}/in/cam", exist_ok=True)
        open(f"{folder}/in/cam/{name}", "wb").write(b"jpeg")

    def run():
        messages = detection_stream(spark, f"{folder}/in", lambda df: scored_by_table(df.withColumn("path", F.expr(seen)), table), F.lit(5))
        publish_once(messages, f"{folder}/out", f"{folder}/ck").trigger(availableNow=True).start().awaitTermination()
        return [json.loads(r.value)["top"][0]["label"] for r in published(spark, f"{folder}/out").orderBy("key").collect()]

    for name in ("1.jpg", "3.jpg", "unknown.jpg"):
        put(name)
    assert run() == ["dog"] and run() == ["dog"]
    put("2.jpg")
    assert run() == ["dog", "cat"]
    # A batch whose commit is lost is repeated, and replaces what it wrote.
    for name in os.listdir(f"{folder}/ck/commits"):
        if name.strip(".").split(".")[0] == "1":
            os.remove(f"{folder}/ck/commits/{name}")
    assert run() == ["dog", "cat"]


def test_files_of_a_micro_batch_are_not_listed_by_a_task_each(spark, folder):
    import os

    os.makedirs(f"{folder}/in")
    for k in range(200):
        open(f"{folder}/in/{k}.jpg", "wb").write(b"jpeg")
    table = spark.range(200).select(F.concat(F.col("id").cast("string"), F.lit(".jpg")).alias("path"), F.array(F.lit(0.5)).alias("c"))
    seen = F.substring_index("path", "/", -1)
    kept = F.transform("c", lambda c: F.struct(F.lit("car").alias("label"), c.alias("confidence")))
    messages = detection_stream(spark, f"{folder}/in", lambda df: scored_by_table(df.withColumn("path", seen), table, observations=kept), F.lit(5))
    run = publish_once(messages, f"{folder}/out", f"{folder}/ck").trigger(availableNow=True).start()
    run.awaitTermination()
    assert published(spark, f"{folder}/out").count() == 200
    tracker = spark.sparkContext.statusTracker()
    stages = [i for job in tracker.getJobIdsForGroup(str(run.runId)) for i in tracker.getJobInfo(job).stageIds]
    assert stages and max(tracker.getStageInfo(i).numTasks for i in stages if tracker.getStageInfo(i)) < 200


def test_a_table_is_ranked_only_for_the_images_that_are_met(spark):
    images = spark.createDataFrame([("a",)], "path string")
    table = spark.createDataFrame([("a", [0.1, 0.7]), ("b", [0.3])], "path string, c array<double>")
    kept = F.transform("c", lambda c, i: F.struct(i.cast("string").alias("label"), c.alias("confidence")))
    scored = D.detection_messages(scored_by_table(images, table, observations=kept), F.lit(5))
    assert [json.loads(r.value)["top"][0]["label"] for r in scored.collect()] == ["1"]
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join", 1)
    assert "lambda" in above and "lambda" not in below
