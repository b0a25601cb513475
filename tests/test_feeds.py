from pyspark.sql import functions as F

from workload import feeds


def arrivals(spark, path):
    """First and last row of each file, in the order of the files' times."""
    files = spark.read.parquet(path).groupBy(
        F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_name").alias("file")
    ).agg(F.min("id").alias("low"), F.max("id").alias("high"))
    return [(r.time, r.low, r.high) for r in files.orderBy("time", "file").collect()]


def test_files_of_an_inbox_arrive_in_the_order_of_their_rows(spark, folder):
    # More files than are written at once, later rows in smaller and so earlier files.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = spark.range(40000).withColumn("text", F.repeat(F.sha2(F.col("id").cast("string"), 256), 8))
        feeds.fill_inbox(rows, f"{folder}/in", F.col("id"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    found = arrivals(spark, f"{folder}/in")
    assert len(found) > 8
    assert len({time for time, _, _ in found}) == len(found)
    assert all(before[2] < after[1] for before, after in zip(found, found[1:]))


def test_catalog_stream_takes_each_half_at_once(spark, monkeypatch):
    # In a batch the arrival decides; across batches the order of the files would.
    from hearthstream.streaming import tables
    from workload import all_queries

    taken = []
    apply = tables.apply_catalog
    monkeypatch.setattr(tables, "apply_catalog", lambda batch, to: (taken.append(batch.count()), apply(batch, to)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        all_queries()["catalog_streamed"].build(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(taken) == 2 and sum(taken) == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
