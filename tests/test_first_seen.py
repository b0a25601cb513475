from datetime import datetime

from pyspark.sql import functions as F

from hearthstream.operators import records as R

DDL = (
    "device_id bigint, field string, value_kind string, sensor_type bigint, data_structure_type bigint, "
    "timestamp timestamp, topic string, partition int, offset bigint"
)


def points(spark):
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    return spark.createDataFrame(
        [
            (1, "a", "string", 1, 1, late, "t", 0, 1),
            (1, "a", "number", 2, 1, early, "t", 0, 3),
            (1, "a", "null", 3, 1, early, "t", 0, 2),
            (1, "b", "number", 4, 1, early, "t", 0, 1),
            # A missing time comes first.
            (1, "b", "string", 5, 1, None, "t", 0, 9),
            (2, "a", "boolean", 6, 1, late, "u", 0, 1),
            (2, "a", "string", 7, 1, late, "t", 1, 1),
        ],
        DDL,
    )


def test_first_seen_types_by_the_whole_arrival(spark):
    found = R.first_seen_types(points(spark)).select("device_id", "tag_name", "data_type", "sensor_type")
    assert sorted(tuple(r) for r in found.collect()) == [
        (1, "a", "null", 3), (1, "b", "text", 5), (2, "a", "text", 7),
    ]


def test_first_seen_types_sort_only_the_points_of_the_earliest_times(spark):
    many = spark.range(2000).select(
        (F.col("id") % 4).alias("device_id"), F.lit("a").alias("field"), F.lit("number").alias("value_kind"),
        F.lit(1).cast("bigint").alias("sensor_type"), F.lit(1).cast("bigint").alias("data_structure_type"),
        F.timestamp_seconds("id").alias("timestamp"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"),
    )
    found = R.first_seen_types(many)
    assert found.count() == 4
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    # Ordered by the arrival: the rows behind a semi join with the earliest times.
    ordered = next(i for i, line in enumerate(plan.splitlines()) if "min_by(" in line)
    assert len(aggregates) == 2
    assert any("LeftSemi" in line for line in plan.splitlines()[ordered:])


def test_first_seen_types_order_no_points_where_the_time_decides(spark):
    many = spark.range(2000).select(
        (F.col("id") % 4).alias("device_id"), F.lit("a").alias("field"),
        F.when(F.col("id") < 1000, "number").otherwise("string").alias("value_kind"),
        F.lit(1).cast("bigint").alias("sensor_type"), F.lit(None).cast("bigint").alias("data_structure_type"),
        # Device 3 has two types at its earliest time.
        F.timestamp_seconds(F.when(F.col("id") % 4 == 3, 7).otherwise(F.col("id"))).alias("timestamp"),
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), (2000 - F.col("id")).alias("offset"),
    )
    found = R.first_seen_types(many)
    assert sorted((r.device_id, r.data_type) for r in found.collect()) == [
        (0, "numeric"), (1, "numeric"), (2, "numeric"), (3, "text")]
    # The tags with several types at once are known, and so few, when the points are joined with them.
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
