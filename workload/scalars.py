"""Scalar function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthstream import functions as H
from workload import feeds
from workload.registry import query


@query("FN2", """
SELECT event_id, CASE event_id % 6
  WHEN 0 THEN hts WHEN 1 THEN hts WHEN 2 THEN hts WHEN 3 THEN hts // 60 * 60 WHEN 4 THEN hts // 86400 * 86400
  ELSE 0 END AS epoch FROM m""", "m")
def parse_timestamp(spark, sf):
    moment = F.timestamp_seconds("hts")
    i = F.col("event_id") % 6
    text = (
        F.when(i == 0, F.col("hts").cast("string"))
        .when(i == 1, F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
        .when(i == 2, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(i == 3, F.date_format(moment, "yyyy-MM-dd HH:mm"))
        .when(i == 4, F.date_format(moment, "yyyy-MM-dd"))
        .otherwise(F.date_format(moment, "dd/MM/yyyy"))
    )
    return feeds.events(spark, sf).select("event_id", text.alias("t")).select(
        "event_id", H.parse_timestamp(F.col("t")).alias("epoch")
    )


@query("FN3", """
SELECT event_id, epoch_us(date_trunc('week', ts)) // 1000000 AS week FROM events""")
def start_of_week(spark, sf):
    return feeds.events(spark, sf).select("event_id", H.start_of_week(F.col("hts")).alias("week"))


@query("FN4", """
SELECT event_id, hts + i * 86400 AS start, least(hts + (i + 1) * 86400, hts + CAST(floor(value) AS BIGINT) * 3600) AS "end"
FROM m, range(0, 30) r(i) WHERE i * 86400 < CAST(floor(value) AS BIGINT) * 3600""", "m")
def day_windows(spark, sf):
    end = F.col("hts") + F.floor("value") * 3600
    return feeds.events(spark, sf).select(
        "event_id", F.explode(H.day_windows(F.col("hts"), end)).alias("w")
    ).select("event_id", "w.start", "w.end")


@query("FN5", """
SELECT event_id, value >= 1 AND floor(value) <= 24 AS valid FROM m""", "m")
def valid_window(spark, sf):
    end = F.col("hts") + F.floor("value") * 3600
    return feeds.events(spark, sf).select(
        "event_id", H.valid_window(F.col("hts"), end).alias("valid")
    )


@query("FN6", "SELECT event_id, make_timestamp(hts * 1000000) AS time FROM m", "m")
def to_timestamp(spark, sf):
    return feeds.events(spark, sf).select(
        "event_id", H.epoch_to_timestamp(F.col("hts")).cast("timestamp_ntz").alias("time")
    )


@query("FN1, T9", """
SELECT l_orderkey, l_linenumber, CASE WHEN v = floor(v) THEN CAST(CAST(v AS BIGINT) AS VARCHAR) ELSE CAST(v AS VARCHAR) END AS text
FROM (SELECT l_orderkey, l_linenumber, l_extendedprice AS v FROM lineitem)""")
def numeric_text(spark, sf):
    return feeds.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", H.numeric_text(F.col("l_extendedprice")).alias("text")
    )


@query("FN9", """
SELECT event_id, nullif(event_id % 3, 0) AS z, nullif(CASE WHEN event_id % 4 = 0 THEN '' ELSE event_type END, '') AS e FROM m""", "m")
def nullifs(spark, sf):
    event = F.col("event_id")
    return feeds.events(spark, sf).select(
        "event_id",
        H.nullif_zero(event % 3).alias("z"),
        H.nullif_empty(F.when(event % 4 == 0, "").otherwise(F.col("event_type"))).alias("e"),
    )


@query("FN8, FN10", """
SELECT event_id, coalesce(nullif(event_type, 'view'), 'none') AS kind, CAST(value AS VARCHAR) <> '' AS has_text,
  upper(event_type) || '-' || lower(upper(event_type)) AS both, starts_with(event_type, 'c') AS c,
  contains(event_type, 'i') AS i, replace(event_type, 'e', '_') AS replaced,
  CASE WHEN event_type LIKE '%up' THEN left(event_type, length(event_type) - 2) ELSE event_type END AS short,
  upper(event_type) = 'CLICK' AS folded, CASE WHEN strpos(event_type, 'r') > 0 THEN split_part(event_type, 'r', 1) ELSE '' END AS before
FROM m""", "m")
def text_functions(spark, sf):
    kind = F.col("event_type")
    return feeds.events(spark, sf).select(
        "event_id",
        F.coalesce(F.nullif(kind, F.lit("view")), F.lit("none")).alias("kind"),
        (F.col("value").cast("string") != "").alias("has_text"),
        F.concat(F.upper(kind), F.lit("-"), F.lower(F.upper(kind))).alias("both"),
        kind.startswith("c").alias("c"),
        kind.contains("i").alias("i"),
        F.replace(kind, F.lit("e"), F.lit("_")).alias("replaced"),
        H.strip_suffix(kind, "up").alias("short"),
        H.equal_fold(kind, F.lit("Click")).alias("folded"),
        H.text_before(kind, "r").alias("before"),
    )


@query("FN12", """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'person' WHEN 2 THEN 'person' WHEN 5 THEN NULL END AS hit,
  CASE WHEN len(types) > 0 THEN types[1] END AS first, list_contains(types, 'smoke') AS smoke FROM ce""", "ce")
def array_functions(spark, sf):
    types = F.col("types")
    return (
        feeds.camera_events(spark, sf)
        .select("event_id", feeds.detect_types().alias("types"))
        .select(
            "event_id",
            H.first_matching(types, ["person"]).alias("hit"),
            F.get(types, F.lit(0)).alias("first"),
            F.array_contains(types, "smoke").alias("smoke"),
        )
    )


@query("FN13", "SELECT event_id, (hts * 1000 + event_id % 1000) // 1000 AS s FROM m", "m")
def millis_to_seconds(spark, sf):
    return feeds.events(spark, sf).select(
        "event_id",
        H.millis_to_seconds(F.col("hts") * 1000 + F.col("event_id") % 1000).alias("s"),
    )


@query("PRJ1, T1", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id WHEN 1 THEN -event_id WHEN 2 THEN 9223372036854775807 ELSE 0 END AS n
FROM m""", "m")
def integer_or_zero(spark, sf):
    event = F.col("event_id")
    text = (
        F.when(event % 4 == 0, F.concat(F.lit("+"), event.cast("string")))
        .when(event % 4 == 1, F.concat(F.lit("-"), event.cast("string")))
        .when(event % 4 == 2, F.lit("99999999999999999999"))
        .otherwise(F.concat(event.cast("string"), F.lit("x")))
    )
    return feeds.events(spark, sf).select("event_id", text.alias("t")).select(
        "event_id", H.integer_or_zero(F.col("t")).alias("n")
    )
