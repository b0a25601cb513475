from pyspark.sql import functions as F

from hearthstream import functions as H
from helpers import rows


def column(spark, values, ddl="x string"):
    return spark.createDataFrame([(v,) for v in values], ddl)


def apply(spark, values, f, ddl="x string"):
    df = column(spark, values, ddl)
    got = {r[0]: r[1] for r in df.select("x", f(F.col("x")).alias("y")).collect()}
    return [got[v] for v in values]


def test_integer_or_zero(spark):
    values = ["12", "+5", "-7", "abc", "", "1.5", " 3", "12\n", "99999999999999999999",
              "-99999999999999999999", None]
    assert apply(spark, values, H.integer_or_zero) == [
        12, 5, -7, 0, 0, 0, 0, 0, 2**63 - 1, -(2**63), 0,
    ]


def test_numeric_text_has_no_exponent_and_no_trailing_zero(spark):
    values = [60.0, 62.3, 0.0, -5.0, 35.20000076293945, 1e-7, 1e17, 12345678.901, -1.5e-9, 1.25e20,
              0.002, 123456789012345680.0, None]
    assert apply(spark, values, H.numeric_text, "x double") == [
        "60", "62.3", "0", "-5", "35.20000076293945", "0.0000001", "100000000000000000",
        "12345678.901", "-0.0000000015", "125000000000000000000", "0.002", "123456789012345680", None,
    ]


def test_parse_timestamp_layouts(spark):
    values = [
        "1768780863", "2026-01-11 18:20:47", "2026-01-11T18:20:47", "2026-01-11 18:20", "2026-01-11",
        "2026-01-11 18:20:47.75", "2026-02-30", "2026-01-11T18:20", "11/01/2026", "", "2026-01-11 18:20:60",
    ]
    day = 1768089600
    t = day + 18 * 3600 + 20 * 60
    assert apply(spark, values, H.parse_timestamp) == [
        1768780863, t + 47, t + 47, t, day, t + 47, 0, 0, 0, 0, 0,
    ]


def test_start_of_week_is_monday(spark):
    monday = 1704067200  # 2024-01-01
    values = [monday, monday + 1, monday + 7 * 86400 - 1, monday - 1]
    assert apply(spark, values, H.start_of_week, "x bigint") == [
        monday, monday, monday, monday - 7 * 86400,
    ]


def test_day_windows(spark):
    df = spark.createDataFrame([(0, 200000), (5, 5), (9, 3), (0, 86400)], "a bigint, b bigint")
    got = [r[0] for r in df.select(H.day_windows(F.col("a"), F.col("b"))).collect()]
    assert [[tuple(w) for w in ws] for ws in got] == [
        [(0, 86400), (86400, 172800), (172800, 200000)], [], [], [(0, 86400)],
    ]


def test_valid_window(spark):
    df = spark.createDataFrame([(0, 86400), (0, 86401), (5, 5), (6, 5)], "a bigint, b bigint")
    got = [r[0] for r in df.select(H.valid_window(F.col("a"), F.col("b"))).collect()]
    assert got == [True, False, False, False]


def test_small_helpers(spark):
    df = spark.createDataFrame([("Front Door-2", "a.b.c", 1999, 0.865, 0, "")],
                               "n string, d string, ms bigint, c double, z int, e string")
    row = df.select(
        H.sanitize_name(F.col("n")), H.text_before(F.col("d"), "."), H.millis_to_seconds(F.col("ms")),
        H.confidence_percent(F.col("c")), H.nullif_zero(F.col("z")), H.nullif_empty(F.col("e")),
        H.sha256_hex(F.lit("abc").cast("binary")), H.strip_suffix(F.col("d"), ".c"),
        H.strip_suffix(F.col("d"), ".b"), H.equal_fold(F.lit("ABC"), F.lit("aBc")),
    ).first()
    assert tuple(row)[:6] == ("front_door_2", "a", 1, 87, None, None)
    assert row[6] == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert tuple(row)[7:] == ("a.b", "a.b.c", True)


def test_record_date_of_garbage_is_null(spark):
    values = [0, 86399, 86400, -1, 10**15]
    got = apply(spark, values, lambda c: H.record_date(c).cast("string"), "x bigint")
    assert got == ["1970-01-01", "1970-01-01", "1970-01-02", None, None]


def test_parse_json_value_is_strict(spark):
    good = ['{"a":1}', ' {"a":1} ', "null", "[1]", '"x"', "3"]
    bad = ["", "{bad", '{"a":1} tail', '{"a":1}{"b":2}', '{"a":1},{"b":2}', "{'a':1}", '{"a":NaN}',
           '{"a":01}', '{"a":1}]', None]
    got = apply(spark, good + bad, lambda c: H.parse_json_value(c).isNotNull())
    assert got == [True] * len(good) + [False] * len(bad)


def test_value_kind_and_tag_type(spark):
    values = ["1", "1.5", "1e30", "true", '"x"', "null", "{}", "[1]", "12345678901234567890123"]
    kinds = apply(spark, values, lambda c: H.value_kind(H.parse_json_value(c)))
    assert kinds == ["number", "number", "number", "boolean", "string", "null", "object", "array", "number"]
    types = apply(spark, kinds[3:8], H.tag_type)
    assert types == ["numeric", "text", "null", "text", "text"]


def test_duplicate_json_keys_last_wins(spark):
    got = apply(spark, ['{"a":1,"a":2}'], lambda c: F.try_variant_get(H.parse_json_value(c), "$.a", "int"))
    assert got == [2]


def test_first_matching_keeps_array_order(spark):
    df = spark.createDataFrame([(["face", "smoke", "person"],), ([],), (None,)], "t array<string>")
    got = [r[0] for r in df.select(H.first_matching(F.col("t"), ["person", "smoke"])).collect()]
    assert got == ["smoke", None, None]


def test_field_needs_the_right_kind(spark):
    df = column(spark, ['{"n":5,"s":"x","b":true,"q":"5"}'])
    doc = H.parse_json_value(F.col("x"))
    row = df.select(
        H.field(doc, "n", "number", "double"), H.field(doc, "q", "number", "double"),
        H.field(doc, "n", "string", "string"), H.field(doc, "b", "boolean", "boolean"),
        H.field(doc, "b", "number", "double"), H.field(doc, "none", "string", "string"),
    ).first()
    assert tuple(row) == (5.0, None, None, True, None, None)
    assert rows(df.select(H.field(doc, "s", "string", "string"))) == [("x",)]
