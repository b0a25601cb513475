"""The chunked scans must equal the plain windows, also for a hot key."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from hearthstream.operators import ordered as O
from helpers import rows


def frame(spark, values):
    return spark.createDataFrame([(k, t, i, v) for i, (k, t, v) in enumerate(values)], "k string, t bigint, i int, v int")


def check(spark, values, width):
    df = frame(spark, values)
    order = ["t", "i"]
    plain = Window.partitionBy("k").orderBy(*order)
    chunked = O.with_chunk(df, F.col("t"), width)
    lagged = O.previous_row(chunked, ["k"], order, ["v"], "p").select("i", "p.v")
    assert rows(lagged) == rows(df.select("i", F.lag("v").over(plain)))
    highest = O.max_before(chunked, ["k"], order, "v", "p").select("i", "p")
    assert rows(highest) == rows(df.select("i", F.max("v").over(plain.rowsBetween(Window.unboundedPreceding, -1))))
    total = O.running_sum(chunked, ["k"], order, "v", "p").select("i", "p")
    assert rows(total) == rows(df.select("i", F.sum("v").over(plain.rowsBetween(Window.unboundedPreceding, 0))))


row = st.tuples(st.sampled_from("aab"), st.integers(-50, 50), st.integers(-5, 5))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(row, min_size=1, max_size=40), width=st.sampled_from([1, 7, 1000]))
def test_chunked_scans_equal_windows(spark, values, width):
    check(spark, values, width)


def test_hot_key(spark):
    values = [("hot" if i % 3 == 0 else f"k{i % 50}", (i * 7919) % 5000, i % 13) for i in range(6000)]
    check(spark, values, 100)


def test_chunks_spread_a_hot_key(spark):
    values = [("hot", t, 1) for t in range(5000)]
    sizes = O.with_chunk(frame(spark, values), F.col("t"), 100).groupBy("k", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] == 100


@pytest.mark.parametrize("null_key", [True])
def test_null_keys_are_a_group(spark, null_key):
    check(spark, [(None, 1, 1), (None, 200, 2), ("a", 3, 4)], 10)
