import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from glint.functions import (
    diff_ms, duration_text_us, from_micros, from_millis, hms_to_us, micros, pid_from_name,
    split_part, strip_affixes, study_ord, to_struct, value_map,
)


def one(spark, col, value=None, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("text,us", [
    ("11s 733ms", 11_733_000),
    ("2m 34s 29ms", 154_029_000),
    ("1w2d3h4m5s6ms7us", ((((7 + 2) * 24 + 3) * 60 + 4) * 60 + 5) * 1_000_000 + 6_007),
    ("1.5S", 1_500_000),
    ("1s 2s", 2_000_000),
    ("3 M", 180_000_000),
    ("", None), ("5x", None), ("1s!", None), ("   ", None), (None, None),
])
def test_duration_text(spark, text, us):
    assert one(spark, duration_text_us(F.col("v")), text) == us


def test_duration_text_strict_raises(spark):
    with pytest.raises(Exception, match="not a duration"):
        one(spark, duration_text_us(F.col("v"), strict=True), "5x")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 999), st.sampled_from(["w", "d", "h", "m", "s", "ms", "us"])),
                min_size=1, max_size=6))
def test_duration_text_roundtrip(spark, parts):
    factor = {"w": 604800e6, "d": 86400e6, "h": 3600e6, "m": 60e6, "s": 1e6, "ms": 1e3, "us": 1}
    last = {}
    for n, u in parts:
        last[u] = n
    text = " ".join(f"{n}{u}" for n, u in parts)
    assert one(spark, duration_text_us(F.col("v")), text) == int(sum(factor[u] * n for u, n in last.items()))


def test_clock_conversions(spark):
    df = spark.createDataFrame([(1_491_423_217_564,)], "ms long")
    r = df.select(from_millis("ms").alias("t")).select("t", micros("t").alias("us")).first()
    assert r["t"] == dt.datetime(2017, 4, 5, 20, 13, 37, 564000)
    assert r["us"] == 1_491_423_217_564_000
    back = df.select(from_micros(F.col("ms") * 1000).alias("t")).first()["t"]
    assert back == r["t"]
    neg = df.select(diff_ms(from_millis(F.col("ms")), from_micros(F.col("ms") * 1000 + 1500)).alias("d"))
    assert neg.first()["d"] == -1  # cut toward zero


def test_text_helpers(spark):
    assert one(spark, split_part(F.col("v"), "_", 1), "1491_2_/study/x") == "2"
    assert one(spark, split_part(F.col("v"), "_", 5), "a_b") is None
    assert one(spark, strip_affixes(F.col("v"), "/study/", ".htm"), "/study/dot_test.htm") == "dot_test"
    assert one(spark, strip_affixes(F.col("v"), "/study/", ".htm"), "x/study/y.html") == "x/study/y.html"
    assert one(spark, hms_to_us(F.col("v")), "1:02:03") == 3_723_000_000
    assert one(spark, pid_from_name(F.col("v")), "data/P_07/x.json") == 7
    assert one(spark, pid_from_name(F.col("v"), strict=False), "data/x.json") is None
    with pytest.raises(Exception, match="no participant in path"):
        one(spark, pid_from_name(F.col("v")), "data/x.json")


def test_value_map_and_struct(spark):
    m = {"mouseclick": "click"}
    assert one(spark, value_map(F.col("v"), m), "mouseclick") == "click"
    assert one(spark, value_map(F.col("v"), m), "response") == "response"
    assert one(spark, value_map(F.col("v"), m), None) is None
    assert one(spark, value_map(F.col("v"), {"click": 1.0}, 0.0), "x") == 0.0
    s = spark.createDataFrame([([1.0, 2.0],), ([3.0],), (None,)], "a array<double>")
    got = [r["p"] for r in s.select(to_struct("a", ("x", "y")).alias("p")).collect()]
    assert got[0].asDict() == {"x": 1.0, "y": 2.0}
    assert got[1].asDict() == {"x": 3.0, "y": None}
    assert got[2] is None
    assert one(spark, study_ord(F.col("v")), "dot_test") == 1
    assert one(spark, study_ord(F.col("v")), "nope") is None
