from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from glint.operators.ordering import prefix_last, prefix_sum, row_index


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 50), st.one_of(st.none(), st.integers(-9, 9))),
                min_size=1, max_size=60))
def test_bucketed_matches_windows(spark, data):
    data = [(k, t, i, v) for i, (k, t, v) in enumerate(data)]
    df = spark.createDataFrame(data, "k int, t int, id int, v int")
    w = Window.partitionBy("k").orderBy("t", "id")
    want = {r["id"]: r["n"] for r in df.select("id", (F.row_number().over(w) - 1).alias("n")).collect()}
    got = {r["id"]: r["index"] for r in row_index(df, ["k"], ["t", "id"], F.floor(F.col("t") / 7)).collect()}
    assert got == want
    idx = row_index(df, ["k"], ["t", "id"]).withColumnRenamed("index", "i")
    wi = Window.partitionBy("k").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    ref = idx.select("id", F.coalesce(F.sum("v").over(wi), F.lit(0)).alias("s"),
                     F.last("v", ignorenulls=True).over(wi).alias("l"))
    want2 = {r["id"]: (r["s"], r["l"]) for r in ref.collect()}
    s = {r["id"]: r["s"] for r in prefix_sum(idx, ["k"], "i", "v", "s", bucket_size=3).collect()}
    last = {r["id"]: r["l"] for r in prefix_last(idx, ["k"], "i", "v", "l", bucket_size=3).collect()}
    assert {k: (s[k], last[k]) for k in s} == want2


def test_null_keys_have_prefixes(spark):
    from glint.operators.ordering import prefixes

    df = spark.createDataFrame([(None, 0, 5), (None, 1, 7), (1, 0, 2)], "k int, i bigint, v bigint")
    out = prefixes(df, ["k"], "i", {"before": ("sum", "v")}, bucket_size=1)
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 0, 2, 0), (None, 0, 5, 0), (None, 1, 7, 5)]
