"""A participant with most of the rows is processed by several tasks."""

import datetime as dt

from pyspark.sql import functions as F

from glint.operators.ordering import prefix_last, prefix_sum, row_index
from glint.operators.recordings import recording_durations

T0 = dt.datetime(2024, 1, 1)


def skewed(spark, hot=40_000, cold=50):
    rows = [(1, i) for i in range(hot)] + [(p, i) for p in range(2, 12) for i in range(cold)]
    df = spark.createDataFrame(rows, "pid int, n int")
    return df.withColumn("t", F.col("n") * 997 % 100_003).withColumn(
        "timestamp", F.timestamp_add("SECOND", F.col("t"), F.lit(T0).cast("timestamp_ntz")))


def tasks_of_hot(df, pid=1):
    """Tasks that hold rows of `pid` after the last shuffle (AQE would merge
    partitions this small into one, so its coalescing is off here)."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return df.where(F.col("pid") == pid).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_bucketed_numbering_spreads_hot_key(spark):
    df = skewed(spark)
    idx = row_index(df, ["pid"], ["t", "n"], bucket=F.floor(F.col("t") / 5000))
    assert tasks_of_hot(idx) > 1
    got = idx.where("pid = 1").agg(F.min("index"), F.max("index"), F.countDistinct("index")).first()
    assert tuple(got) == (0, 39_999, 40_000)
    s = prefix_sum(idx.withColumn("one", F.lit(1)), ["pid"], "index", "one", "before", bucket_size=1000)
    assert tasks_of_hot(s) > 1
    assert s.where("pid = 1 AND before != index").count() == 0
    last = prefix_last(idx.withColumn("v", F.when(F.col("index") % 7 == 0, F.col("index"))),
                       ["pid"], "index", "v", "prev", bucket_size=1000)
    bad = last.where("pid = 1 AND index > 0 AND prev != index - 1 - (index - 1) % 7")
    assert bad.count() == 0


def test_durations_on_a_hot_participant(spark):
    df = skewed(spark, hot=20_000, cold=20)
    log = df.select(
        "pid", (F.col("n") % 40 + 2).alias("record"), F.lit("dot_test").alias("study"),
        F.when(F.col("n") % 3 == 0, "stop").otherwise("start").alias("event"), "timestamp")
    d = recording_durations(log, dedupe=True)
    assert d.count() == log.where("event = 'start'").count()  # no row multiplication
    # each recording ends at its latest stop
    stops = {}
    for r in log.where("event = 'stop'").collect():
        k = (r["pid"], r["record"])
        stops[k] = max(stops.get(k, r["timestamp"]), r["timestamp"])
    sample = d.where("pid = 1").limit(200).collect()
    for r in sample:
        k = (r["pid"], r["record"])
        if k in stops:
            assert r["stop"] == stops[k]
