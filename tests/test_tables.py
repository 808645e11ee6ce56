"""Tables prepared for joins without a shuffle and for point reads."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from glint.operators.gaze import paired_targets
from glint.operators.log import align_log
from glint.operators.recordings import recording_durations
from glint.plans.jobs import bucket_study
from glint.sinks import bucketed_table, write_bucketed, write_table

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def tidy_log(spark):
    ev = F.element_at(F.array(*map(F.lit, ["start", "stop", "click", "move"])), (F.col("id") * 7 % 4 + 1).cast("int"))
    return spark.range(4_000).select(
        (F.col("id") % 13).cast("int").alias("pid"), (F.col("id") * 3 % 11).cast("int").alias("record"),
        F.lit("dot_test").alias("study"), ev.alias("event"), F.timestamp_add("SECOND", F.col("id"), F.lit(T0)).cast("timestamp_ntz").alias("timestamp"),
        (F.col("id") % 100).cast("double").alias("x"), (F.col("id") % 70).cast("double").alias("y"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_of_bucketed_tables_need_no_shuffle(spark, tmp, tidy_log):
    tidy_log.write.parquet(f"{tmp}/tidy/log.parquet")
    shifts = spark.range(60).select(
        (F.col("id") % 13).cast("int").alias("pid"), (F.col("id") % 11).cast("int").alias("record"),
        F.lit("dot_test").alias("study"), (F.col("id") * 1_000).alias("frameshift"))
    assert bucket_study(spark, f"{tmp}/tidy", f"{tmp}/b", shifts, buckets=6) == ["log", "ends", "shifts"]
    frames = tidy_log.where("event = 'stop'").select("pid", "record", F.unix_micros(F.col("timestamp").cast("timestamp")).alias("frame"))
    write_bucketed(frames, f"{tmp}/b/frames", ["pid", "record"], 6)
    log, ends, shift, frame = (bucketed_table(spark, f"{tmp}/b/{n}") for n in ("log", "ends", "shifts", "frames"))
    assert log.columns == tidy_log.columns and len([f for f in os.listdir(f"{tmp}/b/log") if f.endswith(".parquet")]) <= 6

    def pairs(f, points, buckets):
        p = points.where("event IN ('click', 'move')")
        at = F.floor(F.unix_seconds(F.col("timestamp").cast("timestamp")) / 600)
        return paired_targets(f, p, ["frame"], ["timestamp"], *([F.floor(F.col("frame") / 600_000_000), at] if buckets else []))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for got, want in (
            (recording_durations(log, ends=ends), recording_durations(tidy_log)),
            (align_log(log, shift), align_log(tidy_log, shifts)),
            (pairs(frame, log, False), pairs(frames, tidy_log, True)),
        ):
            assert "Exchange" not in plan(got) and "Exchange" in plan(want)
            assert rows(got) == rows(want) and got.count() > 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def bloom_filters(spark, path, column):
    """(row groups, those with a Bloom filter for the column) in the footers."""
    jvm, n, held = spark.sparkContext._jvm, 0, 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for f in os.listdir(path):
        if f.endswith(".parquet"):
            file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(f"{path}/{f}"), conf)
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
            for g in reader.getFooter().getBlocks():
                n += 1
                held += any(c.getPath().toDotString() == column and c.getBloomFilterOffset() > 0 for c in g.getColumns())
            reader.close()
    return n, held


def test_a_point_read_skips_row_groups(spark, tmp):
    studies = F.element_at(F.array(*[F.lit(f"s{i}") for i in range(40)]), (F.floor(F.col("id") / 5_000) * 7 % 40 + 1).cast("int"))
    df = spark.range(200_000).select((F.col("id") * 104_729 % 900_001).alias("pid"), studies.alias("study"), F.rand(1).alias("v")).coalesce(1)
    write_table(df, f"{tmp}/t", compression="zstd", points=["pid", "study"], row_group=100_000)
    for c in ("pid", "study"):
        n, held = bloom_filters(spark, f"{tmp}/t", c)
        assert n == held >= 5
    assert bloom_filters(spark, f"{tmp}/t", "v")[1] == 0

    def read(where):
        """(rows found, rows that the scan gave to the filter)."""
        got = spark.read.parquet(f"{tmp}/t").where(where)
        found = got.collect()
        p = got._jdf.queryExecution().executedPlan()
        while "Scan" not in p.nodeName():
            p = p.children().head() if p.children().size() else p.executedPlan()
        return len(found), p.metrics().apply("numOutputRows").value()

    found, scanned = read("pid = 104729")
    assert found == 1 and scanned < 100_000
    assert read("pid = 450000")[1] < 100_000
    found, scanned = read("study = 's8'")
    assert found == 5_000 and scanned < 100_000
