import datetime as dt
import glob
import os

import pyarrow.parquet as pq

from glint.sinks import build_tables, form_json, write_csv, write_partitioned, write_table


def test_write_table_ignore_and_overwrite(spark, tmp):
    p = os.path.join(tmp, "t")
    write_table(spark.range(3), p)
    write_table(spark.range(5), p)  # kept: no overwrite
    assert spark.read.parquet(p).count() == 3
    write_table(spark.range(5), p, overwrite=True)
    assert spark.read.parquet(p).count() == 5
    write_table(spark.range(7), os.path.join(tmp, "dry"), dry_run=True)
    assert not os.path.exists(os.path.join(tmp, "dry"))


def test_partitioned_sorted(spark, tmp):
    t0 = dt.datetime(2024, 1, 1)
    data = [(1 if i % 3 else 2, t0 + dt.timedelta(seconds=(i * 7919) % 1000), i) for i in range(600)]
    df = spark.createDataFrame(data, "pid int, timestamp timestamp_ntz, v int")
    p = os.path.join(tmp, "tobii")
    write_partitioned(df, p, files=6)
    files = sorted(glob.glob(f"{p}/pid=1/*.parquet"))
    assert len(files) > 1  # the big participant is written by several tasks
    for f in files:
        ts = pq.read_table(f).column("timestamp").to_pylist()
        assert ts == sorted(ts)
    back = spark.read.parquet(p)
    assert back.where("pid = 2").count() == 200
    plan = back.where("pid = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pid" in plan
    ns = os.path.join(tmp, "noshuffle")
    write_partitioned(df.repartition(3), ns, shuffle=False)
    for f in glob.glob(f"{ns}/pid=*/*.parquet"):
        ts = pq.read_table(f).column("timestamp").to_pylist()
        assert ts == sorted(ts)
    assert spark.read.parquet(ns).count() == 600
    c = os.path.join(tmp, "csv")
    write_partitioned(df, c, fmt="csv")
    first = open(sorted(glob.glob(f"{c}/pid=2/*.csv"))[0]).readline()
    assert first.strip() == "timestamp,v"  # key left out of the files
    b = os.path.join(tmp, "bucketed")
    write_partitioned(df, b, bucket_mod=4)
    assert sorted(d for d in os.listdir(b) if d.startswith("pid_bucket=")) == ["pid_bucket=1", "pid_bucket=2"]


def test_json_and_builders(spark, tmp):
    f = spark.createDataFrame([(1, dt.datetime(2017, 4, 5, 20, 13, 37, 564000), (1440, 900))],
                              "pid int, init_start timestamp_ntz, display_resolution struct<w:int,h:int>")
    j = form_json(f).first()["json"]
    assert '"init_start":"2017-04-05T20:13:37.564000"' in j and '"display_resolution":{"w":1440,"h":900}' in j
    out = {}
    done = build_tables({"form": lambda: f, "log": lambda: spark.range(2)}, {"form"},
                        lambda n, d: out.setdefault(n, d.count()))
    assert done == ["form"] and out == {"form": 1}
    write_csv(spark.range(3), os.path.join(tmp, "targets"))
    assert spark.read.option("header", True).csv(os.path.join(tmp, "targets")).count() == 3


def test_a_killed_write_is_done_again(spark, tmp):
    """What a killed job left is no finished table; a failing write leaves
    the old table as it was."""
    import pytest
    from pyspark.sql import functions as F

    for put in (lambda d, p, **k: write_table(d, p, keys=["id"], **k), lambda d, p, **k: write_table(d, p, **k)):
        p = os.path.join(tmp, f"t{len(os.listdir(tmp))}")
        os.makedirs(os.path.join(p, "_temporary", "0"))
        with open(os.path.join(p, "part-0.parquet"), "w") as f:
            f.write("cut off")
        put(spark.range(4), p)
        assert spark.read.parquet(p).count() == 4 and not os.path.exists(os.path.join(p, "_temporary"))
        put(spark.range(9), p)
        assert spark.read.parquet(p).count() == 4  # finished: kept
        bad = spark.range(9).withColumn("x", F.when(F.col("id") == 7, F.raise_error(F.lit("stop"))).cast("int"))
        with pytest.raises(Exception, match="stop"):
            put(bad, p, overwrite=True)
        assert spark.read.parquet(p).count() == 4
        assert [n for n in os.listdir(tmp) if n.startswith(".")] == []  # nothing staged is left


def test_range_partitioned_writes_compute_their_input_once(spark, tmp):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    seen = Observation("once")
    df = spark.range(1_000).observe(seen, F.count(F.lit(1)).alias("n"))
    write_table(df, os.path.join(tmp, "t"), keys=["id"])
    assert seen.get["n"] == 1_000
