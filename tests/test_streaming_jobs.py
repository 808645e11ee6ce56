import datetime as dt
import json
import os
import zipfile

from pyspark.sql import functions as F

from conftest import write
from glint.plans.jobs import etl, load_table, prepare
from glint.streaming import log_stream, start_log_sink
from test_form import HEADER, ROWS, SPEC
from test_gaze import sample
from test_log import LOG


def make_dataset(root):
    write(root, "participant_characteristics.csv", "\n".join([HEADER, *ROWS]) + "\n")
    for pid in ("01", "06"):
        write(root, f"P_{pid}/1491423217564.json", json.dumps(LOG))
        write(root, f"P_{pid}/P_{pid}.txt", "\n".join(json.dumps(sample(i, 1, i % 2)) for i in range(20)) + "\n")
        write(root, f"P_{pid}/P_{pid}_specs.txt", SPEC)
        write(root, f"P_{pid}/x_final_dot_test_locations.tsv", "Dot_X\tDot_Y\tEpoch\n1\t2\t1491423218000.5\n")
        write(root, f"P_{pid}/calibration.tsv",
              "point_x\tpoint_y\tprediction_x_left\tprediction_y_left\tvalidity_left\tprediction_x_right\t"
              "prediction_y_right\tvalidity_right\n0.1\t0.1\t0.1\t0.1\t1\t0.1\t0.1\t1\n")


def test_etl_and_prepare(spark, tmp):
    raw, out, views = (os.path.join(tmp, d) for d in ("raw", "tidy", "views"))
    make_dataset(raw)
    done = etl(spark, raw, out)
    assert done == ["form", "log", "tobii", "dot", "calib"]
    assert load_table(spark, out, "form").count() == 2
    assert load_table(spark, out, "log").count() == 2 * len(LOG)
    assert load_table(spark, out, "tobii").count() == 40
    assert load_table(spark, out, "dot").where("dot.y = 2 + 97").count() == 1
    clips = spark.createDataFrame([(1, 2, "dot_test", 9_000_000)], "pid int, record int, study string, duration bigint")
    frames = spark.createDataFrame([(1, "webcam", 0), (6, "screen", 40)], "pid int, video string, frame bigint")
    made = prepare(spark, out, views, clips=clips, frames=frames)
    assert "gaze" in made and "timeline" in made
    assert spark.read.parquet(f"{views}/gaze").count() == 40
    assert spark.read.parquet(f"{views}/timeline").where("accepted").count() == 1
    assert spark.read.option("header", True).csv(f"{views}/targets").count() > 0

    zpath = os.path.join(tmp, "raw.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for dirpath, _, files in os.walk(raw):
            for f in files:
                full = os.path.join(dirpath, f)
                z.write(full, "ds/" + os.path.relpath(full, raw))
    zout = os.path.join(tmp, "tidy_zip")
    etl(spark, zpath, zout, layout="zip", process=["log", "tobii", "form"])
    assert load_table(spark, zout, "log").count() == 2 * len(LOG)
    assert load_table(spark, zout, "tobii").count() == 40
    assert load_table(spark, zout, "form").count() == 2


def test_log_stream(spark, tmp):
    src, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    write(src, "P_01/a.json", json.dumps(LOG))
    form = spark.createDataFrame(
        [(1, dt.datetime(2017, 4, 5, 20, 13), dt.datetime(2017, 4, 5, 20, 13, 37), None)],
        "pid int, init_start timestamp_ntz, webcam_start timestamp_ntz, screen_start timestamp_ntz")
    q = start_log_sink(log_stream(spark, f"{src}/P_*", form), out, name="t_stream",
                       checkpoint=os.path.join(tmp, "ckpt"), available_now=True)
    q.awaitTermination(120)
    first = spark.read.parquet(out).count()
    assert first == len(LOG)
    write(src, "P_01/b.json", json.dumps(LOG[:3]))
    q = start_log_sink(log_stream(spark, f"{src}/P_*", form), out, name="t_stream",
                       checkpoint=os.path.join(tmp, "ckpt"), available_now=True)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == first + 3  # resumed, old file not read again
    assert spark.read.parquet(out).where("rec_time IS NOT NULL").count() == first + 3


def test_command_line(spark, tmp):
    from glint.__main__ import main

    raw, out, views = (os.path.join(tmp, d) for d in ("raw", "tidy", "views"))
    make_dataset(raw)
    assert main(["etl", raw, "--output-path", out, "--process", "form", "log", "tobii"]) == ["form", "log", "tobii"]
    assert main(["etl", raw, "--output-path", out, "--dry-run"]) == ["form", "log", "tobii", "dot", "calib"]
    assert not os.path.exists(os.path.join(out, "dot.parquet"))
    done = main(["prepare", out, "--output-path", views, "--process", "events", "gaze", "timeline"])
    assert done == ["events", "gaze"]  # no clip table given: no timeline
    assert spark.read.parquet(f"{views}/events").count() > 0


def test_align_first_and_screen_list(spark, tmp):
    from glint.operators.timelines import with_timelines

    raw, a, b = (os.path.join(tmp, d) for d in ("raw", "plain", "first"))
    make_dataset(raw)
    align = write(tmp, "align.csv", "video,frameshift,corrOptimal,corrOrig\n"
                  "P_01/1491423217564_2_-study-dot_test.webm,0.5,,\n")
    etl(spark, raw, a, process=["form", "log"], alignment_path=align)
    etl(spark, raw, b, process=["form", "log"], alignment_path=align, align_first=True)
    fa = {r["pid"]: r["webcam_start"] for r in load_table(spark, a, "form").collect()}
    fb = {r["pid"]: r["webcam_start"] for r in load_table(spark, b, "form").collect()}
    assert fa[1] - fb[1] == dt.timedelta(milliseconds=500)  # first start shifted by the clip's 0.5 s
    assert fa[6] == fb[6]
    shifted = load_table(spark, a, "log").where("pid = 1 AND record = 2").count()
    assert shifted == load_table(spark, b, "log").where("pid = 1 AND record = 2").count()
    form = load_table(spark, a, "form").withColumn("screen_start", F.col("webcam_start"))
    tl = with_timelines(load_table(spark, a, "log"), form, screen=spark.createDataFrame([(6,)], "pid int"))
    assert tl.where("pid = 1 AND screen_time IS NOT NULL").count() == 0
    assert tl.where("pid = 6 AND screen_time IS NULL").count() == 0


def test_gaze_view_has_no_shuffle(spark, tmp):
    from glint.plans.jobs import views

    raw, out = os.path.join(tmp, "raw"), os.path.join(tmp, "tidy")
    make_dataset(raw)
    etl(spark, raw, out, process=["form", "log", "tobii"])
    gaze = views(spark, out)["gaze"]()
    plan = gaze.sortWithinPartitions("pid", "timestamp")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan  # the form goes to the samples
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


def test_tobii_table_has_no_shuffle(spark, tmp):
    from glint.plans.jobs import tidy_tables

    raw = os.path.join(tmp, "raw")
    make_dataset(raw)
    tobii = tidy_tables(spark, raw)["tobii"]()
    plan = tobii.sortWithinPartitions("pid", "timestamp")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_etl_counts_in_the_writing_pass(spark, tmp):
    import pytest

    raw, out = os.path.join(tmp, "raw"), os.path.join(tmp, "tidy")
    make_dataset(raw)
    clean = etl(spark, raw, out, process=["log", "tobii"], strict=False)
    assert clean.counts == {"log": {"rows": 2 * len(LOG), "rejects": 0}, "tobii": {"rows": 40, "rejects": 0}}
    assert load_table(spark, out, "log_rejects").count() == load_table(spark, out, "tobii_rejects").count() == 0
    assert etl(spark, raw, out, process=["log"]).counts == {}  # there already
    samples = [json.dumps(sample(i, 1, 1)) for i in range(3)]
    write(raw, "P_07/7.json", json.dumps([*LOG[:2], LOG[0] | {"epoch": "abc"}]))
    write(raw, "P_07/P_07.txt", "\n".join([samples[0], samples[1][:60], samples[2]]) + "\n")
    bad = etl(spark, raw, f"{out}2", process=["log", "tobii"], strict=False)
    assert bad.counts == {"log": {"rows": 2 * len(LOG) + 2, "rejects": 1}, "tobii": {"rows": 42, "rejects": 1}}
    for name in ("log", "tobii"):
        assert load_table(spark, f"{out}2", f"{name}_rejects").count() == bad.counts[name]["rejects"]
    for name in ("log", "tobii"):  # strict: an error, and no table
        with pytest.raises(Exception, match="no eye-tracker sample|not a log event"):
            etl(spark, raw, f"{out}3", process=[name])
        assert not os.path.exists(os.path.join(f"{out}3", name)) and not os.path.exists(os.path.join(f"{out}3", f"{name}.parquet"))
    write(raw, "P_07/P_07.txt", "\n".join([samples[0], samples[1][:60]]))  # cut off at the end
    assert etl(spark, raw, f"{out}3", process=["tobii"]).counts == {"tobii": {"rows": 41, "rejects": 1}}


def test_streamed_views_equal_the_batch(spark, tmp):
    """D12-D16 from three streams, files arriving in several batches."""
    from glint.plans.jobs import views
    from glint.streaming import start_views

    raw, out, live = (os.path.join(tmp, d) for d in ("raw", "tidy", "live"))
    make_dataset(raw)
    etl(spark, raw, out)
    want = views(spark, out)
    form = load_table(spark, out, "form")
    globs = {"log": "P_*/*.json", "tobii": "P_*/{P_[0-9],P_[0-9]*[0-9]}.txt", "dot": "P_*/*final_dot_test_locations.tsv"}
    for _ in range(2):  # the second run finds nothing new
        for kind, glob in globs.items():
            q = start_views(spark, kind, f"{raw}/{glob}", form, live, os.path.join(tmp, "ck", kind), available_now=True, max_files=1)
            q.awaitTermination(120)
    for name in ("events", "markers", "mouse", "gaze", "dots"):
        got = spark.read.parquet(f"{live}/{name}")
        assert got.select("batch").distinct().count() == 2
        table = want[name]()
        plain = lambda df: sorted(df.select([F.col(c).cast("string") for c in table.columns]).collect(), key=str)
        assert plain(got) == plain(table), name


def test_a_stream_is_loud_or_sets_aside(spark, tmp):
    import pytest

    from glint.streaming import start_views

    form = spark.createDataFrame(
        [(1, dt.datetime(2017, 4, 5, 20, 13), dt.datetime(2017, 4, 5, 20, 13, 37), None)],
        "pid int, init_start timestamp_ntz, webcam_start timestamp_ntz, screen_start timestamp_ntz")
    src = os.path.join(tmp, "in")
    write(src, "P_01/a.json", json.dumps(LOG)[:-20])  # cut off
    write(src, "P_01/b.json", json.dumps([*LOG, LOG[0] | {"epoch": "abc"}]))
    write(src, "P_01/P_01.txt", "\n".join([json.dumps(sample(0, 1, 1)), "noise", json.dumps(sample(1, 1, 1))]) + "\n")
    go = lambda kind, glob, n, strict: start_views(
        spark, kind, f"{src}/{glob}", form, os.path.join(tmp, n), os.path.join(tmp, f"ck{n}"), strict, True).awaitTermination(120)
    with pytest.raises(Exception, match="no JSON array|not a log event"):
        go("log", "P_*/*.json", "loud", True)
    assert os.listdir(os.path.join(tmp, "loud", "log")) == []
    q = start_log_sink(log_stream(spark, f"{src}/P_*/*.json"), os.path.join(tmp, "o"), os.path.join(tmp, "c"), available_now=True)
    with pytest.raises(Exception, match="no JSON array|not a log event"):
        q.awaitTermination(120)
    go("log", "P_*/*.json", "calm", False)
    assert spark.read.parquet(f"{tmp}/calm/log").count() == len(LOG)
    assert spark.read.parquet(f"{tmp}/calm/log_rejects").count() == 2
    form = form.withColumn("display_resolution", F.struct(F.lit(1440).alias("w"), F.lit(900).alias("h")))
    with pytest.raises(Exception, match="sample"):
        go("tobii", "P_*/P_*.txt", "loudly", True)
    go("tobii", "P_*/P_*.txt", "calmly", False)
    assert spark.read.parquet(f"{tmp}/calmly/tobii").count() == 2 and spark.read.parquet(f"{tmp}/calmly/tobii_rejects").first()["value"] == "noise"
