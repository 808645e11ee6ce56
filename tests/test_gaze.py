import datetime as dt
import json
import math

from pyspark.sql import functions as F

from conftest import rows, write
from glint.functions import micros
from glint.operators.gaze import (
    calibration_targets, paired_targets, shape_calibration, shape_dots, shape_gaze,
)
from glint.operators.timelines import (
    dot_points, event_log, merge_gaze, mouse_points, recording_markers, with_timelines,
)
from glint.sources import read_calib_tsv, read_dot_tsv, read_tobii


def sample(t, lv, rv, lx=0.2, rx=0.4):
    return {
        "device_time_stamp": 1000 + t, "system_time_stamp": 2000 + t, "true_time": 1491423217.5641239 + t,
        "left_pupil_validity": lv, "right_pupil_validity": rv,
        "left_gaze_origin_validity": lv, "right_gaze_origin_validity": rv,
        "left_gaze_point_validity": lv, "right_gaze_point_validity": rv,
        "left_pupil_diameter": 3.1, "right_pupil_diameter": 3.2,
        "left_gaze_origin_in_user_coordinate_system": [1.0, 2.0, 3.0],
        "right_gaze_origin_in_user_coordinate_system": [1.0, 2.0],
        "left_gaze_origin_in_trackbox_coordinate_system": [0.1, 0.2, 0.3],
        "right_gaze_origin_in_trackbox_coordinate_system": [0.1, 0.2, 0.3],
        "left_gaze_point_in_user_coordinate_system": [4.0, 5.0, 6.0],
        "right_gaze_point_in_user_coordinate_system": [4.0, 5.0, 6.0],
        "left_gaze_point_on_display_area": [lx, 0.5], "right_gaze_point_on_display_area": [rx, 0.7],
    }


def test_gaze_pipeline(spark, tmp):
    lines = [json.dumps(sample(i, lv, rv)) for i, (lv, rv) in enumerate([(1, 1), (1, 0), (0, 1), (0, 0)])]
    nan_line = json.dumps(sample(4, 1, 1)).replace('"left_pupil_diameter": 3.1', '"left_pupil_diameter": NaN')
    write(tmp, "P_01.txt", "\n".join(lines + [nan_line]) + "\n" + lines[0][:40])  # cut-off last line
    write(tmp, "P_02.txt", lines[0])  # complete last line without newline
    raw = read_tobii(spark, f"{tmp}/P_*.txt")
    assert read_tobii(spark, f"{tmp}/P_*.txt", rejects=True).count() == 1
    g = shape_gaze(raw)
    assert g.count() == 6
    r = g.where("pid = 1").orderBy("timestamp").collect()
    assert r[0]["timestamp"] == dt.datetime(2017, 4, 5, 20, 13, 37, 564123)
    assert r[0]["gazepoint_validity"].asDict() == {"left": True, "right": True}
    assert r[0]["gazeorigin_ucs"]["right"].asDict() == {"x": 1.0, "y": 2.0, "z": None}  # short array
    assert math.isnan(r[4]["pupil_diameter"]["left"])
    form = spark.createDataFrame(
        [(1, dt.datetime(2017, 4, 5, 20, 13), dt.datetime(2017, 4, 5, 20, 13, 30), None, (1000, 500))],
        "pid int, init_start timestamp_ntz, webcam_start timestamp_ntz, screen_start timestamp_ntz, "
        "display_resolution struct<w:int,h:int>")
    m = merge_gaze(with_timelines(g, form), form)
    got = sorted((round(r["x"], 6), round(r["y"], 6), r["color"]) for r in m.collect())
    assert got == [
        (200.0, 250.0, [0, 0, 255]),                                  # left eye only
        (300.0, 300.0, [0, 255, 255]), (300.0, 300.0, [0, 255, 255]),  # both: the mean
        (400.0, 350.0, [0, 255, 0]),                                  # right eye only
    ]
    assert m.where("screen_time IS NOT NULL").count() == 0
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan


def test_dots_and_calibration(spark, tmp):
    write(tmp, "P_01/x_final_dot_test_locations.tsv", "Dot_X\tDot_Y\tEpoch\n10\t20\t1491423217564.7\nabc\t5\t1.0\n")
    write(tmp, "P_09/x_final_dot_test_locations.tsv", "Dot_X\tDot_Y\tEpoch\n1\t2\t3.0\n")
    form = spark.createDataFrame([(1, 97)], "pid int, screen_viewport_y int")
    d = shape_dots(read_dot_tsv(spark, f"{tmp}/P_*/*final_dot_test_locations.tsv"), form)
    got = rows(d.select("pid", micros("timestamp").alias("t"), "dot.x", "dot.y"))
    assert got == [(1, 1000, None, 102), (1, 1491423217564000, 10, 117), (9, 3000, 1, None)]
    write(tmp, "P_01/calibration.tsv",
          "point_x\tpoint_y\tprediction_x_left\tprediction_y_left\tvalidity_left\tprediction_x_right\t"
          "prediction_y_right\tvalidity_right\n"
          "0.1\t0.1\t0.11\t0.12\t1\t0.13\t0.14\t0\n"
          "0.5\t0.5\tNaN\t0.52\t-1\t0.53\t0.54\t1\n"
          "0.9\t0.9\tbad\t0.92\t1\t0.93\t0.94\t1\n"
          "0.3\t0.3\t0.31\n")
    c = shape_calibration(read_calib_tsv(spark, f"{tmp}/P_*/calibration.tsv"))
    got = rows(c.select("point.x", "validity.left", "validity.right"))
    assert got == [(0.1, True, False), (0.5, False, True)]


def test_views(spark):
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    lg = spark.createDataFrame([
        (1, 2, "dot_test", "start", "log", t(10), (1, 1)),
        (1, 2, "dot_test", "click", "mouse", t(11), (5, 6)),
        (1, 2, "dot_test", "move", "mouse", t(12), (7, None)),
        (1, 2, "dot_test", "response", "log", t(13), (None, None)),
        (1, 2, "dot_test", "stop", "log", t(14), (None, None)),
        (1, 3, "serp_instructions", "scroll", "scroll", t(15), (None, None)),
        (3, 1, "dot_test", "start", "log", t(1), (0, 0)),
    ], "pid int, record int, study string, event string, source string, timestamp timestamp_ntz, "
       "mouse struct<x:int,y:int>")
    form = spark.createDataFrame([(1, t(0), t(10), t(4))],
                                 "pid int, init_start timestamp_ntz, webcam_start timestamp_ntz, "
                                 "screen_start timestamp_ntz")
    tl = with_timelines(lg, form)
    assert tl.count() == 6  # participant 3 has no form row
    assert rows(tl.where("event = 'click'"), "rec_time", "webcam_time", "screen_time") == [
        (11_000_000, 1_000_000, 7_000_000)]
    assert rows(with_timelines(lg, form, screen=False).where("event='click'"), "screen_time") == [(None,)]
    assert rows(event_log(tl), "event") == [("click",), ("response",), ("start",), ("stop",)]
    assert rows(recording_markers(tl), "record", "study") == [(0, "gap"), (2, "dot_test")]
    assert rows(mouse_points(tl), "mouse", "color") == [([5, 6], [255, 140, 0]), ([7, None], [255, 255, 0])]
    tgt = calibration_targets(lg, form)
    assert rows(tgt, "pid", "timestamp", "weight") == [(1, 0, 0.0), (1, 1000, 1.0), (3, None, 0.0)]  # no form: no clock
    dots = spark.createDataFrame([(1, t(12), (3, 4))], "pid int, timestamp timestamp_ntz, dot struct<x:int,y:int>")
    assert rows(dot_points(with_timelines(dots, form)), "dot", "color") == [([3, 4], [0, 0, 0])]


def test_paired_targets(spark):
    """Rows pair by position; a null frame id keeps its place."""
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    frames = spark.createDataFrame(
        [(1, 1, i, f) for i, f in enumerate((10, None, 30, 40))], "pid int, record int, line bigint, frame bigint")
    pts = spark.createDataFrame(
        [(1, 1, t(3), 3, 3, "move"), (1, 1, t(1), 1, 1, "click"), (1, 1, t(2), None, 2, "move")],
        "pid int, record int, timestamp timestamp_ntz, x int, y int, event string")
    got = paired_targets(frames, pts, ["line"], ["timestamp"], F.floor(F.col("line") / 2), F.second("timestamp"))
    assert rows(got, "id", "x", "y", "w") == [(10, 1, 1, 1.0), (30, 3, 3, 0.5)]
