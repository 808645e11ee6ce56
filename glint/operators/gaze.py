"""Eye-tracker and target operators: D6 shape_gaze, D7 shape_dots, D8
shape_calibration, D17 calibration_targets / paired_targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import diff_ms, from_micros, from_millis, micros, to_struct, value_map
from ..schemas import CALIBRATION_STUDIES, TARGET_WEIGHTS
from .ordering import row_index

XYZ = ("x", "y", "z")
XY = ("x", "y")


def _pair(left: Column, right: Column) -> Column:
    return F.struct(left.alias("left"), right.alias("right"))


def shape_gaze(raw: DataFrame) -> DataFrame:
    """Eye-tracker samples (TOBII_JSON_SCHEMA + pid) to the tidy gaze
    table: clocks as timestamps, validity codes as booleans, fixed arrays as
    named points, every measure as a left/right pair.

    `true_time` (epoch seconds) is kept to the microsecond; `duration` is the
    device clock as a timestamp, as in the source data."""
    def side(s: str, name: str) -> Column:
        return F.col(f"{s}_{name}")

    def both(name: str, fn=lambda c: c) -> Column:
        return _pair(fn(side("left", name)), fn(side("right", name)))

    valid = lambda c: c.cast("boolean")
    pts3 = lambda c: to_struct(c, XYZ)
    pts2 = lambda c: to_struct(c, XY)
    return raw.select(
        F.col("pid").cast("int").alias("pid"),
        from_micros((F.col("true_time") * F.lit(1e6)).cast("bigint")).alias("timestamp"),
        from_micros("system_time_stamp").alias("clock"),
        from_micros("device_time_stamp").alias("duration"),
        both("pupil_validity", valid).alias("pupil_validity"),
        both("pupil_diameter").alias("pupil_diameter"),
        both("gaze_point_validity", valid).alias("gazepoint_validity"),
        both("gaze_point_on_display_area", pts2).alias("gazepoint_display"),
        both("gaze_point_in_user_coordinate_system", pts3).alias("gazepoint_ucs"),
        both("gaze_origin_validity", valid).alias("gazeorigin_validity"),
        both("gaze_origin_in_trackbox_coordinate_system", pts3).alias("gazeorigin_trackbox"),
        both("gaze_origin_in_user_coordinate_system", pts3).alias("gazeorigin_ucs"),
    )


def shape_dots(raw: DataFrame, form: DataFrame | None = None) -> DataFrame:
    """Dot-test rows (Dot_X, Dot_Y, Epoch ms, pid) to (pid, timestamp,
    dot{x, y}); with a form, y is moved by the browser viewport offset of
    the participant's setting (null when the participant has no form)."""
    dots = raw.select(
        F.col("pid").cast("int").alias("pid"),
        from_millis("Epoch").alias("timestamp"),
        F.col("Dot_X").alias("x"),
        F.col("Dot_Y").alias("y"),
    )
    if form is not None:
        off = form.select("pid", F.col("screen_viewport_y").alias("_oy"))
        dots = dots.join(off, "pid", "left").withColumn("y", F.col("y") + F.col("_oy"))
    return dots.select("pid", "timestamp", F.struct("x", "y").alias("dot"))


def shape_calibration(raw: DataFrame) -> DataFrame:
    """Calibration rows (CALIB_TSV_SCHEMA + pid) with any null dropped
    (NaN is a value and stays), validity codes > 0 as booleans."""
    cols = [c for c in raw.columns]
    complete = raw.where(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in cols)))
    return complete.select(
        F.col("pid").cast("int").alias("pid"),
        F.struct(F.col("point_x").alias("x"), F.col("point_y").alias("y")).alias("point"),
        _pair(F.col("validity_left") > 0, F.col("validity_right") > 0).alias("validity"),
        F.struct(F.col("prediction_x_left").alias("x"), F.col("prediction_y_left").alias("y")).alias("left"),
        F.struct(F.col("prediction_x_right").alias("x"), F.col("prediction_y_right").alias("y")).alias(
            "right"
        ),
    )


def calibration_targets(log: DataFrame, form: DataFrame) -> DataFrame:
    """Mouse points of the dot test and Fitts' law pages as
    calibration targets: ms since the webcam start (cut toward zero),
    screen x/y, weight 1.0 click, 0.5 move, 0.0 otherwise."""
    pts = log.select(
        "pid", "study", "timestamp",
        F.col("mouse.x").alias("x"), F.col("mouse.y").alias("y"), "event",
    ).where(F.col("study").isin(CALIBRATION_STUDIES) & F.col("x").isNotNull() & F.col("y").isNotNull())
    pts = pts.join(form.select("pid", "webcam_start"), "pid", "left")
    return pts.select(
        "pid", "study",
        diff_ms("timestamp", "webcam_start").alias("timestamp"),
        F.col("x").alias("screen_x"),
        F.col("y").alias("screen_y"),
        "event",
        "webcam_start",
        value_map("event", TARGET_WEIGHTS, 0.0).cast("double").alias("weight"),
    )


def paired_targets(
    frames: DataFrame,
    points: DataFrame,
    frame_order: list[str],
    point_order: list[str],
    frame_bucket: Column | None = None,
    point_bucket: Column | None = None,
) -> DataFrame:
    """The n-th row of a recording's frames paired with its n-th mouse
    point (horizontal concat per (pid, record)); the longer side's surplus
    has no partner and is dropped, then rows with a null: a null frame id
    keeps its place.

    frames: (pid, record, frame, ...); points: (pid, record, x, y, event,
    ...). The orders name the columns that hold the position (file order,
    time). Rows are numbered by `row_index` in buckets, which must never
    decrease along the order, so a long recording is not numbered in one
    task. Without buckets each recording is numbered where it lies: over
    tables bucketed by (pid, record) nothing is shuffled."""
    f = row_index(frames, ["pid", "record"], frame_order, frame_bucket, "_n")
    p = row_index(points, ["pid", "record"], point_order, point_bucket, "_n")
    p = p.select(
        "pid", "record", "_n", "x", "y",
        F.when(F.col("event") == "click", F.lit(1.0)).otherwise(F.lit(0.5)).alias("w"),
    )
    out = f.select("pid", "record", "_n", F.col("frame").alias("id")).join(
        p, ["pid", "record", "_n"], "inner"
    )
    return out.where(
        F.col("id").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull()
    ).select("pid", "record", "id", "x", "y", "w")
