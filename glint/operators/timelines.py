"""Multi-clock views: D11 with_timelines, D12 event_log, D13
recording_markers, D14 mouse_points, D15 merge_gaze, D16 dot_points.

The reference builds these per participant with the form values injected
as literals; here one join with the form serves every participant at once
(J12). All functions are stateless DataFrame -> DataFrame, so they also
apply to a streaming DataFrame joined with a static form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import diff_us, rgb
from ..schemas import (
    COLOR_BOTH_EYES,
    COLOR_CLICK,
    COLOR_DOT,
    COLOR_LEFT_EYE,
    COLOR_MOVE,
    COLOR_RIGHT_EYE,
    EVENT_VIEW_EVENTS,
)

CLOCKS = ["rec_time", "webcam_time", "screen_time"]


def with_timelines(
    df: DataFrame,
    form: DataFrame,
    tc: str = "timestamp",
    screen: bool | DataFrame = True,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add rec_time, webcam_time and screen_time (BIGINT us) beside the
    wall clock `tc`.

    rec = t - init_start; webcam = rec - (webcam_start - init_start);
    screen = rec - (screen_start - init_start), null without a screen start
    or without a screen video (`screen=False`, or a DataFrame of the pids
    that have one). The join strategy is left to the planner's size
    estimate (broadcast below the threshold, shuffle join above)."""
    extra = keep or []
    side = form.select("pid", "init_start", "webcam_start", "screen_start", *extra)
    out = df.join(side, "pid", "inner")
    rec = diff_us(tc, "init_start")
    webcam = rec - diff_us("webcam_start", "init_start")
    screen_t = rec - diff_us("screen_start", "init_start")
    if isinstance(screen, DataFrame):
        flags = screen.select("pid").distinct().withColumn("_has_screen", F.lit(True))
        out = out.join(flags, "pid", "left")
        screen_t = F.when(F.col("_has_screen"), screen_t)
    elif not screen:
        screen_t = F.lit(None).cast("bigint")
    out = out.withColumns({"rec_time": rec, "webcam_time": webcam, "screen_time": screen_t})
    return out.drop("init_start", "webcam_start", "screen_start", "_has_screen")


def event_log(tl: DataFrame) -> DataFrame:
    """Start, stop, click, save and response rows on every clock."""
    return tl.where(F.col("event").isin(EVENT_VIEW_EVENTS)).select(
        "pid", "event", "record", "study", "timestamp", *CLOCKS
    )


def recording_markers(tl: DataFrame) -> DataFrame:
    """Recording start/stop markers; a stop marks a gap (study `gap`,
    record 0)."""
    is_stop = F.col("event") == "stop"
    return tl.where(F.col("event").isin("start", "stop")).select(
        "pid",
        F.when(is_stop, F.lit(0)).otherwise(F.col("record")).alias("record"),
        "event",
        F.when(is_stop, F.lit("gap")).otherwise(F.col("study")).alias("study"),
        "timestamp",
        *CLOCKS,
    )


def mouse_points(tl: DataFrame) -> DataFrame:
    """Mouse rows as [x, y] points, clicks and moves coloured apart."""
    return tl.where(F.col("source") == "mouse").select(
        "pid", "timestamp", *CLOCKS, "event",
        F.array(F.col("mouse.x"), F.col("mouse.y")).alias("mouse"),
        F.when(F.col("event") == "click", rgb(COLOR_CLICK)).otherwise(rgb(COLOR_MOVE)).alias("color"),
    )


def merge_gaze(tl: DataFrame, form: DataFrame | None = None) -> DataFrame:
    """One gaze point per sample in display pixels.

    Both eyes valid: the mean of the two points (colour cyan); one eye
    valid: that eye (blue left, green right); neither (or unknown): the row
    is dropped. x and y are scaled by the display resolution, taken from
    `tl` when it carries `display_resolution` (`with_timelines(...,
    keep=["display_resolution"])`, one join with the form) and from `form`
    otherwise. One filter and one CASE replace the three-way union of the
    reference, so the gaze table is scanned once."""
    lv = F.col("gazepoint_validity.left")
    rv = F.col("gazepoint_validity.right")
    lx, ly = F.col("gazepoint_display.left.x"), F.col("gazepoint_display.left.y")
    rx, ry = F.col("gazepoint_display.right.x"), F.col("gazepoint_display.right.y")
    both, left_only, right_only = lv & rv, lv & ~rv, ~lv & rv
    kept = tl.where(both | left_only | right_only)
    if "display_resolution" in tl.columns:
        kept = kept.withColumns({"_w": F.col("display_resolution.w"), "_h": F.col("display_resolution.h")})
    else:
        res = form.select(
            "pid", F.col("display_resolution.w").alias("_w"), F.col("display_resolution.h").alias("_h")
        )
        kept = kept.join(res, "pid", "left")
    x = F.when(both, (lx + rx) / 2.0).when(left_only, lx).otherwise(rx)
    y = F.when(both, (ly + ry) / 2.0).when(left_only, ly).otherwise(ry)
    color = F.when(both, rgb(COLOR_BOTH_EYES)).when(left_only, rgb(COLOR_LEFT_EYE)).otherwise(
        rgb(COLOR_RIGHT_EYE)
    )
    clocks = [c for c in ["timestamp", *CLOCKS] if c in tl.columns]
    return kept.select(
        "pid", *clocks,
        (x * F.col("_w")).alias("x"),
        (y * F.col("_h")).alias("y"),
        color.alias("color"),
    )


def dot_points(tl: DataFrame) -> DataFrame:
    """Dot-test targets as [x, y] points on every clock, black."""
    clocks = [c for c in ["timestamp", *CLOCKS] if c in tl.columns]
    return tl.select(
        "pid", *clocks,
        F.array(F.col("dot.x"), F.col("dot.y")).alias("dot"),
        rgb(COLOR_DOT).alias("color"),
    )
