"""D18 shape_tracker_frames: tracker-output frames to typed columns, with
their row index in file order (W1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import to_struct
from .ordering import row_index


def _pair(c: str, fn) -> Column:
    return F.when(
        F.col(c).isNotNull(),
        F.struct(fn(F.col(f"{c}.left")).alias("left"), fn(F.col(f"{c}.right")).alias("right")),
    )


def shape_tracker_frames(
    raw: DataFrame,
    order: list[str] | None = None,
    bucket: Column | None = None,
    keys: tuple[str, ...] = ("pid", "record", "aux"),
) -> DataFrame:
    """One clip's tracker records (TRACKER_JSON_SCHEMA + keys) with
    narrow types: times as BIGINT us (cut to ms), events as TINYINT,
    fixed arrays as named FLOAT structs, left/right pairs, the face shape
    as a list of points; then `index`, the 0-based row position per clip
    in `order` (file order), numbered in buckets (see `row_index`)."""
    f32 = "float"
    xy, xyz, xys = ("x", "y"), ("x", "y", "z"), ("x", "y", "s")
    shaped = raw.select(
        *keys,
        *(order or []),
        (F.col("trackTime").cast("bigint") * 1000).alias("timestamp"),
        F.col("trackEvent").cast("tinyint").alias("tracking"),
        to_struct("frameOffset", xy, "int").alias("offset"),
        to_struct("frameOrigin", xy, "bigint").alias("origin"),
        to_struct("cameraFocal", xy, f32).alias("focals"),
        to_struct("screenOrigin", xy, "bigint").alias("screen"),
        to_struct("faceTarget", xys, f32).alias("target"),
        to_struct("facePosition", xyz, f32).alias("position"),
        to_struct("faceRotation", ("roll", "pitch", "yaw"), f32).alias("rotation"),
        _pair("eyeTarget", lambda a: to_struct(a, xys, f32)).alias("eyes"),
        _pair("eyeAspectRatio", lambda a: a.cast(f32)).alias("ear"),
        _pair("pupilConfidence", lambda a: a.cast(f32)).alias("pupilconf"),
        _pair("pupilCenter", lambda a: to_struct(a, xy, f32)).alias("pupils"),
        _pair("calibConfidence", lambda a: a.cast(f32)).alias("calibconf"),
        to_struct("calibShift", xyz, f32).alias("calibshift"),
        to_struct("calibEdge", xyz, f32).alias("calibedge"),
        F.col("gazeEvent").cast("tinyint").alias("gazing"),
        (F.col("gazeDuration").cast("bigint") * 1000).alias("gazedur"),
        _pair("gazePoint", lambda a: to_struct(a, xy, f32)).alias("gazepoint"),
        to_struct("gazeBestPoint", xy, f32).alias("gazebest"),
        to_struct("fixationPoint", xy, f32).alias("fixation"),
        F.transform("faceShape", lambda p: to_struct(p, xy, f32)).alias("faceshape"),
    )
    if order:
        indexed = row_index(shaped, list(keys), order, bucket, "index")
        indexed = indexed.drop(*order)
    else:
        indexed = shaped.withColumn("index", F.lit(None).cast("bigint"))
    cols = [c for c in indexed.columns if c not in (*keys, "index")]
    return indexed.select(*keys, "index", *cols)
