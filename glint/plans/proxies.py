"""Views of the benchmark tables shaped like the raw study sources.

The study data itself is not public in this environment, so the registered
queries read the driver's tables and derive, with Spark, inputs that have
the shape of the raw sources. Every view grows with the table it reads:

* `raw_log(events)`: one browser-log row per event. pid = user_id,
  record = day of month, page = one of the 20 studies by hour of day
  (`thankyou` included), type from event_type: signup -> recording start,
  purchase -> recording stop, click -> mouseclick, view -> mousemove,
  error -> by props.k % 6: scrollEvent, textInput, text_input,
  video saved (event), response, video started (event).
* `log(events)`: `normalize_log(raw_log(events))`, the tidy log.

Each view has a SQL twin in `glint.plans.oracle`, written independently
from the event columns, which DuckDB runs as the correctness oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import micros
from ..operators.log import normalize_log
from ..schemas import STUDIES

DAY_US = 86_400_000_000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the benchmark directory, read as it is, so filters
    and column choices reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _prop_k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def raw_log(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    us = micros("ts")
    day0 = us - us % F.lit(DAY_US)
    k = _prop_k()
    kind = k % 6
    et = F.col("event_type")
    is_error = et == "error"
    pages = F.array(*[F.lit("thankyou" if s == "thank_you" else s) for s in STUDIES])
    page = F.element_at(pages, (F.hour("ts") % 20 + 1).cast("int"))
    webpage = F.concat(F.lit("/study/"), page, F.lit(".htm"))
    typ = (
        F.when(et == "signup", "recording start")
        .when(et == "purchase", "recording stop")
        .when(et == "click", "mouseclick")
        .when(et == "view", "mousemove")
        .when(is_error & (kind == 0), "scrollEvent")
        .when(is_error & (kind == 1), "textInput")
        .when(is_error & (kind == 2), "text_input")
        .when(is_error & (kind == 4), "response")
    )
    raw_event = F.when(is_error & (kind == 3), "video saved").when(
        is_error & (kind == 5), "video started"
    )
    d = lambda c: c.cast("double")
    return events.select(
        *(keep or []),
        F.col("user_id").cast("int").alias("pid"),
        (et != "error").alias("isTrusted"),
        F.concat_ws(
            "_", ((day0 - day0 % 1000) / 1000).cast("bigint").cast("string"),
            F.dayofmonth("ts").cast("string"), webpage,
        ).alias("sessionId"),
        webpage.alias("webpage"),
        F.lit(None).cast("string").alias("sessionString"),
        d((us - us % 1000) / 1000).alias("epoch"),
        ((us - day0) / F.lit(1000.0)).alias("time"),
        typ.alias("type"),
        raw_event.alias("event"),
        F.when(typ == "text_input", F.concat(F.lit("answer "), k.cast("string"))).alias("text"),
        F.when(
            typ == "textInput",
            F.struct(d(k).alias("top"), d(F.floor("value")).alias("left")),
        ).alias("pos"),
        d(k - 50).alias("screenX"),
        d(F.floor("value")).alias("screenY"),
        d(k).alias("clientX"),
        d(F.floor("value")).alias("clientY"),
        d(k * 2).alias("pageX"),
        d(F.floor(F.col("value") * 10)).alias("pageY"),
        F.lit(0.0).alias("scrollX"),
        d(k * 10).alias("scrollY"),
        F.lit(0.0).alias("windowX"),
        F.lit(23.0).alias("windowY"),
        F.lit(1280.0).alias("windowInnerWidth"),
        d(720 - k).alias("windowInnerHeight"),
        F.lit(1280.0).alias("windowOuterWidth"),
        F.lit(800.0).alias("windowOuterHeight"),
    )


def log(events: DataFrame) -> DataFrame:
    return normalize_log(raw_log(events))


# --- alignment and clip manifest (from the log's recording starts) -----------------
#
# Every `recording start` row stands for one webcam clip:
#   P_<pid>/<session epoch ms>_<record>_-study-<study>[ (<aux>)].webm
# aux = k % 3 when non-zero (fragments), frameshift = (k - 50) / 1000 s,
# missing when k % 7 == 0.


def clips(events: DataFrame) -> DataFrame:
    """(pid, session ms, record, study, aux, frameshift s, event_id) per start."""
    us = micros("ts")
    day0_ms = ((us - us % F.lit(DAY_US)) / 1000).cast("bigint")
    k = _prop_k()
    study = F.element_at(F.array(*[F.lit(s) for s in STUDIES]), (F.hour("ts") % 20 + 1).cast("int"))
    return events.where(F.col("event_type") == "signup").select(
        F.col("user_id").cast("int").alias("pid"),
        day0_ms.alias("log"),
        F.dayofmonth("ts").alias("record"),
        study.alias("study"),
        F.when(k % 3 > 0, (k % 3)).alias("aux"),
        F.when(k % 7 != 0, (k - 50).cast("double") / F.lit(1000.0)).alias("frameshift"),
        F.col("event_id"),
        F.col("value"),
    )


def alignment_csv(events: DataFrame) -> DataFrame:
    """Rows shaped like the alignment CSV (video, frameshift, corrOptimal,
    corrOrig)."""
    c = clips(events)
    suffix = F.when(F.col("aux").isNotNull(), F.format_string(" (%d)", "aux")).otherwise(F.lit(""))
    video = F.concat(
        F.format_string("P_%02d/%d_%d_-study-%s", "pid", "log", "record", "study"),
        suffix, F.lit(".webm"),
    )
    return c.select(
        video.alias("video"),
        F.col("frameshift"),
        (F.col("value") / 100.0).alias("corrOptimal"),
        (F.col("value") / 200.0).alias("corrOrig"),
    )


def archive_manifest(events: DataFrame) -> DataFrame:
    """Archive listing (member, size): the clips plus one questionnaire and
    one log file per participant, which the clip parser must skip."""
    c = alignment_csv(events).select(
        F.concat(F.lit("archive/"), F.col("video")).alias("member"),
        (F.col("corrOptimal") * 1_000_000).cast("bigint").alias("size"),
    )
    other = events.where(F.col("event_type") == "view").select(
        F.format_string("archive/P_%02d/%d.json", F.col("user_id").cast("int"), "event_id").alias("member"),
        F.col("event_id").alias("size"),
    )
    return c.unionByName(other)


# --- questionnaire and device specs (from events per user + customer) -------------


def users(events: DataFrame) -> DataFrame:
    return events.groupBy(F.col("user_id").cast("int").alias("pid")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


def _pick(values: list[str], idx: F.Column) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def raw_form(events: DataFrame, customer: DataFrame) -> DataFrame:
    """Rows shaped like the questionnaire CSV, one per event user. Eye colour
    cycles through the 5 valid values and one invalid (`Violet`)."""
    from ..schemas import FORM_DOMAINS as D

    u = users(events).join(customer, F.col("pid") == F.col("c_custkey"), "left")
    ck, nk = F.col("c_custkey"), F.col("c_nationkey")
    first_ms = (micros("first_ts") - micros("first_ts") % 1000) / 1000
    log_id = first_ms.cast("bigint") - 60000
    has_screen = F.col("pid") % 4 != 0
    secs = ((micros("last_ts") - micros("first_ts")) / 1_000_000).cast("bigint")
    return u.select(
        F.format_string("P_%02d", "pid").alias("Participant ID"),
        log_id.alias("Participant Log ID"),
        F.date_format("first_ts", "MM/dd/yyyy").alias("Date"),
        F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "Laptop").otherwise("PC").alias(
            "Setting"),
        (1280 + 64 * (nk % 5)).cast("int").alias("Display Width (pixels)"),
        (720 + 36 * (nk % 5)).cast("int").alias("Display Height (pixels)"),
        (F.lit(30.0) + nk).alias("Screen Width (cm)"),
        (F.lit(20.0) + nk).alias("Screen Height (cm)"),
        (F.lit(50.0) + F.col("c_acctbal") / 1000.0).alias("Distance From Screen (cm)"),
        F.when(has_screen, log_id + 5000).alias("Screen Recording Start Time (Unix milliseconds)"),
        F.when(has_screen, F.date_format("first_ts", "MM/dd/yyyy HH:mm")).alias(
            "Screen Recording Start Time (Wall Clock)"),
        _pick(D["gender"], ck % 2).alias("Gender"),
        (18 + ck % 50).cast("int").alias("Age"),
        _pick(D["race"], ck % 4).alias("Self-Reported Race"),
        _pick(D["skin_color"], ck % 6).alias("Self-Reported Skin Color"),
        _pick(D["eye_color"] + ["Violet"], ck % 6).alias("Self-Reported Eye Color"),
        _pick(D["facial_hair"], ck % 3).alias("Facial Hair"),
        _pick(D["vision"], ck % 3).alias("Self-Reported Vision"),
        _pick(["Yes", "No"], ck % 2).alias("Touch Typer"),
        _pick(D["handedness"], ck % 2).alias("Self-Reported Handedness"),
        _pick(D["weather"], ck % 3).alias("Weather"),
        _pick(D["pointing_device"], ck % 2).alias("Pointing Device"),
        F.col("c_name").alias("Notes"),
        F.date_format("first_ts", "HH:mm").alias("Time of day"),
        F.format_string("%d:%d:%d", (secs / 3600).cast("bigint"), ((secs % 3600) / 60).cast("bigint"),
                        secs % 60).alias("Duration"),
    )


def spec_files(customer: DataFrame) -> DataFrame:
    """One device-spec text per customer (pid = c_custkey), like a file read
    whole: 8 corners (Front Upper Right missing when key % 9 == 0), the
    illumination mode (repeated as `Bright` when key % 7 == 0: last wins),
    the frequency (missing when key % 11 == 0) and an unrelated line."""
    from ..operators.form import CORNERS

    ck, nk = F.col("c_custkey"), F.col("c_nationkey")
    lines = []
    for depth, height, side in CORNERS:
        x = F.lit(-250 if side == "Left" else 250) + nk
        y = F.lit(-175 if height == "Lower" else 175) + ck % 10
        z = F.lit(850 if depth == "Back" else 450)
        text = F.format_string(f"{depth} {height} {side}: (%d.0, %d.0, %d.0)", x, y, z)
        if (depth, height, side) == ("Front", "Upper", "Right"):
            text = F.when(ck % 9 != 0, text)
        lines.append(text)
    lines.append(F.lit("Illumination mode: Default"))
    lines.append(F.format_string("Serial number: TX%d", ck))
    lines.append(F.when(ck % 11 != 0, F.format_string(
        "Initial gaze output frequency: %d.0", 60 + (ck % 3) * 30)))
    lines.append(F.when(ck % 7 == 0, F.lit("  Illumination mode: Bright")))
    return customer.select(
        ck.cast("int").alias("pid"),
        F.concat_ws("\n", *lines).alias("value"),
    )


# --- eye tracker (from embeddings) ------------------------------------------------------
#
# pid = label; one sample per vector at 60 Hz from 2024-01-01 (vec_id * 16667 us).
# Elements: 0,1 left display x,y; 2 left validity (> 0); 3,4 right x,y;
# 5 right validity; 6 pupil, 7 origin validity; 8 pupil size; 9-11, 12-14
# gaze ucs; 15-17, 18-20 origin ucs; 21-23, 24-26 origin trackbox.

T0_US = 1_704_067_200_000_000
SAMPLE_US = 16_667


def _e(i: int) -> F.Column:
    return F.get(F.col("embedding"), i).cast("double")


def _vec(*idx: int) -> F.Column:
    return F.array(*[_e(i) for i in idx])


def raw_tobii(embeddings: DataFrame) -> DataFrame:
    t_us = F.lit(T0_US) + F.col("vec_id") * SAMPLE_US
    flag = lambda i: F.when(_e(i) > 0, 1).otherwise(0)
    return embeddings.select(
        F.col("label").cast("int").alias("pid"),
        (F.col("vec_id") * SAMPLE_US).alias("device_time_stamp"),
        t_us.alias("system_time_stamp"),
        (t_us.cast("double") / F.lit(1e6)).alias("true_time"),
        flag(6).alias("left_pupil_validity"),
        flag(6).alias("right_pupil_validity"),
        flag(7).alias("left_gaze_origin_validity"),
        flag(7).alias("right_gaze_origin_validity"),
        flag(2).alias("left_gaze_point_validity"),
        flag(5).alias("right_gaze_point_validity"),
        (F.lit(3.0) + _e(8)).alias("left_pupil_diameter"),
        (F.lit(3.0) - _e(8)).alias("right_pupil_diameter"),
        _vec(15, 16, 17).alias("left_gaze_origin_in_user_coordinate_system"),
        _vec(18, 19, 20).alias("right_gaze_origin_in_user_coordinate_system"),
        _vec(21, 22, 23).alias("left_gaze_origin_in_trackbox_coordinate_system"),
        _vec(24, 25, 26).alias("right_gaze_origin_in_trackbox_coordinate_system"),
        _vec(9, 10, 11).alias("left_gaze_point_in_user_coordinate_system"),
        _vec(12, 13, 14).alias("right_gaze_point_in_user_coordinate_system"),
        _vec(0, 1).alias("left_gaze_point_on_display_area"),
        _vec(3, 4).alias("right_gaze_point_on_display_area"),
    )


def raw_tracker(embeddings: DataFrame) -> DataFrame:
    """Tracker-output frames (TRACKER_JSON_SCHEMA) per clip: pid = label,
    record = vec_id % 3 + 1, aux 0, file order = vec_id."""
    pair_d = lambda a, b: F.struct(_e(a).alias("left"), _e(b).alias("right"))
    pair_v = lambda a, b: F.struct(a.alias("left"), b.alias("right"))
    return embeddings.select(
        F.col("label").cast("int").alias("pid"),
        (F.col("vec_id") % 3 + 1).cast("int").alias("record"),
        F.lit(0).alias("aux"),
        F.col("vec_id").alias("order"),
        (F.col("vec_id").cast("double") * 33.4).alias("trackTime"),
        F.when(_e(0) > 0, 1).otherwise(0).cast("bigint").alias("trackEvent"),
        F.array(F.col("label").cast("bigint"), -F.col("label").cast("bigint")).alias("frameOffset"),
        F.array(F.lit(0).cast("bigint"), F.lit(0).cast("bigint")).alias("frameOrigin"),
        _vec(1, 2).alias("cameraFocal"),
        F.array(F.lit(0).cast("bigint"), F.lit(0).cast("bigint")).alias("screenOrigin"),
        _vec(3, 4, 5).alias("faceTarget"),
        _vec(6, 7, 8).alias("facePosition"),
        _vec(9, 10, 11).alias("faceRotation"),
        pair_v(_vec(12, 13, 14), _vec(15, 16, 17)).alias("eyeTarget"),
        pair_d(18, 19).alias("eyeAspectRatio"),
        pair_d(20, 21).alias("pupilConfidence"),
        pair_v(_vec(22, 23), _vec(24, 25)).alias("pupilCenter"),
        pair_d(26, 27).alias("calibConfidence"),
        _vec(28, 29, 30).alias("calibShift"),
        _vec(31, 32, 33).alias("calibEdge"),
        F.when(_e(34) > 0, 2).otherwise(1).cast("bigint").alias("gazeEvent"),
        (F.abs(_e(35)) * 1000.0).alias("gazeDuration"),
        pair_v(_vec(36, 37), _vec(38, 39)).alias("gazePoint"),
        _vec(40, 41).alias("gazeBestPoint"),
        _vec(42, 43).alias("fixationPoint"),
        F.array(_vec(44, 45), _vec(46, 47), _vec(48, 49)).alias("faceShape"),
    )


def video_frames(embeddings: DataFrame) -> DataFrame:
    """Frame times of the two videos: even vectors are webcam frames, odd
    ones screen frames, 30 fps."""
    return embeddings.select(
        F.col("label").cast("int").alias("pid"),
        F.when(F.col("vec_id") % 2 == 0, "webcam").otherwise("screen").alias("video"),
        ((F.col("vec_id") - F.col("vec_id") % 2) / 2 * 33333).cast("bigint").alias("frame"),
    )


# --- dot test (from orders) and calibration (from lineitem) ----------------------------


def raw_dots(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").cast("int").alias("pid"),
        ((F.col("o_orderkey") * 37) % 1280).cast("int").alias("Dot_X"),
        ((F.col("o_orderkey") * 53) % 720).cast("int").alias("Dot_Y"),
        (F.lit(1704067200000.0) + F.col("o_orderkey") * F.lit(1000.5)).alias("Epoch"),
    )


def raw_calibration(lineitem: DataFrame) -> DataFrame:
    px_ = F.col("l_quantity") * 20.0
    py_ = F.col("l_extendedprice") / 100.0
    return lineitem.select(
        F.col("l_suppkey").cast("int").alias("pid"),
        px_.alias("point_x"),
        py_.alias("point_y"),
        F.when(F.col("l_linenumber") != 7, px_ + F.col("l_discount") * 100.0).alias("prediction_x_left"),
        (py_ - F.col("l_tax") * 100.0).alias("prediction_y_left"),
        F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0).otherwise(-1)
        .cast("tinyint").alias("validity_left"),
        (px_ - F.col("l_discount") * 50.0).alias("prediction_x_right"),
        (py_ + F.col("l_tax") * 50.0).alias("prediction_y_right"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).cast("tinyint").alias("validity_right"),
    )


def error_frames(events: DataFrame) -> DataFrame:
    """Frame ids of a recording for positional pairing: the error events."""
    return events.where(F.col("event_type") == "error").select(
        F.col("user_id").cast("int").alias("pid"),
        F.dayofmonth("ts").alias("record"),
        F.col("event_id").alias("frame"),
    )


def duration_texts(orders: DataFrame) -> DataFrame:
    """Duration text in five spellings per order, one of them invalid."""
    h, m = F.col("o_orderkey") % 5, F.col("o_orderkey") % 60
    s, ms = F.col("o_custkey") % 60, F.col("o_orderkey") % 1000
    v = F.col("o_orderkey") % 5
    text = (
        F.when(v == 0, F.format_string("%dh %dm %ds %dms", h, m, s, ms))
        .when(v == 1, F.format_string("%dMS%dS", ms, s))
        .when(v == 2, F.format_string("%d.5s %dm", s, m))
        .when(v == 3, F.format_string("%dm %dx", m, s))
        .otherwise(F.format_string("%ds %ds", s, m))
    )
    return orders.select("o_orderkey", text.alias("text"))


# --- raw files as text (from the same views) -------------------------------------------
#
# The given tables rendered as the files would be, broken input included:
# cut logs, cut and noisy sample lines, whole numbers as `1.0`, fields that
# don't parse, NaN, `-` for missing.


#: Events in one log file at most.
FILE_EVENTS = 1_000


def log_files(events: DataFrame, bad_events: bool = False) -> DataFrame:
    """One JSON array per (participant, record, `FILE_EVENTS` event ids);
    those of participants ending in 3 and even records are cut off. With
    `bad_events` every 37th event's epoch is no number."""
    rows = raw_log(events, ["event_id"])
    text = F.to_json(F.struct(*[c for c in rows.columns if c not in ("pid", "event_id")]))
    if bad_events:
        text = F.when(F.col("event_id") % 37 == 5, F.regexp_replace(text, '"epoch":[^,}]*', '"epoch":"abc"')).otherwise(text)
    keys = ["pid", F.split("sessionId", "_")[1].cast("int").alias("record"), F.floor(F.col("event_id") / FILE_EVENTS).alias("file")]
    files = rows.groupBy(*keys).agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(text)), F.lit("]")).alias("value"))
    cut = (F.col("pid") % 10 == 3) & (F.col("record") % 2 == 0)
    return files.select("pid", F.when(cut, F.left("value", F.length("value") - 20)).otherwise(F.col("value")).alias("value"))


def gaze_recordings(embeddings: DataFrame) -> DataFrame:
    """NDJSON lines of recordings (one per participant, read in blocks of
    100 lines), each cut off in its last line."""
    raw = raw_tobii(embeddings)
    at = (F.col("device_time_stamp") / SAMPLE_US).cast("bigint")
    last = raw.groupBy("pid").agg(F.max("device_time_stamp").alias("_last"))
    text = F.to_json(F.struct(*[c for c in raw.columns if c != "pid"]))
    text = F.when(F.col("device_time_stamp") == F.col("_last"), F.left(text, F.lit(40))).otherwise(text)
    return raw.join(last, "pid").select(
        "pid", F.col("pid").cast("string").alias("source"), F.floor(at / 100).alias("block"), (at % 100).alias("row"), text.alias("value"))


def gaze_lines(embeddings: DataFrame) -> DataFrame:
    """NDJSON samples; of 50, one is cut off and one is noise."""
    raw = raw_tobii(embeddings)
    whole = [F.col(c).cast("double").alias(c) if c.endswith("validity") or c.endswith("stamp") else F.col(c) for c in raw.columns if c != "pid"]
    n = (F.col("device_time_stamp") / SAMPLE_US).cast("bigint") % 50
    text = F.to_json(F.struct(*whole))
    return raw.select("pid", F.when(n == 7, F.left(text, F.lit(40))).when(n == 9, F.lit("noise")).otherwise(text).alias("value"))


def _joined(sep: str, *cols: F.Column) -> F.Column:
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def dot_lines(orders: DataFrame) -> DataFrame:
    """TSV lines; every 11th order's y doesn't parse."""
    raw = raw_dots(orders.withColumn("o_custkey", F.col("o_custkey")))
    key = F.round((F.col("Epoch") - 1704067200000.0) / 1000.5).cast("bigint")
    y = F.when(key % 11 == 5, F.lit("n/a")).otherwise(F.col("Dot_Y").cast("string"))
    return raw.select("pid", _joined("\t", F.col("Dot_X"), y, F.col("Epoch")).alias("value"))


def calibration_lines(lineitem: DataFrame) -> DataFrame:
    """TSV lines; second lines of an order have a NaN, seventh ones a gap."""
    raw = raw_calibration(lineitem.withColumn("l_suppkey", F.col("l_suppkey") * 8 + F.col("l_linenumber")))
    nan = F.when(F.col("pid") % 8 == 2, F.lit("NaN")).otherwise(F.col("prediction_x_right").cast("string"))
    cols = [nan if c == "prediction_x_right" else F.col(c) for c in raw.columns if c != "pid"]
    return raw.select(F.floor(F.col("pid") / 8).cast("int").alias("pid"), _joined("\t", *cols).alias("value"))


def alignment_lines(events: DataFrame) -> DataFrame:
    """CSV lines with `-` for a missing shift."""
    a = alignment_csv(events)
    shift = F.coalesce(F.col("frameshift").cast("string"), F.lit("-"))
    return a.select(_joined(",", F.col("video"), shift, F.col("corrOptimal"), F.col("corrOrig")).alias("value"))


def tracker_lines(embeddings: DataFrame) -> DataFrame:
    raw = raw_tracker(embeddings)
    keys = ["pid", "record", "aux", "order"]
    return raw.select(*keys, F.to_json(F.struct(*[c for c in raw.columns if c not in keys])).alias("value"))


def form_records(events: DataFrame, customer: DataFrame) -> DataFrame:
    """Questionnaire records split into text fields, `-` for missing."""
    raw = raw_form(events, customer)
    return raw.select(F.array(*[
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("-")) for c in raw.columns]).alias("fields"))
