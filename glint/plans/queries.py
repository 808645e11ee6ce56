"""Registered queries: each builds one operator's result over the benchmark
tables. Results are flattened to plain columns, instants and durations as
BIGINT microseconds, so that they compare 1:1 with the SQL in `oracle`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import micros
from ..operators.recordings import recording_durations
from . import proxies as px

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return wrap


def flat_log(log: DataFrame) -> DataFrame:
    return log.select(
        "pid", "record", micros("timestamp").alias("ts_us"), "study", "event",
        "source", "trusted", F.col("duration").alias("duration_us"),
        F.col("caret.top").alias("caret_top"), F.col("caret.left").alias("caret_left"),
        "text",
        F.col("page.x").alias("page_x"), F.col("page.y").alias("page_y"),
        F.col("mouse.x").alias("mouse_x"), F.col("mouse.y").alias("mouse_y"),
        F.col("scroll.x").alias("scroll_x"), F.col("scroll.y").alias("scroll_y"),
        F.col("window.x").alias("window_x"), F.col("window.y").alias("window_y"),
        F.col("inner.w").alias("inner_w"), F.col("inner.h").alias("inner_h"),
        F.col("outer.w").alias("outer_w"), F.col("outer.h").alias("outer_h"),
    )


def events_log(spark: SparkSession, sf: str) -> DataFrame:
    return px.log(px.load(spark, sf, "events"))


@query("normalize_log")
def q_normalize_log(spark, sf):
    """D3 over the whole events table."""
    return flat_log(events_log(spark, sf))


@query("recording_durations")
def q_recording_durations(spark, sf):
    """D10 (J1-J3, A1, A5)."""
    return _flat_durations(recording_durations(events_log(spark, sf)))


def _flat_durations(d):
    return d.select(
        "pid", "record", "study",
        micros("start").alias("start_us"), micros("stop").alias("stop_us"),
        F.col("duration").alias("duration_us"),
    )


@query("first_start_per_pid")
def q_first_start(spark, sf):
    """A1: earliest recording start per participant (the webcam start)."""
    lg = events_log(spark, sf).where(F.col("event") == "start")
    return lg.groupBy("pid").agg(F.min(micros("timestamp")).alias("webcam_start_us"))


@query("distinct_pids")
def q_distinct_pids(spark, sf):
    """A3: participants present in the log."""
    return events_log(spark, sf).select("pid").distinct()


@query("record_count")
def q_record_count(spark, sf):
    """A2: number of log rows with a record, per participant."""
    return events_log(spark, sf).groupBy("pid").agg(F.count("record").alias("records"))


# --- shared derived inputs -----------------------------------------------------------

from ..operators.form import (  # noqa: E402
    build_form,
    clean_form,
    domain_violations,
    parse_specs,
    spec_lines,
)
from ..operators.gaze import (  # noqa: E402
    calibration_targets,
    paired_targets,
    shape_calibration,
    shape_dots,
    shape_gaze,
)
from ..operators.log import align_log, normalize_log, parse_alignment  # noqa: E402
from ..operators.recordings import (  # noqa: E402
    clip_manifest,
    clip_timeline,
    fragment_parts,
    frame_index,
)
from ..operators.frames import shape_tracker_frames  # noqa: E402
from ..operators.timelines import (  # noqa: E402
    dot_points,
    event_log,
    merge_gaze,
    mouse_points,
    recording_markers,
    with_timelines,
)
from ..functions import duration_text_us  # noqa: E402


def form_of(spark, sf, strict: bool = False):
    cu = px.load(spark, sf, "customer")
    form = clean_form(px.raw_form(px.load(spark, sf, "events"), cu), strict=strict)
    return build_form(form, events_log(spark, sf), parse_specs(spec_lines(px.spec_files(cu))))


_us = micros


def flat_clocks(_df: DataFrame | None = None) -> list:
    """The wall clock as epoch us and the three derived clocks."""
    return [micros("timestamp").alias("ts_us"), "rec_time", "webcam_time", "screen_time"]


@query("parse_alignment")
def q_parse_alignment(spark, sf):
    """D5 over alignment rows derived from every recording start."""
    a = parse_alignment(px.alignment_csv(px.load(spark, sf, "events")))
    return a.select("pid", "log", "record", "study", "aux", F.col("frameshift").alias("frameshift_us"))


@query("align_log")
def q_align_log(spark, sf):
    """D4 (J8): the tidy log shifted by each clip's frame shift."""
    ev = px.load(spark, sf, "events")
    aligned = align_log(events_log(spark, sf), parse_alignment(px.alignment_csv(ev)))
    return aligned.select("pid", "record", "study", "event", micros("timestamp").alias("ts_us"))


@query("clean_form")
def q_clean_form(spark, sf):
    """D1 (tolerant mode: the invalid eye colour becomes null)."""
    return _flat_form(clean_form(px.raw_form(px.load(spark, sf, "events"), px.load(spark, sf, "customer")), strict=False))


def _flat_form(f):
    return f.select(
        "pid", "log", "setting", "screen_distance", _us("screen_start").alias("screen_start_us"),
        _us("wall_clock").alias("wall_clock_us"), "gender", "age", "race", "skin_color", "eye_color",
        "facial_hair", "vision", "touch_typer", "handedness", "weather", "pointing_device", "notes",
        "time_of_day", _us("init_start").alias("init_start_us"),
        F.col("screen_size.w").alias("screen_w"), F.col("screen_size.h").alias("screen_h"),
        F.col("display_resolution.w").alias("display_w"), F.col("display_resolution.h").alias("display_h"),
    )


@query("build_form")
def q_build_form(spark, sf):
    """D2 (J4-J7, A1, S13): form + screen adjustment + viewport offset +
    spec + first recording start."""
    f = form_of(spark, sf)
    return f.select(
        "pid", "setting", "screen_viewport_y", _us("init_start").alias("init_start_us"),
        _us("webcam_start").alias("webcam_start_us"), _us("screen_start").alias("screen_start_us"),
        "illumination_mode", "frequency",
        *_box_columns(),
    )


@query("spec_pivot")
def q_spec_pivot(spark, sf):
    """Device-spec text of every customer to one typed row."""
    s = parse_specs(spec_lines(px.spec_files(px.load(spark, sf, "customer"))))
    return s.select("pid", "illumination_mode", "frequency", *_box_columns())


def _box_columns():
    """All 24 coordinates."""
    from ..operators.form import CORNERS, corner_key

    return [
        F.get(F.col(f"tracking_box.{k}"), i).alias(f"{k}_{axis}")
        for k in (corner_key(*c) for c in CORNERS) for i, axis in enumerate("xyz")
    ]


@query("domain_check")
def q_domain_check(spark, sf):
    """Values outside the closed sets in the questionnaire rows and
    the device specs, with their counts."""
    from ..schemas import FORM_COLUMNS

    ev, cu = px.load(spark, sf, "events"), px.load(spark, sf, "customer")
    raw = px.raw_form(ev, cu)
    named = raw.select(*[F.col(f"`{k}`").alias(v) for k, v in FORM_COLUMNS.items()])
    specs = parse_specs(spec_lines(px.spec_files(cu))).select("pid", "illumination_mode")
    named = named.withColumn("pid", F.split("pid", "_").getItem(1).cast("int")).join(specs, "pid", "left")
    return domain_violations(named)


@query("with_timelines")
def q_with_timelines(spark, sf):
    """D11 (J12): the whole log on the log, rec, webcam and screen clocks."""
    tl = with_timelines(events_log(spark, sf), form_of(spark, sf))
    return tl.select("pid", "record", "event", *flat_clocks(tl))


@query("event_log")
def q_event_log(spark, sf):
    """D12."""
    ev = event_log(with_timelines(events_log(spark, sf), form_of(spark, sf)))
    return ev.select("pid", "event", "record", "study", *flat_clocks(ev))


@query("recording_markers")
def q_recording_markers(spark, sf):
    """D13."""
    m = recording_markers(with_timelines(events_log(spark, sf), form_of(spark, sf)))
    return m.select("pid", "record", "event", "study", *flat_clocks(m))


@query("mouse_points")
def q_mouse_points(spark, sf):
    """D14."""
    m = mouse_points(with_timelines(events_log(spark, sf), form_of(spark, sf)))
    return m.select(
        "pid", *flat_clocks(m), "event",
        F.get("mouse", 0).alias("x"), F.get("mouse", 1).alias("y"),
        F.get("color", 0).alias("r"), F.get("color", 1).alias("g"), F.get("color", 2).alias("b"),
    )


def _flat_gaze(g):
    return g.select(
        "pid", micros("timestamp").alias("ts_us"), micros("clock").alias("clock_us"),
        micros("duration").alias("device_us"),
        F.col("pupil_validity.left").alias("pupil_valid_l"),
        F.col("pupil_diameter.right").alias("pupil_diameter_r"),
        F.col("gazepoint_validity.left").alias("gaze_valid_l"),
        F.col("gazepoint_validity.right").alias("gaze_valid_r"),
        F.col("gazepoint_display.left.x").alias("gaze_x_l"),
        F.col("gazepoint_display.right.y").alias("gaze_y_r"),
        F.col("gazepoint_ucs.left.z").alias("gaze_ucs_z_l"),
        F.col("gazeorigin_validity.right").alias("origin_valid_r"),
        F.col("gazeorigin_trackbox.right.x").alias("trackbox_x_r"),
        F.col("gazeorigin_ucs.left.y").alias("origin_ucs_y_l"),
    )


@query("shape_gaze")
def q_shape_gaze(spark, sf):
    """D6 over eye-tracker rows derived from every embedding."""
    return _flat_gaze(shape_gaze(px.raw_tobii(px.load(spark, sf, "embeddings"))))


@query("shape_gaze_leaves")
def q_shape_gaze_leaves(spark, sf):
    """Every measure, as (pid, device time, name, side, value)."""
    g = shape_gaze(px.raw_tobii(px.load(spark, sf, "embeddings")))
    rows = []
    for f in g.schema.fields:
        if f.name in ("pid", "timestamp", "clock", "duration"):
            continue
        for side in ("left", "right"):
            leaf = f.dataType[side].dataType
            parts = leaf.fieldNames() if hasattr(leaf, "fieldNames") else [None]
            for p in parts:
                c = F.col(f"{f.name}.{side}" + (f".{p}" if p else ""))
                rows.append(F.struct(F.lit(f.name + (f".{p}" if p else "")).alias("name"), F.lit(side).alias("side"), c.cast("double").alias("value")))
    return g.select("pid", micros("duration").alias("device_us"), F.inline(F.array(*rows)))


# --- raw text to rows (S3-S7, S9, S11) ---------------------------------------------------

from ..sources.parse import (  # noqa: E402
    log_rejects, parse_delimited, parse_gaze_lines, parse_log_text, parse_tracker_lines, type_form_fields,
)


@query("read_log_files")
def q_read_log_files(spark, sf):
    """JSON arrays, some cut off, to the tidy log (tolerant)."""
    files = px.log_files(px.load(spark, sf, "events"))
    return flat_log(normalize_log(parse_log_text(files, strict=False)))


@query("read_gaze_lines")
def q_read_gaze_lines(spark, sf):
    """Sample lines, some cut off or noise, to samples (tolerant)."""
    return _flat_gaze(shape_gaze(parse_gaze_lines(px.gaze_lines(px.load(spark, sf, "embeddings")), strict=False)))


@query("read_log_elements")
def q_read_log_elements(spark, sf):
    """Arrays with events whose epoch is no number: those alone go."""
    files = px.log_files(px.load(spark, sf, "events"), bad_events=True)
    return flat_log(normalize_log(parse_log_text(files, strict=False)))


@query("log_reject_counts")
def q_log_reject_counts(spark, sf):
    """What tolerant reading leaves out, per participant: events and
    whole files."""
    out = log_rejects(px.log_files(px.load(spark, sf, "events"), bad_events=True))
    return out.groupBy("pid").agg(
        F.count("position").alias("bad_events"), F.count(F.when(F.col("position").isNull(), 1)).alias("bad_files"))


@query("read_gaze_recordings")
def q_read_gaze_recordings(spark, sf):
    """S5, D6 in strict mode: recordings whose last line is cut off."""
    return _flat_gaze(shape_gaze(parse_gaze_lines(px.gaze_recordings(px.load(spark, sf, "embeddings")), strict=True)))


@query("read_dot_lines")
def q_read_dot_lines(spark, sf):
    """TSV lines with fields that don't parse."""
    from ..schemas import DOT_TSV_SCHEMA

    d = shape_dots(parse_delimited(px.dot_lines(px.load(spark, sf, "orders")), DOT_TSV_SCHEMA))
    return d.select("pid", micros("timestamp").alias("ts_us"), F.col("dot.x").alias("x"), F.col("dot.y").alias("y"))


@query("read_calibration_lines")
def q_read_calibration_lines(spark, sf):
    """S7, D8 (P13): TSV lines; a gap drops the row, NaN stays a value."""
    from ..schemas import CALIB_TSV_SCHEMA

    c = shape_calibration(parse_delimited(px.calibration_lines(px.load(spark, sf, "lineitem")), CALIB_TSV_SCHEMA))
    return c.select(
        "pid", F.col("point.x").alias("point_x"), F.col("validity.left").alias("valid_l"),
        F.isnan("right.x").alias("nan"), F.nanvl("right.x", F.lit(-1.0)).alias("right_x"), F.col("right.y").alias("right_y"))


@query("read_alignment_lines")
def q_read_alignment_lines(spark, sf):
    """CSV lines with `-` for missing."""
    from ..schemas import ALIGNMENT_CSV_SCHEMA

    lines = px.alignment_lines(px.load(spark, sf, "events"))
    a = parse_alignment(parse_delimited(lines, ALIGNMENT_CSV_SCHEMA, sep=",", null="-", strict=True))
    return a.select("pid", "log", "record", "study", "aux", F.col("frameshift").alias("frameshift_us"))


@query("read_tracker_lines")
def q_read_tracker_lines(spark, sf):
    """Tracker NDJSON to numbered frames."""
    raw = parse_tracker_lines(px.tracker_lines(px.load(spark, sf, "embeddings")))
    return _flat_tracker(shape_tracker_frames(raw, order=["order"], bucket=(F.col("order") / 256).cast("bigint")))


@query("read_form_records")
def q_read_form_records(spark, sf):
    """Text fields of questionnaire records to the typed form."""
    records = px.form_records(px.load(spark, sf, "events"), px.load(spark, sf, "customer"))
    return _flat_form(clean_form(type_form_fields(records), strict=False))


@query("form_json")
def q_form_json(spark, sf):
    """K6: fields of each participant's JSON text."""
    from ..sinks import form_json

    get = lambda name, path: F.get_json_object("json", path).alias(name)
    return form_json(form_of(spark, sf)).select(
        "pid", get("init_start", "$.init_start"), get("webcam_start", "$.webcam_start"), get("time_of_day", "$.time_of_day"),
        get("display_w", "$.display_resolution.w"), get("corner_x", "$.tracking_box.b_lo_l.x"), get("setting", "$.setting"),
        F.get_json_object("json", "$.time_of_day_min").isNull().alias("no_helper"))


@query("merge_gaze")
def q_merge_gaze(spark, sf):
    """D15 (U2 single pass, J12): gaze samples in display pixels."""
    gaze = shape_gaze(px.raw_tobii(px.load(spark, sf, "embeddings")))
    form = form_of(spark, sf)
    m = merge_gaze(with_timelines(gaze, form, keep=["display_resolution"]))
    return m.select(
        "pid", *flat_clocks(m), "x", "y",
        F.get("color", 0).alias("r"), F.get("color", 1).alias("g"), F.get("color", 2).alias("b"),
    )


@query("dot_correction")
def q_dot_correction(spark, sf):
    """D7 (J9): dot-test points with the viewport offset of the setting."""
    d = shape_dots(px.raw_dots(px.load(spark, sf, "orders")), form_of(spark, sf))
    return d.select("pid", micros("timestamp").alias("ts_us"), F.col("dot.x").alias("x"),
                    F.col("dot.y").alias("y"))


@query("dot_points")
def q_dot_points(spark, sf):
    """Dot-test points on every clock."""
    form = form_of(spark, sf)
    d = dot_points(with_timelines(shape_dots(px.raw_dots(px.load(spark, sf, "orders")), form), form))
    return d.select("pid", *flat_clocks(d), F.get("dot", 0).alias("x"), F.get("dot", 1).alias("y"))


@query("shape_calibration")
def q_shape_calibration(spark, sf):
    """D8 (P13): calibration rows, incomplete ones dropped."""
    c = shape_calibration(px.raw_calibration(px.load(spark, sf, "lineitem")))
    return c.select(
        "pid", F.col("point.x").alias("point_x"), F.col("point.y").alias("point_y"),
        F.col("validity.left").alias("valid_l"), F.col("validity.right").alias("valid_r"),
        F.col("left.x").alias("left_x"), F.col("left.y").alias("left_y"),
        F.col("right.x").alias("right_x"), F.col("right.y").alias("right_y"),
    )


@query("calibration_targets")
def q_calibration_targets(spark, sf):
    """Dot test / Fitts' law mouse points as weighted targets."""
    t = calibration_targets(events_log(spark, sf), form_of(spark, sf))
    return t.select("pid", "study", F.col("timestamp").alias("ts_ms"), "screen_x", "screen_y",
                    "event", micros("webcam_start").alias("webcam_start_us"), "weight")


@query("paired_targets")
def q_paired_targets(spark, sf):
    """D17b (J11): frame ids paired with mouse points by position."""
    ev = px.load(spark, sf, "events")
    pts = events_log(spark, sf).where(F.col("source") == "mouse").select(
        "pid", "record", "timestamp", F.col("mouse.x").alias("x"), F.col("mouse.y").alias("y"), "event")
    hour = F.floor(micros("timestamp") / 3_600_000_000).cast("bigint")
    frames = px.error_frames(ev).withColumns({
        "order": F.col("frame"), "frame": F.when(F.col("frame") % 7 != 0, F.col("frame"))})
    return paired_targets(
        frames, pts, ["order"], ["timestamp", "x", "y", "event"],
        F.floor(F.col("order") / 1024).cast("bigint"), hour)


@query("clip_manifest")
def q_clip_manifest(spark, sf):
    """D20a (S12, F5): archive members to parsed clips and part paths."""
    m = clip_manifest(px.archive_manifest(px.load(spark, sf, "events")))
    return m.select("pid", "log", "record", "study", "aux", "member", "size", "part_path")


@query("fragments")
def q_fragments(spark, sf):
    """D20b (A4): fragmented clips as ordered part lists."""
    m = clip_manifest(px.archive_manifest(px.load(spark, sf, "events")))
    return fragment_parts(m)


def _clip_inputs(spark, sf):
    """Starts, one file per (pid, record, study) - its longest duration,
    negative ones included - and the webcam start."""
    from ..operators.form import first_starts
    from ..session import ensure_checkpoint_dir

    # starts and stops are read five times below: derived once
    ensure_checkpoint_dir(spark)
    lg = events_log(spark, sf).where(F.col("event").isin("start", "stop")).select(
        "pid", "record", "study", "event", "timestamp").checkpoint()
    starts = lg.where(F.col("event") == "start").select("pid", "record", "study", "timestamp")
    clips = (
        recording_durations(lg).where(F.col("duration").isNotNull())
        .groupBy("pid", "record", "study").agg(F.max("duration").alias("duration"))
    )
    return starts, clips, first_starts(lg)


def _flat_timeline(t):
    return t.select(
        "pid", "record", "study", F.col("offset").alias("offset_us"),
        F.col("duration").alias("duration_us"), "has_file", "accepted",
        F.col("gap").alias("gap_us"), F.col("filler").alias("filler_us"), F.col("end").alias("end_us"),
    )


@query("clip_timeline")
def q_clip_timeline(spark, sf):
    """D20c (W2, J13): per-participant accept/reject plan with fillers."""
    return _flat_timeline(clip_timeline(*_clip_inputs(spark, sf)))


@query("clip_timeline_dense")
def q_clip_timeline_dense(spark, sf):
    """D20c with heavy overlap: every event is a start of one of five
    participants; its file lasts up to 50 hours, a tenth have none."""
    ev = px.load(spark, sf, "events").select(
        (F.col("user_id") % 5).cast("int").alias("pid"), F.col("event_id").cast("int").alias("record"),
        F.lit("dot_test").alias("study"), F.col("ts").cast("timestamp_ntz").alias("timestamp"), "event_id")
    starts = ev.drop("event_id")
    clips = ev.where("event_id % 10 <> 3").select(
        "pid", "record", "study", (F.col("event_id") * 7919 % 180_000 * 1_000_000).alias("duration"))
    form = starts.groupBy("pid").agg(F.min("timestamp").alias("webcam_start"))
    return _flat_timeline(clip_timeline(starts, clips, form))


def _screen_videos(spark, sf):
    """Participants with a screen video: half of the customers."""
    return px.load(spark, sf, "customer").where("c_nationkey % 2 = 0").select(F.col("c_custkey").cast("int").alias("pid"))


def _flat_frames(fr):
    return fr.select("pid", "video", F.col("frame").alias("frame_us"),
                     micros("log_time").alias("log_time_us"), F.col("rec_time").alias("rec_time_us"),
                     F.col("own_time").alias("own_time_us"), F.col("other_time").alias("other_time_us"))


@query("frame_index")
def q_frame_index(spark, sf):
    """D20d: webcam and screen frames on every clock."""
    return _flat_frames(frame_index(px.video_frames(px.load(spark, sf, "embeddings")), form_of(spark, sf)))


@query("frame_index_screens")
def q_frame_index_screens(spark, sf):
    """D20d (P18): only listed participants have a screen video."""
    return _flat_frames(frame_index(
        px.video_frames(px.load(spark, sf, "embeddings")), form_of(spark, sf), screen=_screen_videos(spark, sf)))


@query("with_timelines_screens")
def q_with_timelines_screens(spark, sf):
    """D11 (P18): the screen clock only where a screen video exists."""
    tl = with_timelines(events_log(spark, sf), form_of(spark, sf), screen=_screen_videos(spark, sf))
    return tl.select("pid", "record", "event", *flat_clocks(tl))


@query("hms_durations")
def q_hms_durations(spark, sf):
    """The questionnaire's `H:M:S` texts to microseconds."""
    from ..functions import hms_to_us

    raw = px.raw_form(px.load(spark, sf, "events"), px.load(spark, sf, "customer"))
    return raw.select(F.split("Participant ID", "_").getItem(1).cast("int").alias("pid"),
                      F.col("Duration").alias("text"), hms_to_us("Duration").alias("duration_us"))


@query("clip_order")
def q_clip_order(spark, sf):
    """every clip's place among its participant's, by log, record,
    study order and fragment."""
    from ..operators.ordering import row_index
    from ..operators.recordings import clip_sort_key

    m = clip_manifest(px.archive_manifest(px.load(spark, sf, "events")))
    # buckets follow the order: a log's start, then its clips in 16 groups of records
    bucket = F.col("log") * 16 + F.coalesce(F.least(F.floor(F.col("record") / 2), F.lit(15)), F.lit(0))
    placed = row_index(m, ["pid"], [*clip_sort_key(), "member", "size"], bucket, "place")
    return placed.select("pid", "member", "size", (F.col("place") + 1).cast("int").alias("place"))


@query("recording_durations_dedupe")
def q_recording_durations_dedupe(spark, sf):
    """D10 reduced to one row per start."""
    return _flat_durations(recording_durations(events_log(spark, sf), dedupe=True))


@query("align_log_dedupe")
def q_align_log_dedupe(spark, sf):
    """D4 with one shift per clip key."""
    ev = px.load(spark, sf, "events")
    aligned = align_log(events_log(spark, sf), parse_alignment(px.alignment_csv(ev)), dedupe=True)
    return aligned.select("pid", "record", "study", "event", micros("timestamp").alias("ts_us"))


@query("duration_text")
def q_duration_text(spark, sf):
    """duration text in several spellings parsed to microseconds."""
    t = px.duration_texts(px.load(spark, sf, "orders"))
    return t.select("o_orderkey", "text", duration_text_us("text").alias("parsed_us"))


@query("indexed_frames")
def q_indexed_frames(spark, sf):
    """D18 (W1): tracker frames shaped, with their row index in file order."""
    raw = px.raw_tracker(px.load(spark, sf, "embeddings"))
    return _flat_tracker(shape_tracker_frames(raw, order=["order"], bucket=(F.col("order") / 256).cast("bigint")))


def _flat_tracker(fr):
    return fr.select(
        "pid", "record", "aux", "index", F.col("timestamp").alias("ts_us"), "tracking",
        F.col("offset.x").alias("offset_x"), F.col("target.s").alias("target_s"),
        F.col("rotation.yaw").alias("yaw"), F.col("eyes.left.s").alias("eye_l_s"),
        F.col("gazepoint.right.y").alias("gaze_r_y"), F.col("gazedur").alias("gazedur_us"),
        F.size("faceshape").alias("face_n"), F.col("faceshape")[2]["y"].alias("face_2_y"),
    )


@query("video_parts")
def q_video_parts(spark, sf):
    """A listing of extracted webcam parts (every clip's part file,
    plus a filler `-gap` file beside each first fragment) parsed back to
    (pid, record, study, aux), filler files hidden."""
    from ..sources.readers import video_parts

    m = clip_manifest(px.archive_manifest(px.load(spark, sf, "events")))
    listing = m.select(F.concat(F.lit("webcam/"), "part_path").alias("member"), "size").unionByName(
        m.where(F.col("aux") == 1).select(
            F.format_string("webcam/P_%02d/%02d-%s-gap.mp4", "pid", "record", "study").alias("member"),
            F.lit(0).cast("bigint").alias("size"),
        )
    )
    return video_parts(listing).select("pid", "record", "study", "aux", "member", "size")


@query("form_delays")
def q_form_delays(spark, sf):
    """D11 clocks: webcam and screen start after the log start, webcam after
    screen, per participant (us)."""
    from ..operators.form import form_delays

    return form_delays(form_of(spark, sf)).select("pid", "webcam_delay", "screen_delay", "video_delay")
