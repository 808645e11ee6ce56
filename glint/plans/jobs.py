"""The two batch jobs (E1 `etl`, E2 `prepare`) as DataFrame plans.

`etl` reads the raw study files (an unpacked folder on shared storage, or
the zip through the `zipmembers` source) and writes the tidy tables;
`prepare` reads the tidy tables and writes the per-participant views. Each
table is one Spark write; no participant loop runs on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.form import build_form, clean_form, parse_specs, spec_lines
from ..operators.gaze import calibration_targets, shape_calibration, shape_dots, shape_gaze
from ..operators.log import align_log, normalize_log, parse_alignment
from ..operators.recordings import clip_timeline, frame_index, recording_durations, recording_stops
from ..operators.timelines import (
    dot_points,
    event_log,
    merge_gaze,
    mouse_points,
    recording_markers,
    with_timelines,
)
from ..sinks import build_tables, finished, write_bucketed, write_partitioned, write_table
from ..sources import readers as R
from ..sources import archive as Z
from ..sources.parse import broken_recordings

TABLES = ["form", "log", "tobii", "dot", "calib"]


GAZE_FILES = "P_*/{P_[0-9],P_[0-9]*[0-9]}.txt"


def raw_sources(
    spark: SparkSession,
    root: str,
    layout: str = "dir",
    calib_glob: str = "*calibration*.tsv",
    strict: bool = True,
    check: bool = True,
    watch: dict[str, Observation] | None = None,
    index: str | None = None,
):
    """Raw DataFrames of every source, from a folder or a zip. `watch` counts
    what is parsed and what is not of `log` and `tobii`; `check=False` leaves
    the look at unfinished eye-tracker lines to the caller; `index` (zip): see
    `index_zip`."""
    seen = watch or {}
    if layout == "zip":
        return {
            "form": lambda: Z.zip_form(spark, root),
            "log": lambda: Z.zip_logs(spark, root, strict, watch=seen.get("log")),
            "tobii": lambda: Z.zip_tobii(spark, root, strict, check=check, watch=seen.get("tobii"), index=index),
            "dot": lambda: Z.zip_dots(spark, root),
            "calib": lambda: Z.zip_calibration(spark, root, calib_glob.replace("*", ".*") + "$"),
            "spec": lambda: Z.zip_specs(spark, root),
        }
    return {
        "form": lambda: R.read_form_csv(spark, f"{root}/*participant_characteristics.csv"),
        "log": lambda: R.read_log_json(spark, f"{root}/P_*/*.json", strict, watch=seen.get("log")),
        "tobii": lambda: R.read_tobii(spark, f"{root}/{GAZE_FILES}", strict, check=check, watch=seen.get("tobii")),
        "dot": lambda: R.read_dot_tsv(spark, f"{root}/P_*/*final_dot_test_locations.tsv"),
        "calib": lambda: R.read_calib_tsv(spark, f"{root}/P_*/{calib_glob}"),
        "spec": lambda: R.read_spec_text(spark, f"{root}/P_*/*specs.txt"),
    }


def tidy_tables(
    spark: SparkSession,
    root: str,
    layout: str = "dir",
    alignment_path: str | None = None,
    sync: bool = True,
    strict: bool = True,
    align_first: bool = False,
    watch: dict[str, Observation] | None = None,
    index: str | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the tidy tables (E1): form, log, tobii, dot, calib.

    The webcam start comes from the log before alignment, as in the source
    data, so a positive shift can reject a participant's first clip (Q3);
    `align_first=True` takes it from the aligned log instead.

    The eye-tracker table leaves out every unfinished line; `etl` then asks
    `broken_recordings` if there were any (`watch` counts them), before the
    table appears."""
    src = raw_sources(spark, root, layout, strict=strict, check=False, index=index)
    counting = raw_sources(spark, root, layout, strict=strict, check=False, watch=watch, index=index)

    def log(raw: DataFrame) -> DataFrame:
        tidy = normalize_log(raw, strict)
        if alignment_path is None:
            return tidy
        return align_log(tidy, parse_alignment(R.read_alignment_csv(spark, alignment_path), strict))

    @cache
    def form() -> DataFrame:
        specs = parse_specs(spec_lines(src["spec"]()))
        starts = log(src["log"]()) if align_first else normalize_log(src["log"](), strict)
        return build_form(clean_form(src["form"](), strict), starts, specs, sync)

    return {
        "form": form,
        "log": lambda: log(counting["log"]()),
        "tobii": lambda: shape_gaze(counting["tobii"]()),
        "dot": lambda: shape_dots(src["dot"](), form()),
        "calib": lambda: shape_calibration(src["calib"]()),
    }


class Report(list):
    """The names of the tables written; `counts`: for log and tobii the
    numbers of `rows` parsed and `rejects` left out, measured in the pass
    that wrote the table (none for a table that was there already)."""

    def __init__(self, names: Iterable[str], counts: dict[str, dict[str, int]]):
        super().__init__(names)
        self.counts = counts


def etl(
    spark: SparkSession,
    root: str,
    out: str,
    process: Iterable[str] = TABLES,
    layout: str = "dir",
    alignment_path: str | None = None,
    sync: bool = True,
    overwrite: bool = False,
    dry_run: bool = False,
    align_first: bool = False,
    strict: bool = True,
    index: str | None = None,
    point_reads: bool = False,
) -> Report:
    """Raw files -> tidy tables under `out` (K7 picks the tables).

    form, log, dot, calib: one Parquet table each (K1). tobii, the big
    one: one folder per participant, sorted by time (K2). The pass that
    writes log and tobii counts what does not parse. With `strict` it is an
    error, and no table appears, unless it is the unfinished end of a
    recording: recordings are looked through a second time only if one has
    an unfinished line. `index`: restart points of the archive's recordings
    (`index_zip`). Without, it is written beside the table, as
    `log_rejects` and `tobii_rejects`, in a second pass only if there is any."""
    watch = {name: Observation(name) for name in ("log", "tobii")}
    builders = tidy_tables(spark, root, layout, alignment_path, sync, strict, align_first, watch, index)
    counts: dict[str, dict[str, int]] = {}
    process = list(process)
    if not strict:
        builders |= rejects(spark, root, layout, index)
        process += [f"{p}_rejects" for p in process if f"{p}_rejects" in builders]

    def whole() -> None:
        if strict and watch["tobii"].get["rejects"]:
            bad = [r["source"] for r in broken_recordings(gaze_lines(spark, root, layout, index)).limit(5).collect()]
            if bad:
                raise ValueError(f"lines that are no eye-tracker sample before the end of {', '.join(bad)}")

    def sink(name: str, df: DataFrame) -> None:
        path = f"{out}/tobii" if name == "tobii" else f"{out}/{name}.parquet"
        if dry_run or not overwrite and finished(spark, path):
            return
        if name == "tobii":
            # one recording file per participant: splits are already
            # clustered by pid, so no shuffle of the largest table
            write_partitioned(df, path, overwrite=overwrite, shuffle=False, check=whole)
        elif name == "form":
            write_table(df.drop("screen_viewport_y"), path, overwrite)
        elif name == "log" and point_reads:  # columns without a dictionary want compression
            write_table(df, path, overwrite, keys=["pid", "timestamp"], points=["pid", "study"], compression="zstd")
        elif name in ("log", "dot"):
            write_table(df, path, overwrite, keys=["pid", "timestamp"])
        elif name == "calib":
            write_table(df, path, overwrite, keys=["pid"])
        elif counts.get(name.removesuffix("_rejects"), {"rejects": 1})["rejects"]:
            write_table(df, path, overwrite)
        else:  # nothing was left out: no second pass to find that
            write_table(spark.createDataFrame([], df.schema), path, overwrite)
        if name in watch:
            counts[name] = dict(watch[name].get)

    return Report(build_tables(builders, process, sink), counts)


def gaze_lines(spark: SparkSession, root: str, layout: str = "dir", index: str | None = None) -> DataFrame:
    """The lines of all eye-tracker recordings."""
    return Z.zip_tobii_lines(spark, root, index=index) if layout == "zip" else R.tobii_lines(spark, f"{root}/{GAZE_FILES}")


def rejects(spark: SparkSession, root: str, layout: str = "dir", index: str | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the tables of what tolerant parsing leaves out."""
    if layout == "zip":
        return {
            "log_rejects": lambda: Z.zip_logs(spark, root, False, rejects=True),
            "tobii_rejects": lambda: Z.zip_tobii(spark, root, False, rejects=True, index=index),
        }
    return {
        "log_rejects": lambda: R.read_log_json(spark, f"{root}/P_*/*.json", False, rejects=True),
        "tobii_rejects": lambda: R.read_tobii(spark, f"{root}/{GAZE_FILES}", False, rejects=True),
    }


def load_table(spark: SparkSession, root: str, name: str, **options) -> DataFrame:
    """A tidy table (tobii is a folder partitioned by pid); `options`
    go to the Parquet reader."""
    path = f"{root}/tobii" if name == "tobii" else f"{root}/{name}.parquet"
    return spark.read.options(**options).parquet(path)


def table_schema(spark: SparkSession, root: str, name: str, **options):
    """The schema of a tidy table, without reading its rows."""
    return load_table(spark, root, name, **options).schema


VIEWS = ["events", "markers", "mouse", "gaze", "dots", "targets", "durations", "timeline", "frames"]


def views(
    spark: SparkSession,
    root: str,
    clips: DataFrame | None = None,
    frames: DataFrame | None = None,
    screen_videos: DataFrame | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the prepared views (E2). `clips` (pid, record, study,
    duration us) and `frames` (pid, video, frame us) come from video
    metadata; `screen_videos` lists the pids that have a screen video."""
    form = load_table(spark, root, "form")
    log = load_table(spark, root, "log")
    screen = screen_videos if screen_videos is not None else True

    def tl(df: DataFrame) -> DataFrame:
        return with_timelines(df, form, screen=screen)

    out = {
        "events": lambda: event_log(tl(log)),
        "markers": lambda: recording_markers(tl(log)),
        "mouse": lambda: mouse_points(tl(log)),
        "gaze": lambda: merge_gaze(with_timelines(load_table(spark, root, "tobii"), form, screen=screen,
                                                  keep=["display_resolution"])),
        "dots": lambda: dot_points(tl(load_table(spark, root, "dot"))),
        "targets": lambda: calibration_targets(log, form),
        "durations": lambda: recording_durations(log),
    }
    if clips is not None:
        starts = log.where(F.col("event") == "start").select("pid", "record", "study", "timestamp")
        out["timeline"] = lambda: clip_timeline(starts, clips, form)
    if frames is not None:
        out["frames"] = lambda: frame_index(frames, form, screen)
    return out


def prepare(
    spark: SparkSession,
    root: str,
    out: str,
    process: Iterable[str] = VIEWS,
    overwrite: bool = False,
    **inputs,
) -> list[str]:
    """Tidy tables -> views under `out`, each partitioned by pid and
    sorted by time within the participant (one write per view)."""
    builders = views(spark, root, **inputs)
    order = {"timeline": "offset", "frames": "frame", "durations": "start", "targets": "timestamp"}

    def sink(name: str, df: DataFrame) -> None:
        # calibration targets go out as CSV per participant (key left out)
        fmt = "csv" if name == "targets" else "parquet"
        # the gaze view comes row by row from the tidy eye-tracker table,
        # already one folder per participant: sort within tasks, no shuffle
        write_partitioned(df, f"{out}/{name}", order=order.get(name, "timestamp"), overwrite=overwrite,
                          fmt=fmt, shuffle=name != "gaze")

    return build_tables(builders, process, sink)


def bucket_study(spark: SparkSession, root: str, out: str, alignment: DataFrame | None = None, buckets: int = 200, overwrite: bool = False) -> list[str]:
    """The tidy log, the ends of recordings (`recording_stops`) and the clip
    shifts of `alignment` as tables bucketed by (pid, record): D10, D4 and D17
    over them (`bucketed_table`) need no shuffle."""
    log = load_table(spark, root, "log")
    tables = {"log": log, "ends": recording_stops(log)}
    if alignment is not None:
        tables["shifts"] = alignment.select("pid", "record", "study", "frameshift")
    for name, df in tables.items():
        write_bucketed(df, f"{out}/{name}", ["pid", "record"], buckets, ["timestamp"] if name == "log" else None, overwrite)
    return list(tables)


def tracker_frames(spark: SparkSession, path: str, out: str, overwrite: bool = False) -> DataFrame:
    """Tracker-output NDJSON per clip -> one lz4 Parquet table (K4),
    rows numbered in file order and sorted by (pid, record, aux, index)."""
    from pyspark.sql import functions as F

    from ..operators.frames import shape_tracker_frames
    from ..sinks import write_sorted

    raw = R.read_tracker_frames(spark, path)
    frames = shape_tracker_frames(raw, order=["_block", "_row"], bucket=F.col("_block"))
    return write_sorted(frames, out, ["pid", "record", "aux", "index"], overwrite=overwrite)
