"""Raw files as streams.

Files that land in a folder are parsed by the functions of the batch readers
(`sources.parse`), so strict mode is as loud and tolerant mode sets aside the
same input.

`log_stream` is D3 + D11 as one plan, for a sink of the caller's.
`start_views` runs a source (browser logs, eye-tracker recordings, dot tests)
to its tidy table, its rejects and its views (D12-D16) by `foreachBatch`: the
files of a batch are whole, so every rule on files, such as the one on a
recording's last line, holds in a batch. A table is one folder per batch,
written through `staged_write`: a batch that is run again after a failure
replaces its folder, so rows are neither lost nor doubled.

Progress lives in a checkpoint folder on shared storage that the caller
names: a restarted query goes on where it stopped."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import pid_from_name
from ..operators.form import viewport_offsets
from ..operators.gaze import shape_dots, shape_gaze
from ..operators.log import normalize_log
from ..operators.timelines import dot_points, event_log, merge_gaze, mouse_points, recording_markers, with_timelines
from ..schemas import DOT_TSV_SCHEMA
from ..sinks import staged_write
from ..sources.parse import gaze_rejects, log_rejects, parse_gaze_lines, parse_log_text, type_fields


def _file_stream(spark: SparkSession, path: str, max_files: int) -> DataFrame:
    """Files read whole: (source, value)."""
    raw = spark.readStream.option("wholetext", True).option("maxFilesPerTrigger", max_files).text(path)
    return raw.select(F.col("_metadata.file_path").alias("source"), "value")


def _line_stream(spark: SparkSession, path: str, max_files: int) -> DataFrame:
    """Lines: (source, block, value); rows are numbered in the batch."""
    raw = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    return raw.select(F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block"), "value")


def _tsv_stream(spark: SparkSession, path: str, max_files: int) -> DataFrame:
    """Records of dot-test files, as text."""
    text = StructType([StructField(f.name, StringType()) for f in DOT_TSV_SCHEMA.fields])
    raw = spark.readStream.schema(text).options(header=True, sep="\t", maxFilesPerTrigger=max_files).csv(path)
    return raw.select(F.col("_metadata.file_path").alias("source"), *text.names)


def read_log_stream(spark: SparkSession, path: str, max_files: int = 100, strict: bool = True) -> DataFrame:
    """Raw log files (one JSON array each) arriving under `path`, tagged
    with the participant of their folder; what doesn't parse raises, or is
    left out if not `strict`."""
    files = _file_stream(spark, path, max_files).withColumn("pid", pid_from_name("source", strict))
    return parse_log_text(files, strict).drop("source")


def log_stream(spark: SparkSession, path: str, form: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """The tidy log of a stream of raw files; with a form, on every clock."""
    tidy = normalize_log(read_log_stream(spark, path, strict=strict), strict)
    return with_timelines(tidy, form) if form is not None else tidy


def start_log_sink(
    df: DataFrame,
    out: str,
    checkpoint: str,
    name: str = "log_stream",
    available_now: bool = False,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Append the stream to Parquet partitioned by pid. `checkpoint`: the
    stream's own folder on shared storage, the same one at every start, so
    that a restarted query goes on where it stopped. `available_now`
    processes what is there and stops (a catch-up or scheduled run)."""
    w = (
        df.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .partitionBy("pid")
        .outputMode("append")
        .queryName(name)
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


# --- views of a stream --------------------------------------------------------------


class _Source(NamedTuple):
    """How a batch of raw rows becomes a tidy table, rejects and views."""

    stream: Callable[[SparkSession, str, int], DataFrame]
    tidy: Callable[[DataFrame, DataFrame, bool], DataFrame]
    rejects: Callable[[DataFrame], DataFrame] | None
    views: dict[str, Callable[[DataFrame, DataFrame], DataFrame]]


def _clocks(view: Callable[[DataFrame], DataFrame], keep: list[str] | None = None):
    return lambda tidy, form: view(with_timelines(tidy, form, keep=keep) if keep else with_timelines(tidy, form))


def _with_viewport(form: DataFrame) -> DataFrame:
    """The tidy form table doesn't hold the viewport offsets."""
    if "screen_viewport_y" in form.columns:
        return form
    return form.join(F.broadcast(viewport_offsets(form.sparkSession)), "setting", "left")  # two rows


def _numbered(lines: DataFrame) -> DataFrame:
    return lines.withColumn("row", F.monotonically_increasing_id())


SOURCES = {
    "log": _Source(
        _file_stream, lambda files, form, strict: normalize_log(parse_log_text(files, strict).drop("source"), strict),
        log_rejects,
        {"events": _clocks(event_log), "markers": _clocks(recording_markers), "mouse": _clocks(mouse_points)}),
    "tobii": _Source(
        _line_stream, lambda lines, form, strict: shape_gaze(parse_gaze_lines(_numbered(lines), strict)),
        lambda lines: gaze_rejects(_numbered(lines)), {"gaze": _clocks(merge_gaze, ["display_resolution"])}),
    "dot": _Source(
        _tsv_stream, lambda rows, form, strict: shape_dots(type_fields(rows, DOT_TSV_SCHEMA).drop("source"), _with_viewport(form)),
        None, {"dots": _clocks(dot_points)}),
}


def start_views(
    spark: SparkSession,
    kind: str,
    path: str,
    form: DataFrame,
    out: str,
    checkpoint: str,
    strict: bool = True,
    available_now: bool = False,
    interval: str = "1 minute",
    max_files: int = 100,
) -> StreamingQuery:
    """Stream the raw files of `kind` (log, tobii or dot) under `path` into
    tables under `out`: the tidy table `kind`, its views with the clocks of
    `form`, and unless `strict` its rejects. Strict: a file that doesn't parse
    stops the query, and none of its batch is written."""
    source = SOURCES[kind]

    def batch(raw: DataFrame, number: int) -> None:
        session = raw.sparkSession

        def save(name: str, df: DataFrame) -> DataFrame:
            place = f"{out}/{name}/batch={number}"
            staged_write(session, place, lambda stage: df.write.option("compression", "lz4").parquet(stage), overwrite=True)
            return session.read.schema(df.schema).parquet(place)

        raw = raw.withColumn("pid", pid_from_name("source", strict))
        tidy = save(kind, source.tidy(raw, form, strict))  # views read the saved rows: raw text is parsed once
        if not strict and source.rejects:
            save(f"{kind}_rejects", source.rejects(raw))
        for name, view in source.views.items():
            save(name, view(tidy, form))

    w = source.stream(spark, path, max_files).writeStream.option("checkpointLocation", checkpoint).queryName(f"{kind}_views")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.foreachBatch(batch).start()
