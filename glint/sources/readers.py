"""Readers of the raw study files.

Every reader takes a path or glob understood by Spark (a shared folder on
a cluster) and returns one DataFrame for all participants at once: a
multi-path read tagged with the participant number parsed from each file's
path (`_metadata.file_path`), never a Python loop over files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import pid_from_name
from ..schemas import (
    ALIGNMENT_CSV_SCHEMA,
    CALIB_TSV_SCHEMA,
    DOT_TSV_SCHEMA,
    FORM_CSV_SCHEMA,
)
from .parse import (
    first_source,
    gaze_rejects,
    log_rejects,
    parse_gaze_lines,
    parse_log_text,
    parse_tracker_lines,
    type_fields,
    type_form_fields,
)

FILE = "_metadata.file_path"


def _files(spark: SparkSession, path: str, strict: bool) -> DataFrame:
    """Files read whole: (pid, source, value). Spark's file sources skip a
    file of no bytes, so it has no row (a member of the archive has)."""
    df = spark.read.format("binaryFile").load(path).select(F.col("path").alias("source"), F.col("content").cast("string").alias("value"))
    return df.withColumn("pid", pid_from_name("source", strict))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of files split over tasks: source, block and row (the split's
    start and the row in it order the lines of a file), value."""
    return spark.read.text(path).select(
        F.col(FILE).alias("source"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value")


def _table(spark: SparkSession, path: str, schema, sep: str, **options) -> DataFrame:
    """Records of delimited files below their header line: source, and the
    columns of `schema` as text."""
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    df = spark.read.schema(text).options(header=True, sep=sep, enforceSchema=True, mode="PERMISSIVE", **options).csv(path)
    return df.select(F.col(FILE).alias("source"), *[F.col(f"`{f.name}`") for f in text.fields])


def read_form_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: the questionnaire CSV, typed by `type_form_fields`; of several
    matching files the first by name. A quoted note may hold line breaks."""
    records = _table(spark, path, FORM_CSV_SCHEMA, ",", quote='"', escape='"', multiLine=True)
    fields = F.array(*[F.col(f"`{f.name}`") for f in FORM_CSV_SCHEMA.fields]).alias("fields")
    return type_form_fields(first_source(records.select("source", fields)))


def read_log_json(
    spark: SparkSession, path: str, strict: bool = True, rejects: bool = False, watch: Observation | None = None
) -> DataFrame:
    """Browser logs, one JSON array per file, tagged with pid.
    `rejects=True` returns what does not parse (pid, source, position,
    value)."""
    files = _files(spark, path, strict)
    return log_rejects(files) if rejects else parse_log_text(files, strict, watch).drop("source")


def tobii_lines(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """The lines of eye-tracker recordings (pid, source, block, row, value)."""
    return _lines(spark, path).withColumn("pid", pid_from_name("source", strict))


def read_tobii(
    spark: SparkSession, path: str, strict: bool = True, rejects: bool = False, check: bool = True,
    watch: Observation | None = None,
) -> DataFrame:
    """Eye-tracker NDJSON, tagged with pid; the files are split by lines.
    `rejects=True` returns the lines that are left out (pid, source, value);
    `check`, `watch`: see `parse_gaze_lines`."""
    lines = tobii_lines(spark, path, strict)
    return gaze_rejects(lines) if rejects else parse_gaze_lines(lines, strict, check, watch)


def _tsv(spark: SparkSession, schema, path: str, strict: bool) -> DataFrame:
    rows = type_fields(_table(spark, path, schema, "\t"), schema)
    return rows.withColumn("pid", pid_from_name("source", strict)).drop("source")


def read_dot_tsv(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Dot-test TSV; a field that does not parse is null."""
    return _tsv(spark, DOT_TSV_SCHEMA, path, strict)


def read_calib_tsv(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Calibration TSV; a field that does not parse is null (the row is
    then dropped by `shape_calibration`). The file glob is a parameter."""
    return _tsv(spark, CALIB_TSV_SCHEMA, path, strict)


def read_spec_text(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Device spec files, each read whole (pid, value); feed to
    `spec_lines` + `parse_specs`."""
    return _files(spark, path, strict).select("pid", "value")


def read_alignment_csv(spark: SparkSession, path: str) -> DataFrame:
    """The clip alignment CSV; `-` and empty are null, a field that does
    not parse raises."""
    return type_fields(_table(spark, path, ALIGNMENT_CSV_SCHEMA, ","), ALIGNMENT_CSV_SCHEMA, null="-", strict=True).drop("source")


def read_tracker_frames(spark: SparkSession, path: str) -> DataFrame:
    """Tracker-output NDJSON, one file per clip named `P<pid>_R<record>_A<aux>`.

    Adds the keys parsed from the file stem and two order columns that
    follow the file: the split's start offset and a per-split increasing
    id. `shape_tracker_frames(df, order=["_block", "_row"],
    bucket=F.col("_block"))` numbers rows in file order even when a file
    is read in several splits."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    stem = F.regexp_extract(F.col(FILE), r"P(\d+)_R(\d+)_A(\d+)\.[^/]*$", 0)
    pat = r"P(\d+)_R(\d+)_A(\d+)"

    def key(i):
        g = F.regexp_extract(stem, pat, i)
        return F.when(g != "", g.cast("int"))

    keyed = lines.select(
        "value",
        key(1).alias("pid"),
        key(2).alias("record"),
        key(3).alias("aux"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return parse_tracker_lines(keyed)


def read_video_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Video files under a folder as (member, size); only the path and
    length are read, never the bytes."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return df.select(F.col("path").alias("member"), F.col("length").alias("size"))


def video_parts(manifest: DataFrame, gaps: bool = False) -> DataFrame:
    """Extracted webcam parts `P_dd/RR-study[-aux|-gap].mp4` parsed to
    (pid, record, study, aux, gap); filler (`-gap`) files hidden unless
    `gaps`."""
    pat = r"P_(\d+)/(\d+)-([a-z_]+)(-(\d+))?(-gap)?\.mp4$"
    m = F.col("member")
    out = manifest.where(m.rlike(pat)).select(
        "member", "size",
        F.regexp_extract(m, pat, 1).cast("int").alias("pid"),
        F.regexp_extract(m, pat, 2).cast("int").alias("record"),
        F.regexp_extract(m, pat, 3).alias("study"),
        F.when(F.regexp_extract(m, pat, 5) != "", F.regexp_extract(m, pat, 5).cast("int")).alias("aux"),
        (F.regexp_extract(m, pat, 6) != "").alias("gap"),
    )
    return out if gaps else out.where(~F.col("gap"))
