"""Lines and whole texts of raw files to rows.

How bytes become lines differs between a folder and the archive; how lines
become rows does not, so both call these functions. Each takes a DataFrame
with a `value` column; its other columns pass through.

Strict mode is loud: what does not parse raises. Tolerant mode leaves such
input out, and the `*_rejects` functions return it, so nothing is lost
without a trace; an `Observation` counts both in the pass that parses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..schemas import FORM_CSV_SCHEMA, LOG_JSON_SCHEMA, TOBII_JSON_SCHEMA, TRACKER_JSON_SCHEMA

_JSON = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "allowNonNumericNumbers": "true"}


def _rest(df: DataFrame, *drop: str) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns if c not in ("value", *drop)]


def _bad() -> Column:
    """Was `_r` not parsed, or not wholly?"""
    return F.col("_r").isNull() | F.col("_r._corrupt_record").isNotNull()


def _once(value: Column, name: str) -> Column:
    """`value` as a column that is computed once per row: a projection would
    be merged into each filter that reads it, and parse the text again."""
    return F.explode(F.array(value)).alias(name)


def counted(rows: DataFrame, bad: Column, watch: Observation | None) -> DataFrame:
    """`rows`, with the numbers of good and bad ones (`rows`, `rejects`)
    measured by `watch` in the pass that reads them."""
    if watch is None:
        return rows
    return rows.observe(
        watch, F.count(F.when(~bad, 1)).alias("rows"), F.count(F.when(bad, 1)).alias("rejects"))


# --- S4: browser logs -------------------------------------------------------------


def _events(files: DataFrame) -> DataFrame:
    """The elements of each file's array, each parsed alone: position,
    value (its text), `_r` (its fields). A file that is no array is one
    element without a position, holding the file."""
    whole = files.select("*", _once(F.from_json("value", ArrayType(StringType())), "_a"))
    each = whole.select(
        *_rest(files), F.col("_a").isNotNull().alias("_array"), F.when(F.col("_a").isNull(), F.col("value")).alias("_file"),
        F.posexplode_outer("_a").alias("position", "_e"))
    each = each.where(~F.col("_array") | F.col("position").isNotNull())  # an empty array has no element
    schema = StructType([*LOG_JSON_SCHEMA.fields, StructField("_corrupt_record", StringType())])
    element = F.when(F.col("_array"), F.coalesce("_e", F.lit("null")))
    return each.select(
        *_rest(files), F.col("position"), F.coalesce(element, "_file").alias("value"),
        _once(F.when(F.col("_array"), F.from_json("_e", schema, _JSON)), "_r"))


def parse_log_text(files: DataFrame, strict: bool = True, watch: Observation | None = None) -> DataFrame:
    """One JSON array per file (`value` = the whole file) to one row per
    event. What is no event - a file that holds no array or is cut off, an
    element with a field of the wrong type - raises in strict mode; otherwise
    it alone is left out (see `log_rejects`)."""
    rows = _events(files)
    bad = _bad()
    if strict:
        what = F.when(F.col("position").isNull(), "a log file holds no JSON array: ").otherwise("not a log event: ")
        bad = F.when(bad, F.raise_error(F.concat(what, F.left("value", F.lit(200))))).otherwise(bad)
    rows = counted(rows, _bad(), watch).where(~bad)
    return rows.select(*_rest(rows, "_r", "position"), "_r.*").drop("_corrupt_record")


def log_rejects(files: DataFrame) -> DataFrame:
    """What `parse_log_text(strict=False)` leaves out: the columns of the
    file, `position` in its array and `value` (no position: the file)."""
    return _events(files).where(_bad()).drop("_r")


# --- S5: eye-tracker samples ------------------------------------------------------


def _gaze(lines: DataFrame) -> DataFrame:
    some = lines.where(F.trim("value") != "")
    return some.select("*", _once(F.from_json("value", TOBII_JSON_SCHEMA, _JSON), "_r"))


def _unfinished() -> Column:
    """A record that begins and doesn't end."""
    return F.ltrim("value").startswith("{") & ~F.rtrim("value").endswith("}")


def _recordings(lines: DataFrame) -> DataFrame:
    """source, broken: has it a bad line other than an unfinished last one?
    `block` and `row` order the lines of a source. One row per source
    and block leaves a task, and it holds numbers only."""
    bad, row = _bad(), F.col("row")
    ends = _gaze(lines).groupBy("source", "block").agg(
        F.max("row").alias("last"), F.min(F.when(bad, row)).alias("bad"), F.min(F.when(bad & ~_unfinished(), row)).alias("noise"))
    ends = ends.groupBy("source").agg(
        F.max(F.struct("block", "last")).alias("last"), F.min("noise").alias("noise"),
        F.min(F.when(F.col("bad").isNotNull(), F.struct("block", "bad"))).alias("bad"))
    early = (F.col("bad.block") < F.col("last.block")) | (F.col("bad.bad") < F.col("last.last"))
    return ends.select("source", (F.col("bad").isNotNull() & (early | F.col("noise").isNotNull())).alias("broken"))


def broken_recordings(lines: DataFrame) -> DataFrame:
    """The recordings that strict mode refuses."""
    return _recordings(lines).where("broken").select("source")


def parse_gaze_lines(
    lines: DataFrame, strict: bool = True, check: bool = True, watch: Observation | None = None
) -> DataFrame:
    """NDJSON lines to samples. Only the unfinished last line of a
    recording, where it was cut off, is left out; any other line that doesn't
    parse raises in strict mode. Where a recording ends is known from the
    columns `source`, `block` and `row`, which are dropped.

    With `check=False` strict mode raises for lines that are no record at
    all, but leaves out every unfinished line; the caller looks at the
    number in `watch` and, if there are any, at `broken_recordings`. That
    spares a second pass over recordings that are whole. Tolerant mode
    leaves out whatever doesn't parse (see `gaze_rejects`)."""
    parsed = _gaze(lines)
    bad = _bad()
    said = F.concat(F.lit("not an eye-tracker sample: "), F.left("value", F.lit(200)))
    if strict:
        bad = F.when(bad & ~_unfinished(), F.raise_error(said)).otherwise(bad)
    kept = counted(parsed, _bad(), watch).where(~bad)
    out = kept.select(*_rest(kept, "_r", "source", "block", "row"), "_r.*").drop("_corrupt_record")
    if strict and check:
        said = F.concat(F.lit("a line that is no eye-tracker sample before the end of "), F.col("source"))
        # one expression: apart, the error would be pushed below the grouping
        loud = _recordings(lines).where(F.when(F.col("broken"), F.raise_error(said).cast("boolean")).otherwise(F.lit(False)))
        out = out.unionByName(loud.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in out.schema.fields]))
    return out


def gaze_rejects(lines: DataFrame) -> DataFrame:
    """Lines that `parse_gaze_lines(strict=False)` leaves out."""
    return _gaze(lines).where(_bad()).drop("_r", "block", "row")


# --- S6, S7, S9: delimited lines --------------------------------------------------


def type_fields(records: DataFrame, schema: StructType, null: str = "", strict: bool = False) -> DataFrame:
    """The text columns that `schema` names, typed; other columns pass
    through. Empty text and `null` are null; a field that does not parse is
    null, or raises with `strict`."""
    rest = [F.col(f"`{c}`") for c in records.columns if c not in schema.names]

    def typed(f: StructField) -> Column:
        text = F.nullif(F.nullif(F.col(f"`{f.name}`"), F.lit("")), F.lit(null))
        if isinstance(f.dataType, StringType):
            return text.alias(f.name)
        return (text.cast(f.dataType) if strict else text.try_cast(f.dataType)).alias(f.name)

    return records.select(*rest, *[typed(f) for f in schema.fields])


def parse_delimited(
    lines: DataFrame, schema: StructType, sep: str = "\t", null: str = "", strict: bool = False
) -> DataFrame:
    """Delimited lines without the header, typed by
    `type_fields`."""
    text = ", ".join(f"`{f.name}` string" for f in schema.fields)
    parsed = lines.select(*_rest(lines), _once(F.from_csv("value", text, {"sep": sep}), "_r"))
    return type_fields(parsed.select(*_rest(parsed, "_r"), "_r.*"), schema, null, strict)


# --- S3: questionnaire records ----------------------------------------------------


def type_form_fields(records: DataFrame, fields: str = "fields") -> DataFrame:
    """S3: records split into text fields, in the order of the header, typed
    by FORM_CSV_SCHEMA; `-` and empty are null, a field of the wrong type
    raises."""
    named = records.select(*[F.get(F.col(fields), i).alias(f.name) for i, f in enumerate(FORM_CSV_SCHEMA.fields)])
    return type_fields(named, FORM_CSV_SCHEMA, null="-", strict=True)


def first_source(records: DataFrame, source: str = "source") -> DataFrame:
    """S3: the records of the first source by name."""
    first = records.agg(F.min(source).alias("_first"))  # one row
    return records.join(F.broadcast(first), F.col(source) == F.col("_first")).drop("_first")


# --- S11: tracker frames ----------------------------------------------------------


def parse_tracker_lines(lines: DataFrame) -> DataFrame:
    """NDJSON lines of tracker output to rows; a line that doesn't parse
    is a row of nulls, so the numbering of frames is that of the lines."""
    parsed = lines.select(*_rest(lines), F.from_json("value", TRACKER_JSON_SCHEMA).alias("_r"))
    return parsed.select(*_rest(parsed, "_r"), "_r.*")
