"""Browser-log operators: D3 normalize_log, D4 align_log, D5 parse_alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    add_us,
    checked,
    from_millis,
    ms_to_us,
    split_part,
    strip_affixes,
    value_map,
)
from ..schemas import (
    CLIP_STUDY_MARK,
    CLIP_SUFFIX,
    MOUSE_TYPES,
    PAGE_RENAMES,
    RECORDING_TYPES,
    STUDIES,
    TYPE_ALIASES,
    VIDEO_EVENTS,
    VIDEO_SAVED,
)

LOG_COLUMNS = [
    "pid", "record", "timestamp", "study", "event", "source", "trusted",
    "duration", "caret", "text", "page", "mouse", "scroll", "window",
    "inner", "outer",
]


def study_from_page(page, strict: bool = True):
    """`/study/<name>.htm` -> study name, checked against the closed set."""
    name = value_map(strip_affixes(page, "/study/", ".htm"), PAGE_RENAMES)
    return checked(name, STUDIES, "study", strict)


def canonical_event():
    """Canonical event name from the raw `type` / `event` pair (D3)."""
    typ, ev = F.col("type"), F.col("event")
    return (
        F.when(typ.isNotNull(), value_map(typ, TYPE_ALIASES))
        .when(ev == VIDEO_SAVED, F.lit("save"))
        .otherwise(F.lit(None).cast("string"))
    )


def event_source():
    """Source class of a raw log row (D3)."""
    typ, ev = F.col("type"), F.col("event")
    return (
        F.when(typ.isin(RECORDING_TYPES) | ev.isin(VIDEO_EVENTS), "log")
        .when(typ.isin(MOUSE_TYPES), "mouse")
        .when(typ == "scrollEvent", "scroll")
        .when(typ == "textInput", "input")
        .when(typ == "text_input", "text")
        .otherwise("log")
    )


def normalize_log(raw: DataFrame, strict: bool = True) -> DataFrame:
    """D3: raw browser-log rows (LOG_JSON_SCHEMA + `pid`) to the tidy log.

    Stateless and row-local, so it also runs on a streaming DataFrame. Row
    order is not part of the result; sinks sort within partitions."""

    def pair(a: str, b: str, x: str, y: str, t: str):
        return F.struct(F.col(x).cast(t).alias(a), F.col(y).cast(t).alias(b))

    record = split_part("sessionId", "_", 1)
    return raw.select(
        F.col("pid").cast("int").alias("pid"),
        (record.cast("int") if strict else record.try_cast("int")).alias("record"),
        from_millis("epoch").alias("timestamp"),
        study_from_page(F.col("webpage"), strict).alias("study"),
        canonical_event().alias("event"),
        event_source().alias("source"),
        F.col("isTrusted").alias("trusted"),
        ms_to_us("time").alias("duration"),
        F.when(
            F.col("pos").isNotNull(),
            pair("top", "left", "pos.top", "pos.left", "bigint"),
        ).alias("caret"),
        F.col("text"),
        pair("x", "y", "pageX", "pageY", "bigint").alias("page"),
        pair("x", "y", "screenX", "screenY", "int").alias("mouse"),
        pair("x", "y", "scrollX", "scrollY", "bigint").alias("scroll"),
        pair("x", "y", "windowX", "windowY", "int").alias("window"),
        pair("w", "h", "windowInnerWidth", "windowInnerHeight", "int").alias("inner"),
        pair("w", "h", "windowOuterWidth", "windowOuterHeight", "int").alias("outer"),
    )


def clip_name(name):
    """A raw webcam clip file name as struct(log, record, study, aux) (X1
    without a UDF; aux is null when the name has no ` (n)` suffix). The name
    is split by its naming rule; the struct is null for any other name."""
    def let(value, body):  # `value` is evaluated once
        return F.get(F.transform(F.array(value), body), 0)

    def parts(sides):
        numbers, rest = F.split(F.get(sides, 0), "_"), F.get(sides, 1)
        stem = F.left(rest, F.length(rest) - len(CLIP_SUFFIX))
        found = F.struct(
            F.when(F.size(numbers) == 2, F.get(numbers, 0).try_cast("bigint")).alias("log"),
            F.get(numbers, 1).try_cast("int").alias("record"),
            F.substring_index(stem, " (", 1).alias("study"),
            F.when(stem.contains(" ("), F.rtrim(F.substring_index(stem, " (", -1), F.lit(")")).try_cast("int")).alias("aux"),
            stem.contains(" (").alias("numbered"),
        )
        return F.when((F.size(sides) == 2) & rest.endswith(CLIP_SUFFIX), found)

    whole = let(F.split(F.element_at(F.split(name, "/"), -1), CLIP_STUDY_MARK), parts)
    return let(whole, lambda c: F.when(
        c["log"].isNotNull() & c["record"].isNotNull() & (c["study"] != "") & (c["aux"].isNotNull() | ~c["numbered"]), c))


def with_clip_name(df: DataFrame, name) -> DataFrame:
    """`df` with the struct `_clip` of `clip_name`."""
    return df.withColumn("_clip", clip_name(name))


def parse_alignment(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of the alignment CSV (video, frameshift s, corrOptimal,
    corrOrig) to (pid, log, record, study, aux, frameshift us).

    `aux` is kept so that fragments of one clip can be told apart; the
    shift is cut to whole milliseconds like the source data."""
    named = with_clip_name(raw, F.col("video"))
    study = F.col("_clip.study")
    log = F.col("_clip.log")
    if strict:
        log = F.when(F.col("_clip").isNotNull(), log).otherwise(
            F.raise_error(F.concat(F.lit("unparsable clip name: "), F.col("video")))
        )
    pid = split_part(split_part("video", "/", 0), "_", 1)
    return named.select(
        (pid.cast("int") if strict else pid.try_cast("int")).alias("pid"),
        log.alias("log"),
        F.col("_clip.record").alias("record"),
        checked(study, STUDIES, "study", strict).alias("study"),
        F.col("_clip.aux").alias("aux"),
        ms_to_us(F.col("frameshift") * F.lit(1e3)).alias("frameshift"),
    )


def clip_shifts(alignment: DataFrame) -> DataFrame:
    """One frame shift per (pid, record, study): the clip without a fragment
    number (or the lowest one) decides, a missing shift counting as 0 and
    a tie taking the smaller shift. Fragments share the key, so a plain
    join would repeat log rows."""
    pick = F.min(F.struct(
        F.coalesce(F.col("aux"), F.lit(0)).alias("aux"),
        F.coalesce(F.col("frameshift"), F.lit(0)).alias("shift"),
    ))
    return alignment.groupBy("pid", "record", "study").agg(pick["shift"].alias("frameshift"))


def align_log(log: DataFrame, alignment: DataFrame, dedupe: bool = False) -> DataFrame:
    """Subtract each clip's frame shift from its log rows (missing = 0).

    A log row meets every clip of its (pid, record, study), so it comes once
    per clip (J8). `dedupe=True` takes one shift per key (`clip_shifts`) and
    keeps the number of log rows. The shift table is joined without a
    broadcast hint: the planner broadcasts it while its measured size is
    under the threshold, and shuffles otherwise."""
    shifts = clip_shifts(alignment) if dedupe else alignment.select("pid", "record", "study", "frameshift")
    joined = log.join(shifts, ["pid", "record", "study"], "left")
    return joined.withColumn(
        "timestamp", add_us("timestamp", -F.coalesce(F.col("frameshift"), F.lit(0)))
    ).select(*log.columns)
