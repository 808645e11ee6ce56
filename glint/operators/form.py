"""Participant (form) operators: D1 clean_form, D2 build_form, D9
parse_specs, D19 domain checks, S13 lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions import (
    add_us,
    checked,
    diff_us,
    duration_text_us,
    from_millis,
    minute_of_day,
    split_part,
)
from ..schemas import (
    FORM_COLUMNS,
    FORM_DOMAINS,
    SCREEN_START_ADJUSTMENTS,
    SPEC_FREQUENCY,
    SPEC_ILLUMINATION,
    STUDIES,
    VIEWPORT_Y,
)

CORNERS = [
    ("Back", "Lower", "Left"), ("Back", "Lower", "Right"),
    ("Back", "Upper", "Left"), ("Back", "Upper", "Right"),
    ("Front", "Lower", "Left"), ("Front", "Lower", "Right"),
    ("Front", "Upper", "Left"), ("Front", "Upper", "Right"),
]


def corner_key(depth: str, height: str, side: str) -> str:
    """`Back Lower Left` -> `b_lo_l`."""
    return f"{depth[0].lower()}_{height[:2].lower()}_{side[0].lower()}"


def clean_form(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Questionnaire rows (FORM_CSV_SCHEMA) to typed participant rows.

    Enum columns are checked against their closed sets (an unknown value
    raises in strict mode, becomes null otherwise); sizes become structs;
    the date and the H:M:S duration are parsed and dropped like the source
    table does."""
    c = {v: F.col(f"`{k}`") for k, v in FORM_COLUMNS.items()}
    time_of_day = c["time_of_day"]
    tod_ok = F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), time_of_day), F.lit("yyyy-MM-dd HH:mm"))
    if strict:
        time_of_day = F.when(time_of_day.isNull() | tod_ok.isNotNull(), time_of_day).otherwise(
            F.raise_error(F.concat(F.lit("bad time of day: "), time_of_day))
        )
    else:
        time_of_day = F.when(tod_ok.isNotNull(), time_of_day)
    if strict:
        # the date and the H:M:S duration are parsed, then dropped: a value
        # that does not parse still fails the strict read
        date_ok = F.try_to_timestamp(c["date"], F.lit("MM/dd/yyyy")).isNotNull()
        hms_ok = c["duration"].rlike(r"^\d+:\d+:\d+$")
        check = F.when(
            (c["date"].isNull() | date_ok) & (c["duration"].isNull() | hms_ok), F.lit(True)
        ).otherwise(F.raise_error(F.concat(
            F.lit("bad date or duration: "), F.coalesce(c["date"], F.lit("")), F.lit(" "),
            F.coalesce(c["duration"], F.lit("")))))
        raw = raw.where(check)
    enums = {
        name: checked(c[name], values, name, strict).alias(name)
        for name, values in FORM_DOMAINS.items()
        if name in c
    }
    pid = split_part(c["pid"], "_", 1)
    wall_ok = F.try_to_timestamp(c["wall_clock"], F.lit("MM/dd/yyyy HH:mm")).isNotNull()
    wall = F.to_timestamp_ntz(c["wall_clock"], F.lit("MM/dd/yyyy HH:mm"))
    return raw.select(
        (pid.cast("int") if strict else pid.try_cast("int")).alias("pid"),
        c["log"].alias("log"),
        enums["setting"],
        c["screen_distance"].alias("screen_distance"),
        from_millis(c["screen_start"]).alias("screen_start"),
        (wall if strict else F.when(wall_ok, wall)).alias("wall_clock"),
        enums["gender"],
        c["age"].cast("int").alias("age"),
        enums["race"],
        enums["skin_color"],
        enums["eye_color"],
        enums["facial_hair"],
        enums["vision"],
        (c["touch_typer"] == "Yes").alias("touch_typer"),
        enums["handedness"],
        enums["weather"],
        enums["pointing_device"],
        c["notes"].alias("notes"),
        time_of_day.alias("time_of_day"),
        minute_of_day(time_of_day).alias("time_of_day_min"),
        from_millis(c["log"]).alias("init_start"),
        F.struct(c["screen_width"].alias("w"), c["screen_height"].alias("h")).alias("screen_size"),
        F.struct(c["display_width"].alias("w"), c["display_height"].alias("h")).alias(
            "display_resolution"
        ),
    )


# --- S13: fixed lookup tables ------------------------------------------------------


def screen_adjustments(spark: SparkSession, sync: bool = True) -> DataFrame:
    """Per participant: how far the screen recording started before the
    first task (parsed text minus the clock correction), in microseconds.
    Empty when `sync` is off, which leaves every screen start null."""
    rows = [(int(p.removeprefix("P_")), text, ms) for p, text, ms in SCREEN_START_ADJUSTMENTS]
    schema = StructType([
        StructField("pid", IntegerType()),
        StructField("first_task", StringType()),
        StructField("clock_ms", IntegerType()),
    ])
    df = spark.createDataFrame(rows if sync else [], schema)
    return df.select(
        "pid",
        (duration_text_us("first_task", strict=True) - F.col("clock_ms").cast("bigint") * 1000).alias(
            "start_time"
        ),
    )


def viewport_offsets(spark: SparkSession) -> DataFrame:
    schema = StructType([
        StructField("setting", StringType()),
        StructField("screen_viewport_y", IntegerType()),
    ])
    return spark.createDataFrame(VIEWPORT_Y, schema)



def spec_lines(files: DataFrame, path_col: str = "path", text_col: str = "value") -> DataFrame:
    """One row per line of each spec file read whole (`wholetext`), with the
    line number, so that a repeated line keeps its last value."""
    return files.select(
        F.col("pid"),
        F.posexplode(F.split(F.col(text_col), r"\r?\n")).alias("line_no", "line"),
    )


def parse_specs(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Spec text lines (pid, line_no, line) to one row per participant:
    tracking_box (8 corners as ARRAY<DOUBLE>(3)), illumination_mode,
    frequency. Lines that match nothing are ignored; a repeated line keeps
    its last value; a corner that does not hold three numbers raises in
    strict mode and is null otherwise.

    The numbers are reduced by one hash aggregate of `max_by(value,
    line_no)` over doubles (24 coordinates and the frequency); the one text
    field is reduced separately over its own lines, since a text buffer
    would push the whole aggregate onto the sort-based path."""
    parsed = parse_spec_lines(lines, strict)
    return _pivot_specs(parsed)


def parse_spec_lines(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Spec lines to typed fields: (pid, line_no, corner, _x, _y, _z,
    illumination_mode, frequency); lines matching nothing are dropped."""
    # `<name>: <value>`; the name says what the line is
    name = F.substring_index("_l", ":", 1)
    corners = F.create_map(*[F.lit(x) for c in CORNERS for x in (" ".join(c), corner_key(*c))])
    step1 = lines.select("pid", "line_no", F.trim(F.col("line")).alias("_l")).select(
        "pid", "line_no", "_l", name.alias("_name"),
        F.trim(F.expr("substring(_l, length(substring_index(_l, ':', 1)) + 2)")).alias("_value"),
        F.try_element_at(corners, name).alias("corner"),
    ).where(F.col("_l").contains(":") & (
        F.col("corner").isNotNull() | F.col("_name").isin(SPEC_ILLUMINATION, SPEC_FREQUENCY)))
    first = F.substring_index("_value", " ", 1)
    step2 = step1.select(
        "pid", "line_no", "_l", "corner",
        F.when(F.col("_name") == SPEC_ILLUMINATION, F.col("_value")).alias("_illum"),
        F.when(F.col("_name") == SPEC_FREQUENCY, F.rtrim(first, F.lit("Hhz")).try_cast("double")).alias("_freq"),
        F.when(F.col("corner").isNotNull(), F.split(F.btrim("_value", F.lit(" ()\t\n")), ", ")).alias("_parts"),
    )
    step3 = step2.select(
        "pid", "line_no", "_l", "corner", "_illum", "_freq", F.size("_parts").alias("_n"),
        *[F.get("_parts", i).try_cast("double").alias(f"_{a}") for i, a in enumerate("xyz")],
    )
    good = (F.col("_n") == 3) & F.col("_x").isNotNull() & F.col("_y").isNotNull() & F.col("_z").isNotNull()
    if strict:
        good = F.when(F.col("corner").isNull() | good, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("bad tracking box line: "), F.col("_l"))))
    parsed = step3.select(
        "pid", "line_no", "corner",
        *[F.when(good, F.col(f"_{a}")).alias(f"_{a}") for a in "xyz"],
        F.col("_illum").alias("illumination_mode"), F.col("_freq").alias("frequency"),
    )
    return parsed


def _pivot_specs(parsed: DataFrame) -> DataFrame:
    keys = [corner_key(*c) for c in CORNERS]
    aggs = []
    for k in keys:
        at = F.when(F.col("corner") == k, F.col("line_no"))
        aggs += [F.max_by(F.col(f"_{a}"), at).alias(f"{k}_{a}") for a in "xyz"]
    aggs.append(F.max_by("frequency", F.when(F.col("frequency").isNotNull(), F.col("line_no"))).alias(
        "frequency"))
    numbers = parsed.groupBy("pid").agg(*aggs)
    texts = (
        parsed.where(F.col("illumination_mode").isNotNull())
        .groupBy("pid").agg(F.max_by("illumination_mode", "line_no").alias("illumination_mode"))
    )
    out = numbers.join(texts, "pid", "left")

    def point(k):
        xyz = [F.col(f"{k}_{a}") for a in "xyz"]
        return F.when(xyz[0].isNotNull() & xyz[1].isNotNull() & xyz[2].isNotNull(), F.array(*xyz)).alias(k)

    return out.select(
        "pid",
        F.struct(*[point(k) for k in keys]).alias("tracking_box"),
        "illumination_mode",
        "frequency",
    )


# --- D2 ------------------------------------------------------------------------------


def first_starts(log: DataFrame) -> DataFrame:
    """A1: earliest recording start per participant (partial + final min)."""
    return (
        log.where(F.col("event") == "start")
        .groupBy("pid")
        .agg(F.min("timestamp").alias("webcam_start"))
    )


def build_form(
    form: DataFrame,
    log: DataFrame,
    specs: DataFrame | None = None,
    sync: bool = True,
) -> DataFrame:
    """Participant table on one clock.

    webcam_start = the earliest recording start in the (unshifted) log;
    screen_start = webcam_start minus the screen adjustment, null for
    participants without one (the questionnaire's own screen start is
    dropped). Adds the viewport offset of the setting and the device spec.

    The two fixed tables (27 and 2 rows) are broadcast; the spec and the
    per-participant first start (one row per participant each) are joined
    without a hint, so the planner broadcasts them only below its size
    threshold."""
    spark = form.sparkSession
    adj = F.broadcast(screen_adjustments(spark, sync))
    off = F.broadcast(viewport_offsets(spark))
    out = form.drop("screen_start").join(adj, "pid", "left").join(off, "setting", "left")
    if specs is not None:
        out = out.join(specs, "pid", "left")
    out = out.join(first_starts(log), "pid", "left")
    out = out.withColumn("screen_start", add_us("webcam_start", -F.col("start_time"))).drop("start_time")
    cols = [c for c in form.columns if c != "screen_start"]
    extra = ["screen_viewport_y"]
    if specs is not None:
        extra += ["tracking_box", "illumination_mode", "frequency"]
    return out.select(*cols, *extra, "webcam_start", "screen_start")


def form_delays(form: DataFrame) -> DataFrame:
    """Clock offsets of a participant in microseconds: webcam and screen
    start after the log start, and webcam after screen (null without a
    screen start)."""
    return form.select(
        "pid",
        "init_start",
        "webcam_start",
        "screen_start",
        diff_us("webcam_start", "init_start").alias("webcam_delay"),
        diff_us("screen_start", "init_start").alias("screen_delay"),
        diff_us("webcam_start", "screen_start").alias("video_delay"),
    )


# --- D19 -------------------------------------------------------------------------------


def domain_table(spark: SparkSession) -> DataFrame:
    rows = [(col, v, i) for col, vals in FORM_DOMAINS.items() for i, v in enumerate(vals)]
    rows += [("study", s, i) for i, s in enumerate(STUDIES)]
    schema = StructType([
        StructField("column", StringType()),
        StructField("value", StringType()),
        StructField("ord", IntegerType()),
    ])
    return spark.createDataFrame(rows, schema)


def domain_violations(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """D19 (report mode): values of closed-set columns that are outside
    their set, with their row counts. The rows are unpivoted to
    (column, value), pre-aggregated, then anti-joined with the broadcast
    domain table (under 50 rows)."""
    known = {**FORM_DOMAINS, "study": STUDIES}
    cols = [c for c in (columns or list(known)) if c in df.columns]
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("kv")).select("kv.*").where(F.col("value").isNotNull())
    counted = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    dom = F.broadcast(domain_table(df.sparkSession).select(F.col("column").alias("column_name"), "value"))
    return counted.join(dom, ["column_name", "value"], "left_anti")


def check_domains(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """D19 (strict mode): the same columns, each passed through a check that
    raises on the first value outside its set."""
    known = {**FORM_DOMAINS, "study": STUDIES}
    return df.select(*[
        checked(F.col(c), known[c], c, True).alias(c) if c in known and (columns is None or c in columns)
        else F.col(c)
        for c in df.columns
    ])


__all__ = [
    "CORNERS", "build_form", "check_domains", "clean_form", "corner_key",
    "domain_table", "domain_violations", "first_starts", "form_delays",
    "parse_specs", "screen_adjustments", "spec_lines",
    "viewport_offsets",
]

