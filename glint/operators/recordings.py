"""Recording operators: D10 recording_durations, D20 clip timeline family."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import add_us, diff_us, padded, pid_from_name, study_ord
from ..schemas import MIN_FILLER_GAP_US, THANK_YOU
from ..session import ensure_checkpoint_dir, staged
from .log import with_clip_name
from .ordering import prefix_sum, prefixes, row_index


def recording_ends(log: DataFrame) -> DataFrame:
    """Per (pid, record): its latest stop and the earliest start of record
    + 1 (only for records above 1). Each start/stop row contributes to its
    own key (as a stop) and to key `record - 1` (as the next start), so one
    partial + final aggregate over one scan yields both lookups."""
    ev = log.where(F.col("event").isin("start", "stop")).select(
        "pid", "record", "event", "timestamp"
    )
    is_stop, is_start = F.col("event") == "stop", F.col("event") == "start"
    none = F.lit(None).cast("timestamp_ntz")
    contrib = ev.select(
        "pid",
        F.inline(F.array(
            F.struct(F.col("record").alias("record"),
                     F.when(is_stop, F.col("timestamp")).alias("stop"), none.alias("next")),
            F.struct((F.col("record") - 1).alias("record"), none.alias("stop"),
                     F.when(is_start & (F.col("record") - 1 > 1), F.col("timestamp")).alias("next")),
        )),
    )
    return contrib.groupBy("pid", "record").agg(
        F.max("stop").alias("stop"), F.min("next").alias("next")
    )


def recording_stops(log: DataFrame) -> DataFrame:
    """Every row that can end a recording, as (pid, record, end): its
    stops, and where it has none and its number is above 1 the starts of
    record + 1."""
    stops = log.where(F.col("event") == "stop").select("pid", "record", F.col("timestamp").alias("end"))
    # a next start counts for a recording without any stop: keys with one
    # are taken out of the (small) table of next starts
    nexts = log.where((F.col("event") == "start") & (F.col("record") > 2)).select(
        "pid", (F.col("record") - 1).alias("record"), F.col("timestamp").alias("end"))
    return stops.unionByName(nexts.join(stops.select("pid", "record"), ["pid", "record"], "left_anti"))


def recording_durations(log: DataFrame, dedupe: bool = False, ends: DataFrame | None = None) -> DataFrame:
    """How long each recording ran.

    Rows are the `start` events except the thank-you page. A recording ends
    at the stop of the same (pid, record) (J1); when it has none and its
    record number is above 1, at the start of record + 1 (J2, J3); otherwise
    the duration is null. Several stops, or several next starts, each give a
    row: starts x ends of a (pid, record), which is the rule, and quadratic
    for a recording with very many of both. `dedupe=True` reduces them first
    (`recording_ends`: the latest stop, the earliest next start), so that
    each start gives one row and a hot (pid, record) meets a one-row build
    side. `ends`: the table of `recording_stops`, if it was written before
    (bucketed like the log, it is joined without a shuffle)."""
    starts = log.where(
        (F.col("event") == "start") & (F.col("study") != THANK_YOU)
    ).select("pid", "record", "study", F.col("timestamp").alias("start"))
    if dedupe:
        out = starts.join(recording_ends(log), ["pid", "record"], "left")
        end = F.coalesce("stop", "next")
    else:
        out = starts.join(recording_stops(log) if ends is None else ends, ["pid", "record"], "left")
        end = F.col("end")
    return out.select(
        "pid", "record", "study", "start",
        end.alias("stop"),
        diff_us(end, F.col("start")).alias("duration"),
    )


# --- D20: clip timeline family --------------------------------------------------------



def clip_manifest(manifest: DataFrame, strict: bool = False) -> DataFrame:
    """Archive members (member, size) that are webcam clips, parsed to
    (pid, log, record, study, aux) with the tidy part path
    `P_dd/RR-study[-aux].mp4` they are extracted to."""
    clips = manifest.where(F.col("member").endswith(".webm"))
    part = padded("P_%02d/%02d-%s", "pid", "record", "study")
    return with_clip_name(clips, F.col("member")).select(
        pid_from_name("member", strict).alias("pid"), "_clip.log", "_clip.record", "_clip.study", "_clip.aux",
        "member", "size",
    ).select(
        "*",
        F.concat(part, F.when(F.col("aux").isNotNull(), F.concat(F.lit("-"), F.col("aux").cast("string")))
                 .otherwise(F.lit("")), F.lit(".mp4")).alias("part_path"),
    )


def clip_sort_key() -> list:
    """clips ordered by (log, record, study order, aux or 0)."""
    return [F.col("log"), F.col("record"), study_ord("study"), F.coalesce(F.col("aux"), F.lit(0))]


def fragment_parts(clips: DataFrame) -> DataFrame:
    """Clips recorded in several fragments, as an ordered part list.

    One row per fragment of a (pid, record, study) that has fragments:
    `part` orders the concat (the fragment without a number is part 0),
    `n_parts` is the group size, `merged_path` the joined clip. A relation
    instead of a collected list, so a large group is never one value."""
    key = ["pid", "record", "study"]
    sizes = clips.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_parts"), F.max("aux").alias("_max_aux")
    ).where(F.col("_max_aux").isNotNull())
    out = clips.join(sizes, key, "inner")
    return out.select(
        *key,
        F.coalesce(F.col("aux"), F.lit(0)).alias("part"),
        "member",
        F.concat(padded("P_%02d/%02d-%s", "pid", "record", "study"),
                 F.lit("-"), F.coalesce(F.col("aux"), F.lit(0)).cast("string"), F.lit(".mp4")).alias("part_path"),
        F.concat(padded("P_%02d/%02d-%s", "pid", "record", "study"), F.lit(".mp4")).alias("merged_path"),
        "n_parts",
    )


def clip_timeline(
    starts: DataFrame,
    clips: DataFrame,
    form: DataFrame,
    bucket_us: int = 1_000_000,
) -> DataFrame:
    """Plan of each participant's webcam video from its clips.

    starts: log rows with event `start` (pid, record, study, timestamp);
    clips: part files that exist (pid, record, study, duration us);
    form: (pid, webcam_start). Per participant in start order, with the
    running end at 0: a start without a file is skipped; gap = offset -
    end; a negative gap (overlap) rejects the clip, as does a start without
    an offset; otherwise the clip is accepted, end = offset + duration, and
    a filler of length gap is planned before it when it is not the first
    accepted clip and the gap is at least 30 ms.

    The running end depends on earlier decisions, but not always: a file
    whose offset reaches the largest offset + duration of all earlier files
    is accepted whatever was decided before. Such files start islands; only
    inside an island of several files is there anything to decide, by
    following, from its first file, the next file that starts after the
    accepted one's end. These chains are found by pointer doubling, with as
    many rounds as the longest chain needs (none without overlaps). Each
    round is a table on the shared store: a checkpoint hands its estimated
    size on, and such products of products of sizes soon take the planner
    longer than the round. Row numbers and
    running sums, maxima and last values are all taken in buckets
    (`ordering`), so no participant is one task's work."""
    ensure_checkpoint_dir(starts.sparkSession)
    pid = ["pid"]
    # numbering and running values read their input twice: cut the lineage
    # first, so that what lies above is computed once
    items = _timeline_items(starts, clips, form).checkpoint()
    it = row_index(
        items, pid, ["offset", "record", "ord", "study", "duration"],
        bucket=F.floor(F.col("offset") / bucket_us).cast("bigint"), name="i")
    # a file with an offset below 0, the first end, is never accepted
    file = F.col("duration").isNotNull() & F.coalesce(F.col("offset") >= 0, F.lit(False))
    it = it.withColumn("_f", file.cast("int")).withColumn(
        "_b", F.when(file, F.col("offset") + F.col("duration")))
    it = prefixes(it, pid, "i", {"_reach": ("max", "_b"), "p": ("sum", "_f")}).checkpoint()
    sure = (F.col("_f") == 1) & (F.col("offset") >= F.coalesce("_reach", F.lit(0)))
    it = it.withColumn("_sure", sure.cast("int"))
    it = prefix_sum(it, pid, "i", "_sure", "_isl")
    it = it.withColumn("_isl", F.col("_isl") + F.col("_sure")).checkpoint()
    files = it.where(F.col("_f") == 1).select("pid", "_isl", "p", "_sure", F.col("offset").alias("a"), F.col("_b").alias("b"))
    accepted = files.where(F.col("_sure") == 1).select("pid", "p")
    sizes = files.groupBy("pid", "_isl").agg(F.count(F.lit(1)).alias("m"), F.min("p").alias("p0")).where("m > 1")
    longest = sizes.agg(F.max("m")).first()[0]
    if longest:
        accepted = accepted.unionByName(_chains(files.join(sizes, ["pid", "_isl"]), int(longest), bucket_us))
    rows = it.join(accepted.withColumn("_acc", F.lit(True)), ["pid", "p"], "left").withColumn(
        "_acc", F.coalesce(F.col("_acc") & (F.col("_f") == 1), F.lit(False)))
    rows = rows.withColumns({"_b_acc": F.when(F.col("_acc"), F.col("_b")), "_acc_i": F.col("_acc").cast("int")})
    rows = prefixes(rows, pid, "i", {"_end_before": ("last", "_b_acc"), "_n_before": ("sum", "_acc_i")})
    end_before = F.coalesce(F.col("_end_before"), F.lit(0).cast("bigint"))
    has = F.col("duration").isNotNull()
    gap = F.col("offset") - end_before
    return rows.select(
        "pid", "record", "study", "offset", "duration",
        has.alias("has_file"),
        F.col("_acc").alias("accepted"),
        F.when(has, gap).alias("gap"),
        F.when(F.col("_acc") & (F.col("_n_before") > 0) & (gap >= MIN_FILLER_GAP_US), gap).alias("filler"),
        F.when(F.col("_acc"), F.col("_b")).otherwise(end_before).alias("end"),
    )


def _chains(files: DataFrame, longest: int, bucket_us: int) -> DataFrame:
    """Accepted files (pid, p) after the first of each island.

    files: (pid, _isl, p, a, b; m files from ordinal p0 on) of islands of
    several files, a = offset, b = offset + duration. After j the next
    accepted is the first file of the island that starts at b_j or later:
    max(j + 1, p0 + number of its files with a < b_j), found from one sorted
    stream of a's and b's."""
    key = ["pid", "_isl"]
    ev = files.select(*key, F.col("a").alias("v"), F.lit(1).alias("t"), "p", "p0", "m").unionByName(
        files.select(*key, F.col("b").alias("v"), F.lit(0).alias("t"), "p", "p0", "m"))
    ev = row_index(ev, key, ["v", "t", "p"], bucket=F.floor(F.col("v") / bucket_us).cast("bigint"), name="k")
    ev = prefix_sum(ev, key, "k", "t", "_lower")
    to = F.greatest(F.col("p") + 1, F.col("p0") + F.col("_lower"))
    jumps = staged(ev.where(F.col("t") == 0).where(to < F.col("p0") + F.col("m")).select("pid", "p", to.alias("nxt")), "jumps")
    # a chain's first 2^k files (`found`), each moved on by 2^k steps
    # (`jumps`), are its next 2^k: no file is found twice
    firsts = files.where(F.col("p") == F.col("p0")).select("pid", "p")
    found, after = firsts, None
    for _ in range(longest.bit_length()):
        new = staged(found.join(jumps, ["pid", "p"]).select("pid", F.col("nxt").alias("p")), "hits")
        if new.isEmpty():
            break  # every chain is at its end
        after = new if after is None else after.unionByName(new)
        found = firsts.unionByName(after)
        ahead = jumps.select("pid", F.col("p").alias("nxt"), F.col("nxt").alias("_far"))
        jumps = staged(jumps.join(ahead, ["pid", "nxt"]).select("pid", "p", F.col("_far").alias("nxt")), "jumps")
    return firsts.limit(0) if after is None else after


def _timeline_items(starts: DataFrame, clips: DataFrame, form: DataFrame) -> DataFrame:
    s = starts.join(form.select("pid", "webcam_start"), "pid", "inner")
    s = s.join(clips.select("pid", "record", "study", F.col("duration").alias("_dur")),
               ["pid", "record", "study"], "left")
    return s.select(
        "pid",
        diff_us("timestamp", "webcam_start").alias("offset"),
        F.col("record").cast("int").alias("record"),
        F.coalesce(study_ord("study"), F.lit(-1)).alias("ord"),
        F.col("study").alias("study"),
        F.col("_dur").alias("duration"),
    )


def frame_index(frames: DataFrame, form: DataFrame, screen: bool | DataFrame = True) -> DataFrame:
    """D20d: every video frame on every clock. `screen`: as in
    `with_timelines`, who has a screen video (True: everyone with a screen
    start; False: nobody; a DataFrame: the pids in it).

    frames: (pid, video 'webcam' | 'screen', frame us since the video
    start). wall = start + frame; rec = delay + frame; own clock = frame;
    the other video's clock = frame + (webcam_start - screen_start) for the
    webcam, frame - that for the screen, null without a screen video.
    Screen frames of participants without a screen start are dropped."""
    side = form.select("pid", "init_start", "webcam_start", "screen_start")
    if isinstance(screen, DataFrame):
        flags = screen.select("pid").distinct().withColumn("_has_screen", F.lit(True))
        side = side.join(flags, "pid", "left").withColumn(
            "screen_start", F.when(F.col("_has_screen"), F.col("screen_start"))).drop("_has_screen")
    elif not screen:
        side = side.withColumn("screen_start", F.lit(None).cast("timestamp_ntz"))
    f = frames.join(side, "pid", "inner")
    is_cam = F.col("video") == "webcam"
    start = F.when(is_cam, F.col("webcam_start")).otherwise(F.col("screen_start"))
    video_delay = diff_us("webcam_start", "screen_start")
    f = f.where(is_cam | F.col("screen_start").isNotNull())
    return f.select(
        "pid", "video", F.col("frame").alias("frame"),
        add_us(start, "frame").alias("log_time"),
        (diff_us(start, "init_start") + F.col("frame")).alias("rec_time"),
        F.col("frame").alias("own_time"),
        F.when(is_cam, F.col("frame") + video_delay).otherwise(F.col("frame") - video_delay).alias(
            "other_time"
        ),
    )
