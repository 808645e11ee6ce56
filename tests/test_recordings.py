import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from glint.functions import micros
from glint.operators.recordings import (
    clip_manifest, clip_timeline, fragment_parts, frame_index, recording_durations,
)

T0 = dt.datetime(2024, 1, 1)


def ts(sec):
    return T0 + dt.timedelta(seconds=sec)


def log_df(spark, data):
    return spark.createDataFrame(
        [(p, r, s, e, ts(t)) for p, r, s, e, t in data],
        "pid int, record int, study string, event string, timestamp timestamp_ntz")


def test_recording_durations(spark):
    lg = log_df(spark, [
        (1, 2, "dot_test", "start", 10), (1, 2, "dot_test", "stop", 15),          # start with stop
        (1, 3, "fitts_law", "start", 20), (1, 4, "serp_instructions", "start", 31),  # next start
        (1, 5, "tooth_abscess", "start", 40),
        (1, 0, "dot_test_instructions", "start", 1), (1, 1, "dot_test", "start", 2),  # records 0/1
        (1, 6, "dot_test_final", "start", 50), (1, 6, "x", "stop", 52), (1, 6, "x", "stop", 55),
        (1, 7, "thank_you", "start", 60), (1, 7, "thank_you", "stop", 61),         # excluded
        (2, 2, "dot_test", "start", 5),  # neither a stop nor a next start
    ])
    got = rows(recording_durations(lg), "pid", "record", "study", "duration")
    assert got == [
        (1, 0, "dot_test_instructions", None), (1, 1, "dot_test", None), (1, 2, "dot_test", 5_000_000),
        (1, 3, "fitts_law", 11_000_000), (1, 4, "serp_instructions", 9_000_000),
        (1, 5, "tooth_abscess", 10_000_000),
        (1, 6, "dot_test_final", 2_000_000), (1, 6, "dot_test_final", 5_000_000), (2, 2, "dot_test", None),
    ]
    assert recording_durations(lg, dedupe=True).count() == len(got) - 1


def fold(items):
    """Plain loop: the reference's per-participant gap plan."""
    end, n, out = 0, 0, []
    for off, dur in items:
        if dur is None:
            out.append((off, dur, False, None, None, end))
            continue
        gap = off - end
        if gap < 0:
            out.append((off, dur, False, gap, None, end))
            continue
        filler = gap if n > 0 and gap >= 30_000 else None
        end = off + dur
        n += 1
        out.append((off, dur, True, gap, filler, end))
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 200), st.one_of(st.none(), st.integers(0, 120))),
                min_size=1, max_size=12))
def test_clip_timeline_matches_loop(spark, clips):
    # offsets in ms (strictly increasing), durations in ms; None = no file
    offs, t = [], 0
    for step, _ in clips:
        t += step + 1
        offs.append(t)
    items = [(o * 1000, None if d is None else d * 1000) for o, (_, d) in zip(offs, clips)]
    starts = spark.createDataFrame(
        [(1, i + 1, "dot_test", T0 + dt.timedelta(microseconds=o)) for i, (o, _) in enumerate(items)],
        "pid int, record int, study string, timestamp timestamp_ntz")
    files = spark.createDataFrame(
        [(1, i + 1, "dot_test", d) for i, (_, d) in enumerate(items) if d is not None],
        "pid int, record int, study string, duration bigint")
    form = spark.createDataFrame([(1, T0 + dt.timedelta(microseconds=items[0][0]))],
                                 "pid int, webcam_start timestamp_ntz")
    got = rows(clip_timeline(starts, files, form), "offset", "duration", "accepted", "gap", "filler", "end")
    base = items[0][0]
    want = fold([(o - base, d) for o, d in items])
    assert got == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_gap_thresholds(spark):
    # first clip late, then gaps of 29, 30 and 31 ms, an overlap and a missing file
    plan = [(5, 100), (105 + 29, 100), (234 + 30, 100), (364 + 31, 100), (450, 50), (900, None)]
    starts = spark.createDataFrame(
        [(1, i, "dot_test", T0 + dt.timedelta(milliseconds=o)) for i, (o, _) in enumerate(plan)],
        "pid int, record int, study string, timestamp timestamp_ntz")
    files = spark.createDataFrame([(1, i, "dot_test", d * 1000) for i, (_, d) in enumerate(plan) if d],
                                  "pid int, record int, study string, duration bigint")
    form = spark.createDataFrame([(1, T0)], "pid int, webcam_start timestamp_ntz")
    got = rows(clip_timeline(starts, files, form), "record", "accepted", "filler")
    assert got == [(0, True, None), (1, True, None), (2, True, 30000), (3, True, 31000),
                   (4, False, None), (5, False, None)]


def test_manifest_and_fragments(spark):
    man = spark.createDataFrame([
        ("z/P_01/1491423217564_2_-study-dot_test.webm", 10),
        ("z/P_01/1491423217564_3_-study-fitts_law.webm", 11),
        ("z/P_01/1491423217564_3_-study-fitts_law (1).webm", 12),
        ("z/P_01/1491423217564_3_-study-fitts_law (2).webm", 13),
        ("z/P_01/participant.json", 5),
    ], "member string, size bigint")
    m = clip_manifest(man)
    assert rows(m, "pid", "record", "study", "aux", "part_path") == [
        (1, 2, "dot_test", None, "P_01/02-dot_test.mp4"),
        (1, 3, "fitts_law", 1, "P_01/03-fitts_law-1.mp4"),
        (1, 3, "fitts_law", 2, "P_01/03-fitts_law-2.mp4"),
        (1, 3, "fitts_law", None, "P_01/03-fitts_law.mp4"),
    ]
    f = fragment_parts(m)
    assert rows(f, "part", "part_path", "merged_path", "n_parts") == [
        (0, "P_01/03-fitts_law-0.mp4", "P_01/03-fitts_law.mp4", 3),
        (1, "P_01/03-fitts_law-1.mp4", "P_01/03-fitts_law.mp4", 3),
        (2, "P_01/03-fitts_law-2.mp4", "P_01/03-fitts_law.mp4", 3),
    ]


def test_frame_index(spark):
    form = spark.createDataFrame(
        [(1, ts(0), ts(10), ts(4)), (2, ts(0), ts(3), None)],
        "pid int, init_start timestamp_ntz, webcam_start timestamp_ntz, screen_start timestamp_ntz")
    frames = spark.createDataFrame([(1, "webcam", 500), (1, "screen", 500), (2, "webcam", 7), (2, "screen", 7)],
                                   "pid int, video string, frame bigint")
    got = rows(frame_index(frames, form).select(
        "pid", "video", micros("log_time").alias("w"), "rec_time", "own_time", "other_time"))
    base = micros(F.lit(T0))  # noqa: F841
    t0 = int((T0 - dt.datetime(1970, 1, 1)).total_seconds() * 1e6)
    assert got == [
        (1, "screen", t0 + 4_000_500, 4_000_500, 500, 500 - 6_000_000),
        (1, "webcam", t0 + 10_000_500, 10_000_500, 500, 500 + 6_000_000),
        (2, "webcam", t0 + 3_000_007, 3_000_007, 7, None),
    ]



def plain_loop(clips):
    """(offset, duration) in start order -> (accepted, gap, filler, end)."""
    end, n, out = 0, 0, []
    for off, dur in clips:
        has = dur is not None
        gap = off - end if has and off is not None else None
        ok = gap is not None and gap >= 0
        filler = gap if ok and n and gap >= 30_000 else None
        if ok:
            end, n = off + dur, n + 1
        out.append((ok, gap, filler, end))
    return out


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.one_of(st.none(), st.integers(-5, 200)), st.booleans()),
                min_size=1, max_size=30))
def test_timeline_equals_the_plain_loop(spark, clips):
    """Overlaps, ties, starts without a file or an offset, negative durations."""
    rows_, t = [], -20
    for i, (step, dur, gone) in enumerate(clips):
        t += step
        rows_.append((i, None if gone and i % 3 == 0 else t * 1000, None if dur is None else dur * 1000))
    starts = spark.createDataFrame(
        [(1, i, "dot_test", None if o is None else T0 + dt.timedelta(milliseconds=100, microseconds=o)) for i, o, _ in rows_],
        "pid int, record int, study string, timestamp timestamp_ntz")
    files = spark.createDataFrame(
        [(1, i, "dot_test", d) for i, _, d in rows_ if d is not None] or [(9, 9, "x", 0)],
        "pid int, record int, study string, duration bigint")
    form = spark.createDataFrame([(1, T0 + dt.timedelta(milliseconds=100))], "pid int, webcam_start timestamp_ntz")
    order = sorted(rows_, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))  # no offset: first, nothing decided
    want = {r[0]: w for r, w in zip(order, plain_loop([(o, d) for _, o, d in order]))}
    got = clip_timeline(starts, files, form, bucket_us=7_000)
    assert {r.record: (r.accepted, r.gap, r.filler, r.end) for r in got.collect()} == want


def test_durations_keep_all_stops_and_next_starts(spark):
    log = spark.createDataFrame(
        [(1, 1, "start", ts(0)), (1, 1, "stop", ts(5)), (1, 1, "stop", ts(7)), (1, 2, "start", ts(10)), (1, 3, "start", ts(20)),
         (1, 3, "start", ts(22))], "pid int, record int, event string, timestamp timestamp_ntz").withColumn("study", F.lit("dot_test"))
    got = rows(recording_durations(log), "record", "duration")
    assert got == [(1, 5_000_000), (1, 7_000_000), (2, 10_000_000), (2, 12_000_000), (3, None), (3, None)]
    assert rows(recording_durations(log, dedupe=True), "record", "duration") == [(1, 7_000_000), (2, 10_000_000), (3, None), (3, None)]


def test_long_chains_keep_the_plan_small(spark):
    """One island of 600 files, each overlapping the next; the size that the
    planner expects must not grow from round to round of the doubling."""
    plan = [(i * 60_000, 100_000) for i in range(600)]
    starts = spark.createDataFrame(
        [(1, i, "dot_test", T0 + dt.timedelta(milliseconds=o)) for i, (o, _) in enumerate(plan)],
        "pid int, record int, study string, timestamp timestamp_ntz")
    files = spark.createDataFrame([(1, i, "dot_test", d * 1000) for i, (_, d) in enumerate(plan)],
                                  "pid int, record int, study string, duration bigint")
    form = spark.createDataFrame([(1, T0)], "pid int, webcam_start timestamp_ntz")
    out = clip_timeline(starts, files, form)
    assert len(str(out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 3_000  # digits
    want = fold([(o * 1000, d * 1000) for o, d in plan])
    assert rows(out, "offset", "duration", "accepted", "gap", "filler", "end") == sorted(
        want, key=lambda t: tuple((x is None, str(x)) for x in t))
    assert out.where("accepted").count() == 300
