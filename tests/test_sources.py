import json
import os
import zipfile

from pyspark.sql import functions as F

from conftest import rows, write
from glint.operators.frames import shape_tracker_frames
from glint.sources import (
    read_tracker_frames, read_video_manifest, read_zip, video_parts, zip_calibration, zip_dots, zip_form,
    zip_logs, zip_specs, zip_tobii,
)
from test_form import HEADER, ROWS, SPEC
from test_gaze import sample


def make_zip(tmp):
    path = os.path.join(tmp, "dataset.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("ds/participant_characteristics.csv", "\n".join([HEADER, *ROWS]) + "\n")
        z.writestr("ds/P_01/1491423217564.json", json.dumps([
            {"sessionId": "1_2_/study/dot_test", "webpage": "/study/dot_test.htm", "epoch": 5,
             "type": "recording start"}]))
        z.writestr("ds/P_01/P_01.txt", json.dumps(sample(0, 1, 1)) + "\n" + json.dumps(sample(1, 1, 0))[:30])
        z.writestr("ds/P_01/P_01_specs.txt", SPEC)
        z.writestr("ds/P_01/x_final_dot_test_locations.tsv", "Dot_X\tDot_Y\tEpoch\n1\t2\t3.5\n")
        z.writestr("ds/P_01/1491423217564_2_-study-dot_test.webm", b"\x00" * 100)
        z.writestr("ds/P_02/P_02.txt", json.dumps(sample(0, 0, 1)) + "\n")
    return path


def test_zip_source(spark, tmp):
    path = make_zip(tmp)
    listing = read_zip(spark, path)
    assert ("ds/P_01/1491423217564_2_-study-dot_test.webm", 100) in rows(listing)
    assert read_zip(spark, path, "lines", r"\.tsv$").count() == 2
    assert rows(zip_logs(spark, path), "pid", "type") == [(1, "recording start")]
    assert rows(zip_tobii(spark, path), "pid") == [(1,), (2,)]  # cut-off line dropped
    assert zip_specs(spark, path).first()["pid"] == 1
    assert rows(zip_dots(spark, path), "pid", "Dot_X", "Epoch") == [(1, 1, 3.5)]
    assert zip_calibration(spark, path, r"none\.tsv$").count() == 0
    f = zip_form(spark, path)
    assert rows(f, "Participant ID", "Notes") == [("P_01", "quiet, room"), ("P_06", None)]


def test_tracker_frames_file_order(spark, tmp):
    recs = [{"trackTime": float(i), "trackEvent": 1, "frameOffset": [i, -i], "faceShape": [[0.0, 1.0]] * (i % 3),
             "eyeTarget": {"left": [0.1, 0.2, 0.3], "right": None}} for i in range(3000)]
    write(tmp, "P10_R3_A0.jsonl", "\n".join(json.dumps(r) for r in recs) + "\n")
    write(tmp, "P10_R4_A1.jsonl", "\n".join(json.dumps(r) for r in recs[:5]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = read_tracker_frames(spark, f"{tmp}/*.jsonl")
        assert raw.rdd.getNumPartitions() > 4  # the big file is read in several splits
        fr = shape_tracker_frames(raw, order=["_block", "_row"], bucket=F.col("_block"))
        got = fr.select("pid", "record", "aux", "index", "timestamp", "offset", "eyes").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    big = sorted((r["index"], r["timestamp"]) for r in got if r["record"] == 3)
    assert big == [(i, i * 1000) for i in range(3000)]
    assert {(r["pid"], r["aux"]) for r in got} == {(10, 0), (10, 1)}
    from glint.plans.jobs import tracker_frames
    tracker_frames(spark, f"{tmp}/*.jsonl", f"{tmp}/frames.parquet")
    back = spark.read.parquet(f"{tmp}/frames.parquet")
    assert back.count() == 3005 and back.where("record = 3").agg(F.max("index")).first()[0] == 2999
    r0 = [r for r in got if r["record"] == 3 and r["index"] == 7][0]
    assert r0["offset"].asDict() == {"x": 7, "y": -7}
    assert r0["eyes"]["right"] is None


def test_video_manifest(spark, tmp):
    for rel in ["P_01/02-dot_test.mp4", "P_01/03-fitts_law-1.mp4", "P_01/03-fitts_law-gap.mp4", "P_01/a.txt"]:
        write(tmp, f"webcam/{rel}", "x" * 10)
    m = read_video_manifest(spark, f"{tmp}/webcam")
    assert m.count() == 4
    got = rows(video_parts(m), "pid", "record", "study", "aux", "gap")
    assert got == [(1, 2, "dot_test", None, False), (1, 3, "fitts_law", 1, False)]
    assert video_parts(m, gaps=True).count() == 3


def test_archive_video_lists(spark, tmp):
    from glint.operators.recordings import clip_manifest, clip_sort_key
    from glint.sources import screen_files, webcam_files

    path = os.path.join(tmp, "v.zip")
    with zipfile.ZipFile(path, "w") as z:
        for n in ["ds/P_02/b.mov", "ds/P_01/a.flv", "ds/P_01/1_3_-study-fitts_law.webm",
                  "ds/P_01/1_2_-study-dot_test (1).webm", "ds/P_01/1_2_-study-dot_test.webm"]:
            z.writestr(n, b"x")
    assert [r["member"] for r in screen_files(spark, path).collect()] == ["ds/P_01/a.flv", "ds/P_02/b.mov"]
    clips = clip_manifest(webcam_files(spark, path))
    order = [(r["record"], r["study"], r["aux"]) for r in clips.orderBy(*clip_sort_key()).collect()]
    assert order == [(2, "dot_test", None), (2, "dot_test", 1), (3, "fitts_law", None)]


def test_tolerant_paths_do_not_raise(spark, tmp):
    """Under ANSI casts, the tolerant modes give nulls for bad text."""
    from glint.operators.form import clean_form
    from glint.operators.log import normalize_log, parse_alignment
    from glint.operators.recordings import clip_manifest
    from glint.schemas import ALIGNMENT_CSV_SCHEMA, FORM_CSV_SCHEMA, LOG_JSON_SCHEMA

    man = spark.createDataFrame([("z/P_01/odd name.webm", 1)], "member string, size bigint")
    r = clip_manifest(man).first()
    assert (r["pid"], r["log"], r["record"], r["study"], r["aux"]) == (1, None, None, None, None)
    al = spark.createDataFrame([("P_xx/nope.webm", 0.1, None, None)], ALIGNMENT_CSV_SCHEMA)
    assert parse_alignment(al, strict=False).first()["pid"] is None
    row = {f.name: None for f in LOG_JSON_SCHEMA.fields}
    row.update(sessionId="abc_x_y", webpage="/study/dot_test.htm", epoch=1.0)
    from pyspark.sql.types import IntegerType, StructField, StructType

    schema = StructType(LOG_JSON_SCHEMA.fields + [StructField("pid", IntegerType())])
    lg = spark.createDataFrame([tuple(row[f.name] for f in LOG_JSON_SCHEMA.fields) + (1,)], schema)
    assert normalize_log(lg, strict=False).first()["record"] is None
    vals = {f.name: None for f in FORM_CSV_SCHEMA.fields}
    vals.update({"Participant ID": "P_03", "Screen Recording Start Time (Wall Clock)": "tomorrow",
                 "Time of day": "25:99"})
    fm = spark.createDataFrame([tuple(vals[f.name] for f in FORM_CSV_SCHEMA.fields)], FORM_CSV_SCHEMA)
    got = clean_form(fm, strict=False).first()
    assert (got["pid"], got["wall_clock"], got["time_of_day"], got["time_of_day_min"]) == (3, None, None, None)


def both_layouts(tmp, files):
    """The same files as a folder and as an archive."""
    path = os.path.join(tmp, "d.zip")
    with zipfile.ZipFile(path, "w") as z:
        for name, text in files.items():
            write(tmp, f"EXP_2018/{name}", text)
            z.writestr(f"EXP_2018/{name}", text)
    return f"{tmp}/EXP_2018", path


def test_any_number_of_digits_names_a_participant(spark, tmp):
    """P_101 is read, and a folder such as EXP_2018 above is no participant."""
    from glint.plans.jobs import raw_sources

    root, path = both_layouts(tmp, {
        f"P_{p}/P_{p}.txt": json.dumps(sample(0, 1, 1)) + "\n" for p in ("01", "7", "101")} | {"P_101/P_101_specs.txt": SPEC})
    for where, layout in ((root, "dir"), (path, "zip")):
        assert rows(raw_sources(spark, where, layout)["tobii"](), "pid") == [(1,), (101,), (7,)]


def test_broken_input_is_loud_or_set_aside(spark, tmp):
    import pytest

    from glint.plans.jobs import raw_sources, rejects

    event = {"sessionId": "1_2_/study/dot_test", "webpage": "/study/dot_test.htm", "epoch": 5, "type": "recording start"}
    floats = json.dumps(sample(0, 1, 1)).replace('_validity": 1', '_validity": 1.0')
    root, path = both_layouts(tmp, {
        "P_01/1.json": json.dumps([event, event]), "P_02/2.json": json.dumps([event, event])[:-20],
        "P_01/P_01.txt": floats + "\n" + json.dumps(sample(1, 1, 0)) + "\n" + json.dumps(sample(2, 1, 0))[:40],
        "P_02/P_02.txt": json.dumps(sample(0, 1, 1)) + "\nnoise\n" + json.dumps(sample(1, 1, 0)) + "\n",
    })
    for where, layout in ((root, "dir"), (path, "zip")):
        strict, calm, out = raw_sources(spark, where, layout), raw_sources(spark, where, layout, strict=False), rejects(spark, where, layout)
        for name in ("log", "tobii"):
            with pytest.raises(Exception):
                strict[name]().collect()
        assert rows(calm["log"](), "pid") == [(1,), (1,)]
        assert rows(out["log_rejects"](), "pid") == [(2,)]
        assert rows(calm["tobii"](), "pid") == [(1,), (1,), (2,), (2,)]
        assert sorted(r["value"][:5] for r in out["tobii_rejects"]().collect()) == ["noise", '{"dev']


def test_a_long_form_with_line_breaks_in_notes(spark, tmp):
    from glint.sources import read_form_csv

    head = HEADER.split(",")
    at = head.index("Notes")
    lines = [HEADER]
    for i in range(20_000):
        cells = ["" if c not in ("Participant ID",) else f"P_{i:02d}" for c in head]
        cells[at] = f'"two\nlines ""{i}"", here"' if i % 2 else "-"
        lines.append(",".join(cells))
    root, path = both_layouts(tmp, {"participant_characteristics.csv": "\n".join(lines) + "\n"})
    for form in (read_form_csv(spark, f"{root}/*.csv"), zip_form(spark, path)):
        assert form.count() == 20_000
        assert form.where("`Participant ID` = 'P_777'").first()["Notes"] == 'two\nlines "777", here'
        assert form.where("Notes is null").count() == 10_000


def test_only_the_last_line_of_a_recording_may_be_cut(spark, tmp):
    """Strict: a cut line in mid-file raises, wherever the file is split."""
    import pytest

    from glint.plans.jobs import raw_sources

    line = [json.dumps(sample(i, 1, 1)) for i in range(60)]
    cut_end = "\n".join([*line, line[0][:50]])
    cut_mid = "\n".join([*line[:30], line[0][:50], *line[30:]]) + "\n"
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        for name, text, good in (("end", cut_end, True), ("ended", cut_end + "\n\n", True), ("mid", cut_mid, False),
                                 ("closed", "\n".join([*line, '{"a": }']) + "\n", False)):
            os.makedirs(f"{tmp}/{name}")
            root, path = both_layouts(f"{tmp}/{name}", {"P_01/P_01.txt": text, "P_02/P_02.txt": line[0] + "\n"})
            for where, layout in ((root, "dir"), (path, "zip")):
                read = raw_sources(spark, where, layout)["tobii"]
                if good:
                    assert read().count() == 61
                else:
                    with pytest.raises(Exception, match="no eye-tracker sample"):
                        read().collect()
                assert raw_sources(spark, where, layout, strict=False)["tobii"]().count() == 61
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_bad_event_goes_alone(spark, tmp):
    import pytest

    from glint.plans.jobs import raw_sources, rejects

    ok = {"sessionId": "1_2_/study/dot_test", "webpage": "/study/dot_test.htm", "epoch": 5.5, "type": "recording start",
          "pos": {"top": 1, "left": 2.25}}
    root, path = both_layouts(tmp, {
        "P_01/1.json": json.dumps([ok, ok | {"epoch": "abc"}, ok, 7, None]), "P_02/2.json": "[]", "P_03/3.json": "{}",
        "P_04/4.json": "", "P_05/5.json": json.dumps([ok | {"unknown": [1, {"a": 2}], "text": "a, \"]\" ü"}])})
    for where, layout in ((root, "dir"), (path, "zip")):
        calm = raw_sources(spark, where, layout, strict=False)["log"]()
        assert rows(calm, "pid", "epoch") == [(1, 5.5), (1, 5.5), (5, 5.5)]
        assert calm.where("pid = 5").first()["text"] == 'a, "]" ü' and calm.first()["pos"]["left"] == 2.25
        bad = rejects(spark, where, layout)["log_rejects"]()
        empty = [(4, None)] if layout == "zip" else []  # Spark skips files of no bytes
        assert rows(bad, "pid", "position") == [(1, 1), (1, 3), (1, 4), (3, None), *empty]
        assert '"abc"' in bad.where("position = 1").first()["value"]
        with pytest.raises(Exception, match="not a log event|no JSON array"):
            raw_sources(spark, where, layout)["log"]().collect()


def test_folder_and_archive_agree(spark, tmp):
    """One parser for both layouts, odd fields included."""
    from glint.plans.jobs import raw_sources
    from glint.schemas import ALIGNMENT_CSV_SCHEMA
    from glint.sources import read_alignment_csv
    from glint.sources.parse import parse_delimited

    calib = ("point_x\tpoint_y\tprediction_x_left\tprediction_y_left\tvalidity_left\tprediction_x_right\t"
             "prediction_y_right\tvalidity_right\n0.1\tNaN\tx\t\t1\t0.1\t1e3\t1.0\n0.1\t0.2\n")
    later = [r.replace("P_01", "P_77") for r in ROWS]
    root, path = both_layouts(tmp, {
        "participant_characteristics.csv": "\n".join([HEADER, *ROWS]) + "\n",
        "z_participant_characteristics.csv": "\n".join([HEADER, *later]) + "\n",
        "P_01/x_final_dot_test_locations.tsv": "Dot_X\tDot_Y\tEpoch\n1\tn/a\t1.5\n2.0\t-\t\n\"3\"\t4\tNaN\textra\n",
        "P_01/calibration.tsv": calib})
    a, b = raw_sources(spark, root), raw_sources(spark, path, "zip")
    for name in ("form", "dot", "calib"):
        x, y = a[name](), b[name]()
        assert rows(x, *y.columns).__repr__() == rows(y).__repr__() and set(x.columns) == set(y.columns)
    assert rows(a["form"](), "Participant ID") == [("P_01",), ("P_06",)]  # the first file only
    assert [r["Dot_X"] for r in a["dot"]().orderBy("Dot_X").collect()] == [None, 1, 3]
    text = "P_01/1_2_-study-dot_test.webm,0.5,-,\nP_02/x.webm,-,1,2\n"
    write(tmp, "al.csv", "video,frameshift,corrOptimal,corrOrig\n" + text)
    lines = spark.createDataFrame([(t,) for t in text.splitlines()], "value string")
    both = [rows(t) for t in (read_alignment_csv(spark, f"{tmp}/al.csv"), parse_delimited(lines, ALIGNMENT_CSV_SCHEMA, ",", "-", True))]
    assert both[0] == both[1]


def test_the_members_of_participants(spark, tmp):
    """Members of other participants are not planned, and a DataFrame gives
    the same rows whatever was asked of it before."""
    files = {f"P_{p:02d}/{i}.json": json.dumps([{"sessionId": f"{i}_1_/x", "epoch": p}]) for p in range(1, 9) for i in range(3)}
    root, path = both_layouts(tmp, files)
    every = zip_logs(spark, path)
    assert every.rdd.getNumPartitions() == 24 and every.where("pid = 3").count() == 3 and every.count() == 24
    one = zip_logs(spark, path, pids=[5])
    assert one.rdd.getNumPartitions() == 3 and rows(one, "epoch") == [(5.0,)] * 3
    assert read_zip(spark, path, "text", pids=[2, 7]).rdd.getNumPartitions() == 6
    assert read_zip(spark, path, "text", pids=[]).count() == 0


def test_one_member_is_many_tasks(spark, tmp):
    """Lines of a stored and of a deflated member, cut anywhere, once each."""
    import random

    from glint.plans.jobs import etl, gaze_lines, load_table
    from glint.sources import index_zip

    r = random.Random(7)
    texts = {
        "P_01/P_01.txt": "\n".join(json.dumps(sample(i, 1, 1) | {"true_time": r.random(), "note": r.randbytes(40).hex()}) for i in range(4_000)) + "\n",
        "P_02/P_02.txt": "\r\n".join(f"ü{i} " + r.randbytes(r.randrange(60)).hex() for i in range(20_000)) + "\n\n" + "y" * 300_000 + "\nend",
        "P_03/P_03.txt": "", "P_04/P_04.txt": "one"}
    for kind in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        path, index = os.path.join(tmp, f"{kind}.zip"), os.path.join(tmp, f"{kind}.index")
        with zipfile.ZipFile(path, "w", kind) as z:
            for name, text in texts.items():
                z.writestr(name, text)
        index_zip(spark, path, index, every=100_000)
        lines = read_zip(spark, path, "lines", index=index, piece=100_000)
        for p in (1, 2):
            assert read_zip(spark, path, "lines", index=index, piece=100_000, pids=[p]).rdd.getNumPartitions() > 3
        got = lines.orderBy("member", "block", "row").collect()
        for name, text in texts.items():
            want = [x.rstrip("\r") for x in text.split("\n")]
            assert [x["value"] for x in got if x["member"] == name] == (want[:-1] if text[-1:] in ("", "\n") else want)
    deflated = os.path.join(tmp, f"{zipfile.ZIP_DEFLATED}.zip")
    assert gaze_lines(spark, deflated, "zip", index).where("pid = 1").count() == 4_000
    with zipfile.ZipFile(f"{tmp}/one.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("P_01/P_01.txt", texts["P_01/P_01.txt"][:-40])
    index_zip(spark, f"{tmp}/one.zip", f"{tmp}/one.index", every=100_000)
    made = etl(spark, f"{tmp}/one.zip", f"{tmp}/tidy", process=["tobii"], layout="zip", index=f"{tmp}/one.index")
    assert made.counts["tobii"] == {"rows": 3_999, "rejects": 1} and load_table(spark, f"{tmp}/tidy", "tobii").count() == 3_999


def test_an_index_of_another_archive_is_refused(spark, tmp):
    import pytest

    from glint.sources import index_zip

    for name, word in (("a", "left"), ("b", "rite")):
        with zipfile.ZipFile(f"{tmp}/{name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("P_01/P_01.txt", "\n".join(f"{word} {i * 7919 % 10_007}" for i in range(60_000)))
    index_zip(spark, f"{tmp}/a.zip", f"{tmp}/index", every=100_000)
    with pytest.raises(Exception, match="fit the archive|Error"):
        read_zip(spark, f"{tmp}/b.zip", "lines", index=f"{tmp}/index").count()


def test_delimited_lines_are_parsed_once(spark):
    """Filters on the fields read the parsed line, they don't parse it again."""
    from glint.operators.gaze import shape_calibration
    from glint.schemas import CALIB_TSV_SCHEMA
    from glint.sources.parse import parse_delimited

    text = ["0.1\t0.2\t0.3\t0.4\t1\tNaN\t0.6\t0", "0.1\t0.2\t\t0.4\t1\t0.5\t0.6\t0", "0.1\tx\t0.3\t0.4\t1\t0.5\t0.6\t0"]
    lines = spark.createDataFrame([(1, t) for t in text], "pid int, value string")
    out = shape_calibration(parse_delimited(lines, CALIB_TSV_SCHEMA))
    assert [r["left"]["x"] for r in out.collect()] == [0.3]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1
