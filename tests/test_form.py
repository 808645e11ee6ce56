import datetime as dt

import pytest

from conftest import rows, write
from glint.operators.form import (
    build_form, check_domains, clean_form, domain_violations, form_delays, parse_specs,
    screen_adjustments, spec_lines,
)
from glint.sources import read_form_csv, read_spec_text

HEADER = ("Participant ID,Participant Log ID,Date,Setting,Display Width (pixels),Display Height (pixels),"
          "Screen Width (cm),Screen Height (cm),Distance From Screen (cm),"
          "Screen Recording Start Time (Unix milliseconds),Screen Recording Start Time (Wall Clock),Gender,Age,"
          "Self-Reported Race,Self-Reported Skin Color,Self-Reported Eye Color,Facial Hair,"
          "Self-Reported Vision,Touch Typer,Self-Reported Handedness,Weather,Pointing Device,Notes,"
          "Time of day,Duration")
ROWS = [
    'P_01,1491423217564,04/05/2017,Laptop,1440,900,28.6,18,50,-,-,Male,25,White,2,Amber,None,Normal,Yes,'
    'Right,Indoors,Trackpad,"quiet, room",16:13,0:28:51',
    'P_06,1491500000000,04/06/2017,PC,1920,1080,51,29,60,1491500001000,04/06/2017 17:40,Female,130,Asian,'
    '4,Dark Brown to Brown,Little,Glasses,No,Left,Sunny,Mouse,"",17:40,1:02:03',
]


@pytest.fixture()
def form_csv(tmp):
    return write(tmp, "participant_characteristics.csv", "\n".join([HEADER, *ROWS]) + "\n")


def test_clean_form(spark, form_csv):
    f = clean_form(read_form_csv(spark, form_csv))
    r = {x["pid"]: x for x in f.collect()}
    assert set(r) == {1, 6}
    assert r[1]["screen_start"] is None and r[1]["wall_clock"] is None
    assert r[1]["notes"] == "quiet, room"
    assert r[6]["notes"] is None
    assert r[6]["age"] == 130
    assert r[1]["touch_typer"] is True and r[6]["touch_typer"] is False
    assert r[1]["init_start"] == dt.datetime(2017, 4, 5, 20, 13, 37, 564000)
    assert r[6]["wall_clock"] == dt.datetime(2017, 4, 6, 17, 40)
    assert r[1]["display_resolution"].asDict() == {"w": 1440, "h": 900}
    assert r[1]["screen_size"].asDict() == {"w": 28.6, "h": 18.0}


def test_clean_form_strict_enum(spark, tmp):
    bad = ROWS[0].replace("Amber", "Violet")
    path = write(tmp, "form.csv", "\n".join([HEADER, bad]) + "\n")
    with pytest.raises(Exception, match="value outside eye_color"):
        clean_form(read_form_csv(spark, path)).collect()
    assert clean_form(read_form_csv(spark, path), strict=False).first()["eye_color"] is None
    bad_date = ROWS[0].replace("04/05/2017", "2017-04-05")
    path2 = write(tmp, "form2.csv", "\n".join([HEADER, bad_date]) + "\n")
    with pytest.raises(Exception, match="bad date or duration"):
        clean_form(read_form_csv(spark, path2)).collect()


SPEC = """Back Lower Left: (-250.0, -175.0, 850.0)
Back Lower Right: (250.0, -175.0, 850.0)
Back Upper Left: (-250.0, 175.0, 850.0)
Back Upper Right: (250.0, 175.0, 850.0)
Front Lower Left: (-250.0, -175.0, 450.0)
Front Lower Right: (250.0, -175.0, 450.0)
Front Upper Left: (-250.0, 175.0, 450.0)
Front Upper Right: (250.0, 175.0, 450.0)
Serial number: TX300
Illumination mode: Default
Initial gaze output frequency: 60.0
"""


def test_parse_specs(spark, tmp):
    write(tmp, "P_01/P_01_specs.txt", SPEC)
    write(tmp, "P_06/P_06_specs.txt", "\n".join(l for l in SPEC.splitlines()
                                               if not l.startswith(("Front Upper Right", "Initial"))))
    s = parse_specs(spec_lines(read_spec_text(spark, f"{tmp}/P_*/*specs.txt")))
    r = {x["pid"]: x for x in s.collect()}
    assert r[1]["frequency"] == 60.0 and r[1]["illumination_mode"] == "Default"
    assert r[1]["tracking_box"]["b_lo_l"] == [-250.0, -175.0, 850.0]
    assert r[6]["frequency"] is None and r[6]["tracking_box"]["f_up_r"] is None


def test_build_form(spark, form_csv):
    form = clean_form(read_form_csv(spark, form_csv))
    lg = spark.createDataFrame([
        (1, "start", dt.datetime(2017, 4, 5, 20, 14)), (1, "start", dt.datetime(2017, 4, 5, 20, 20)),
        (6, "stop", dt.datetime(2017, 4, 6, 17, 41)), (6, "start", dt.datetime(2017, 4, 6, 17, 41, 5)),
    ], "pid int, event string, timestamp timestamp_ntz")
    b = build_form(form, lg)
    r = {x["pid"]: x for x in b.collect()}
    assert r[1]["webcam_start"] == dt.datetime(2017, 4, 5, 20, 14)
    # P_01: "11s 733ms" - 407 ms before the webcam start
    assert r[1]["screen_start"] == dt.datetime(2017, 4, 5, 20, 14) - dt.timedelta(milliseconds=11733 - 407)
    # P_06: "36s 828ms" - (-378 ms)
    assert r[6]["screen_start"] == dt.datetime(2017, 4, 6, 17, 41, 5) - dt.timedelta(milliseconds=36828 + 378)
    assert r[1]["screen_viewport_y"] == 97 and r[6]["screen_viewport_y"] == 66
    nosync = {x["pid"]: x for x in build_form(form, lg, sync=False).collect()}
    assert nosync[1]["screen_start"] is None
    d = {x["pid"]: x for x in form_delays(b).collect()}
    assert d[1]["webcam_delay"] == int((dt.datetime(2017, 4, 5, 20, 14) - r[1]["init_start"]).total_seconds() * 1e6)


def test_screen_adjustments(spark):
    adj = {r["pid"]: r["start_time"] for r in screen_adjustments(spark).collect()}
    assert len(adj) == 27
    assert adj[10] == (154_029 + 647) * 1000
    assert screen_adjustments(spark, sync=False).count() == 0


def test_domains(spark):
    df = spark.createDataFrame([("Laptop", "Amber", "dot_test"), ("Tablet", "Violet", "x"),
                                ("PC", None, "thank_you")], "setting string, eye_color string, study string")
    v = rows(domain_violations(df), "column_name", "value", "n_rows")
    assert v == [("eye_color", "Violet", 1), ("setting", "Tablet", 1), ("study", "x", 1)]
    with pytest.raises(Exception, match="value outside"):
        check_domains(df).collect()



def test_parse_specs_bad_corner(spark, tmp):
    write(tmp, "P_03/P_03_specs.txt", "Back Lower Left: (-250.0, oops, 850.0)\nIllumination mode: Default\n")
    lines = spec_lines(read_spec_text(spark, f"{tmp}/P_03/*specs.txt"))
    with pytest.raises(Exception, match="bad tracking box line"):
        parse_specs(lines).collect()
    r = parse_specs(lines, strict=False).first()
    assert r["tracking_box"]["b_lo_l"] is None and r["illumination_mode"] == "Default"
