import json

import pytest
from pyspark.sql import functions as F

from conftest import rows, write
from glint.functions import micros
from glint.operators.log import align_log, normalize_log, parse_alignment
from glint.sources import read_alignment_csv, read_log_json

S = "1491423217564_2_/study/dot_test"
LOG = [
    {"sessionId": S, "webpage": "/study/dot_test.htm", "epoch": 1491423217564, "time": 0.0,
     "type": "recording start", "isTrusted": True},
    {"sessionId": S, "webpage": "/study/dot_test.htm", "epoch": 1491423219001, "time": 1437.9,
     "type": "mouseclick", "screenX": -3, "screenY": 40.0, "isTrusted": True},
    {"sessionId": S, "webpage": "/study/dot_test.htm", "epoch": 1491423218000.0, "type": "mousemove",
     "screenX": 5, "screenY": 6},
    {"sessionId": S, "webpage": "/study/dot_test.htm", "epoch": 1491423220000, "event": "video saved"},
    {"sessionId": S, "webpage": "/study/dot_test.htm", "epoch": 1491423220001, "event": "video started"},
    {"sessionId": S, "webpage": "/study/dot_test.htm", "epoch": 1491423220002, "type": "scrollEvent",
     "scrollX": 0, "scrollY": 120},
    {"sessionId": S, "webpage": "/study/dot_test.htm", "epoch": 1491423220003, "type": "textInput",
     "pos": {"top": 10, "left": 20}},
    {"sessionId": S, "webpage": "/study/dot_test.htm", "epoch": 1491423220004, "type": "text_input",
     "text": "hello"},
    {"sessionId": S, "webpage": "/study/dot_test.htm", "epoch": 1491423220005, "type": "response"},
    {"sessionId": S, "webpage": "/study/dot_test.htm", "epoch": 1491423220006},
    {"sessionId": S, "webpage": "/study/dot_test.htm", "epoch": 1491423229000, "type": "recording stop"},
    {"sessionId": "1491423217564_3_/study/thankyou", "webpage": "/study/thankyou.htm",
     "epoch": 1491423230000, "type": "recording start"},
]


@pytest.fixture()
def log_dir(tmp):
    write(tmp, "P_01/1491423217564.json", json.dumps(LOG))
    write(tmp, "P_02/1491423217999.json", json.dumps(LOG[:2]))
    return tmp


def test_normalize_log(spark, log_dir):
    raw = read_log_json(spark, f"{log_dir}/P_*/*.json")
    lg = normalize_log(raw)
    got = rows(lg.where("pid = 1").select(
        "record", micros("timestamp").alias("t"), "study", "event", "source", F.col("mouse.x").alias("mx"),
        F.col("caret.top").alias("top"), "text", "duration"))
    by_t = {r[1]: r for r in got}
    assert by_t[1491423217564000][2:5] == ("dot_test", "start", "log")
    assert by_t[1491423219001000][2:6] == ("dot_test", "click", "mouse", -3)
    assert by_t[1491423219001000][8] == 1_437_000  # time cut to whole ms
    assert by_t[1491423218000000][3:5] == ("move", "mouse")  # 1.0-style integer epoch
    assert by_t[1491423220000000][3:5] == ("save", "log")
    assert by_t[1491423220001000][3:5] == (None, "log")  # video started: no event
    assert by_t[1491423220002000][3:5] == ("scroll", "scroll")
    assert by_t[1491423220003000][3:7] == ("input", "input", None, 10)
    assert by_t[1491423220004000][3:5] == ("text", "text")
    assert by_t[1491423220005000][3:5] == ("response", "log")  # unknown type passes through
    assert by_t[1491423220006000][3:5] == (None, "log")
    assert by_t[1491423230000000][0] == 3 and by_t[1491423230000000][2] == "thank_you"
    assert lg.where("pid = 2").count() == 2


def test_unknown_page_strict(spark, tmp):
    write(tmp, "P_03/x.json", json.dumps([{"sessionId": "1_1_/x", "webpage": "/study/nope.htm",
                                          "epoch": 1, "type": "recording start"}]))
    raw = read_log_json(spark, f"{tmp}/P_*/*.json")
    with pytest.raises(Exception, match="value outside study"):
        normalize_log(raw).collect()
    assert normalize_log(raw, strict=False).first()["study"] is None


def test_alignment(spark, tmp, log_dir):
    write(tmp, "align.csv",
          "video,frameshift,corrOptimal,corrOrig\n"
          "P_01/1491423217564_2_-study-dot_test.webm,0.12,0.9,0.7\n"
          "P_01/1491423217564_2_-study-dot_test (1).webm,0.5,0.9,0.7\n"
          "P_01/1491423217564_3_-study-fitts_law (1).webm,-,,\n"
          "P_02/1491423217999_2_-study-dot_test.webm,-0.0019,,\n")
    a = parse_alignment(read_alignment_csv(spark, f"{tmp}/align.csv"))
    assert rows(a, "pid", "record", "study", "aux", "frameshift") == [
        (1, 2, "dot_test", 1, 500000), (1, 2, "dot_test", None, 120000),
        (1, 3, "fitts_law", 1, None), (2, 2, "dot_test", None, -1000),
    ]
    lg = normalize_log(read_log_json(spark, f"{log_dir}/P_*/*.json"))
    assert align_log(lg, a).count() > lg.count()  # a row for each fragment's shift
    al = align_log(lg, a, dedupe=True)
    assert al.count() == lg.count()  # fragments do not repeat rows
    def stamps(df, pid, record):
        return sorted(r[0] for r in df.where(f"pid = {pid} AND record = {record}")
                      .select(micros("timestamp")).collect())

    assert stamps(al, 1, 2) == [t - 120000 for t in stamps(lg, 1, 2)]
    assert stamps(al, 2, 2) == [t + 1000 for t in stamps(lg, 2, 2)]
    assert stamps(al, 1, 3) == stamps(lg, 1, 3)  # thank-you page has no clip: no shift
