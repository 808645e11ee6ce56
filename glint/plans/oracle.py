"""DuckDB SQL twins of the registered queries.

Each string runs on the benchmark tables registered as views (`events`,
`customer`, `embeddings`, ...). The proxies are re-derived here from the
table columns directly, not by replaying the Spark steps, so a wrong Spark
operator shows up as a mismatch. Durations and instants are BIGINT
microseconds (`epoch_us` agrees with Spark's timestampdiff; float-to-int
casts use `trunc` because DuckDB rounds where Spark cuts).
"""

from __future__ import annotations

from ..schemas import STUDIES

_STUDY_LIST = "[" + ", ".join(f"'{s}'" for s in STUDIES) + "]"

# The tidy browser log derived from `events` (see proxies.raw_log).
LOG_CTES = f"""
log_src AS (
  SELECT CAST(user_id AS INTEGER) AS pid, ts, event_type AS et, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) AS us
  FROM events
),
log AS (
  SELECT pid,
    CAST(dayofmonth(ts) AS INTEGER) AS record,
    us // 1000 * 1000 AS ts_us,
    {_STUDY_LIST}[CAST(hour(ts) % 20 + 1 AS INTEGER)] AS study,
    CASE WHEN et = 'signup' THEN 'start'
         WHEN et = 'purchase' THEN 'stop'
         WHEN et = 'click' THEN 'click'
         WHEN et = 'view' THEN 'move'
         WHEN et = 'error' AND k % 6 = 0 THEN 'scroll'
         WHEN et = 'error' AND k % 6 = 1 THEN 'input'
         WHEN et = 'error' AND k % 6 = 2 THEN 'text'
         WHEN et = 'error' AND k % 6 = 3 THEN 'save'
         WHEN et = 'error' AND k % 6 = 4 THEN 'response'
    END AS event,
    CASE WHEN et IN ('signup', 'purchase') THEN 'log'
         WHEN et IN ('click', 'view') THEN 'mouse'
         WHEN et = 'error' AND k % 6 = 0 THEN 'scroll'
         WHEN et = 'error' AND k % 6 = 1 THEN 'input'
         WHEN et = 'error' AND k % 6 = 2 THEN 'text'
         ELSE 'log'
    END AS source,
    et <> 'error' AS trusted,
    (us % 86400000000) // 1000 * 1000 AS duration_us,
    CASE WHEN et = 'error' AND k % 6 = 1 THEN CAST(k AS BIGINT) END AS caret_top,
    CASE WHEN et = 'error' AND k % 6 = 1 THEN CAST(floor(value) AS BIGINT) END AS caret_left,
    CASE WHEN et = 'error' AND k % 6 = 2 THEN 'answer ' || CAST(k AS VARCHAR) END AS text,
    CAST(k * 2 AS BIGINT) AS page_x,
    CAST(floor(value * 10) AS BIGINT) AS page_y,
    CAST(k - 50 AS INTEGER) AS mouse_x,
    CAST(floor(value) AS INTEGER) AS mouse_y,
    CAST(0 AS BIGINT) AS scroll_x,
    CAST(k * 10 AS BIGINT) AS scroll_y,
    CAST(0 AS INTEGER) AS window_x,
    CAST(23 AS INTEGER) AS window_y,
    CAST(1280 AS INTEGER) AS inner_w,
    CAST(720 - k AS INTEGER) AS inner_h,
    CAST(1280 AS INTEGER) AS outer_w,
    CAST(800 AS INTEGER) AS outer_h
  FROM log_src
)"""


def with_log(body: str, extra: str = "") -> str:
    ctes = LOG_CTES + ("," + extra if extra else "")
    return f"WITH {ctes}\n{body}"


SQL: dict[str, str] = {}

SQL["normalize_log"] = with_log("SELECT * FROM log")

SQL["recording_durations"] = with_log("""
SELECT s.pid, s.record, s.study, s.ts_us AS start_us,
       COALESCE(b.ts_us, n.ts_us) AS stop_us, COALESCE(b.ts_us, n.ts_us) - s.ts_us AS duration_us
FROM log s
LEFT JOIN log b ON b.event = 'stop' AND b.pid = s.pid AND b.record = s.record
LEFT JOIN log n ON n.event = 'start' AND n.pid = s.pid AND n.record = s.record + 1 AND s.record > 1
  AND NOT EXISTS (SELECT 1 FROM log x WHERE x.event = 'stop' AND x.pid = s.pid AND x.record = s.record)
WHERE s.event = 'start' AND s.study <> 'thank_you'
""")

SQL["recording_durations_dedupe"] = with_log(
    """
SELECT s.pid, s.record, s.study, s.ts_us AS start_us,
       COALESCE(b.stop_us, n.first_us) AS stop_us,
       COALESCE(b.stop_us, n.first_us) - s.ts_us AS duration_us
FROM log s
LEFT JOIN bounds b ON b.pid = s.pid AND b.record = s.record
LEFT JOIN bounds n ON n.pid = s.pid AND n.record = s.record + 1 AND s.record > 1
WHERE s.event = 'start' AND s.study <> 'thank_you'
""",
    """
bounds AS (
  SELECT pid, record,
         max(CASE WHEN event = 'stop' THEN ts_us END) AS stop_us,
         min(CASE WHEN event = 'start' THEN ts_us END) AS first_us
  FROM log WHERE event IN ('start', 'stop') GROUP BY pid, record
)""",
)

SQL["first_start_per_pid"] = with_log(
    "SELECT pid, min(ts_us) AS webcam_start_us FROM log WHERE event = 'start' GROUP BY pid"
)

SQL["distinct_pids"] = with_log("SELECT DISTINCT pid FROM log")

SQL["record_count"] = with_log(
    "SELECT pid, CAST(count(record) AS BIGINT) AS records FROM log GROUP BY pid"
)


# --- shared CTEs of the derived inputs ---------------------------------------------------

from ..schemas import FORM_DOMAINS, SCREEN_START_ADJUSTMENTS  # noqa: E402


def _text_ms(text: str) -> float:
    """Milliseconds of a duration text, read character by character."""
    units = {"h": 3_600_000, "m": 60_000, "s": 1000, "ms": 1}
    total, number, unit = 0.0, "", ""
    for c in text.replace(" ", "").lower() + "0":
        if c.isalpha():
            unit += c
            continue
        if unit:
            total, number, unit = total + units[unit] * float(number), "", ""
        number += c
    return total


def _adjust_values() -> str:
    rows = [
        f"({int(p[2:])}, {int(round((_text_ms(t) - ms) * 1000))})"
        for p, t, ms in SCREEN_START_ADJUSTMENTS
    ]
    return ", ".join(rows)


def _lst(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


D = FORM_DOMAINS
_CK = "c.c_custkey"
FORM_CTES = f"""
users AS (
  SELECT CAST(user_id AS INTEGER) AS pid, min(ts) AS first_ts, max(ts) AS last_ts
  FROM events GROUP BY 1
),
raw_form AS (
  SELECT u.pid, u.first_ts, c.c_custkey AS ck, c.c_nationkey AS nk, c.c_name, c.c_acctbal,
    epoch_us(u.first_ts) // 1000 - 60000 AS log,
    CASE WHEN c.c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Laptop' ELSE 'PC' END AS setting,
    {_lst(D['gender'])}[{_CK} % 2 + 1] AS gender,
    {_lst(D['race'])}[{_CK} % 4 + 1] AS race,
    {_lst(D['skin_color'])}[{_CK} % 6 + 1] AS skin_color,
    {_lst(D['eye_color'] + ['Violet'])}[{_CK} % 6 + 1] AS eye_color,
    {_lst(D['facial_hair'])}[{_CK} % 3 + 1] AS facial_hair,
    {_lst(D['vision'])}[{_CK} % 3 + 1] AS vision,
    {_lst(D['handedness'])}[{_CK} % 2 + 1] AS handedness,
    {_lst(D['weather'])}[{_CK} % 3 + 1] AS weather,
    {_lst(D['pointing_device'])}[{_CK} % 2 + 1] AS pointing_device
  FROM users u LEFT JOIN customer c ON c.c_custkey = u.pid
),
form AS (
  SELECT pid, log, setting,
    CAST(50 AS DOUBLE) + c_acctbal / CAST(1000 AS DOUBLE) AS screen_distance,
    CASE WHEN pid % 4 <> 0 THEN (log + 5000) * 1000 END AS screen_start_us,
    CASE WHEN pid % 4 <> 0 THEN epoch_us(date_trunc('minute', first_ts)) END AS wall_clock_us,
    gender, CAST(18 + ck % 50 AS INTEGER) AS age, race, skin_color,
    CASE WHEN eye_color IN {tuple(D['eye_color'])} THEN eye_color END AS eye_color,
    facial_hair, vision, ck % 2 = 0 AS touch_typer, handedness, weather, pointing_device,
    c_name AS notes, strftime(first_ts, '%H:%M') AS time_of_day,
    log * 1000 AS init_start_us,
    CAST(30 AS DOUBLE) + nk AS screen_w, CAST(20 AS DOUBLE) + nk AS screen_h,
    CAST(1280 + 64 * (nk % 5) AS INTEGER) AS display_w,
    CAST(720 + 36 * (nk % 5) AS INTEGER) AS display_h
  FROM raw_form
),
adjust(pid, start_time_us) AS (VALUES {_adjust_values()}),
first_start AS (
  SELECT pid, min(ts_us) AS webcam_start_us FROM log WHERE event = 'start' GROUP BY pid
),"""

_corner_cols = []
for _depth in ("Back", "Front"):
    for _height in ("Lower", "Upper"):
        for _side in ("Left", "Right"):
            _k = f"{_depth[0].lower()}_{_height[:2].lower()}_{_side[0].lower()}"
            _vals = {
                "x": f"{-250 if _side == 'Left' else 250} + c_nationkey",
                "y": f"{-175 if _height == 'Lower' else 175} + c_custkey % 10",
                "z": f"{850 if _depth == 'Back' else 450}",
            }
            for _a, _expr in _vals.items():
                _e = f"CAST({_expr} AS DOUBLE)"
                if _k == "f_up_r":
                    _e = f"CASE WHEN c_custkey % 9 <> 0 THEN {_e} END"
                _corner_cols.append(f"{_e} AS {_k}_{_a}")

SPEC_CTE = f"""
specs AS (
  SELECT CAST(c_custkey AS INTEGER) AS pid,
    CASE WHEN c_custkey % 7 = 0 THEN 'Bright' ELSE 'Default' END AS illumination_mode,
    CASE WHEN c_custkey % 11 <> 0 THEN CAST(60 + (c_custkey % 3) * 30 AS DOUBLE) END AS frequency,
    {', '.join(_corner_cols)}
  FROM customer
)"""

BFORM_CTE = """
bform AS (
  SELECT f.*, CASE f.setting WHEN 'Laptop' THEN 97 WHEN 'PC' THEN 66 END AS screen_viewport_y,
    s.* EXCLUDE (pid),
    fs.webcam_start_us, fs.webcam_start_us - a.start_time_us AS bscreen_start_us
  FROM form f
  LEFT JOIN adjust a ON a.pid = f.pid
  LEFT JOIN specs s ON s.pid = f.pid
  LEFT JOIN first_start fs ON fs.pid = f.pid
)"""

ALL_FORM = FORM_CTES + SPEC_CTE + "," + BFORM_CTE


def with_form(body: str, extra: str = "") -> str:
    return with_log(body, ALL_FORM + ("," + extra if extra else ""))


SQL["clean_form"] = with_form("SELECT * FROM form")
SQL["read_form_records"] = SQL["clean_form"]

SQL["build_form"] = with_form("""
SELECT pid, setting, screen_viewport_y, init_start_us, webcam_start_us,
       bscreen_start_us AS screen_start_us, b.illumination_mode, b.frequency,
       """ + ", ".join(c.rpartition(" AS ")[2] for c in _corner_cols) + """
FROM bform b""")

SQL["spec_pivot"] = "WITH " + SPEC_CTE + "\nSELECT * FROM specs"

_closed = [c for c in FORM_DOMAINS if c != "illumination_mode"]
_domain_rows = ", ".join(
    f"('{c}', '{v}')" for c, vals in FORM_DOMAINS.items() for v in vals
)
SQL["domain_check"] = with_form(
    """
SELECT column_name, value, count(*) AS n_rows FROM raw_values
WHERE value IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM domain d WHERE d.column_name = raw_values.column_name
                  AND d.value = raw_values.value)
GROUP BY column_name, value""",
    f"""
domain(column_name, value) AS (VALUES {_domain_rows}),
raw_values AS (
  {' UNION ALL '.join(f"SELECT '{c}' AS column_name, {c} AS value FROM raw_form" for c in _closed)}
  UNION ALL SELECT 'illumination_mode', s.illumination_mode FROM raw_form r
    LEFT JOIN specs s ON s.pid = r.pid
)""",
)

TL_CTE = """
tl AS (
  SELECT l.*, l.ts_us - f.init_start_us AS rec_time,
         (l.ts_us - f.init_start_us) - (f.webcam_start_us - f.init_start_us) AS webcam_time,
         (l.ts_us - f.init_start_us) - (f.bscreen_start_us - f.init_start_us) AS screen_time
  FROM log l JOIN bform f ON f.pid = l.pid
)"""

SQL["with_timelines"] = with_form(
    "SELECT pid, record, event, ts_us, rec_time, webcam_time, screen_time FROM tl", TL_CTE)

SQL["event_log"] = with_form(
    """SELECT pid, event, record, study, ts_us, rec_time, webcam_time, screen_time FROM tl
       WHERE event IN ('start', 'stop', 'click', 'save', 'response')""", TL_CTE)

SQL["recording_markers"] = with_form(
    """SELECT pid, CASE WHEN event = 'stop' THEN 0 ELSE record END AS record, event,
              CASE WHEN event = 'stop' THEN 'gap' ELSE study END AS study,
              ts_us, rec_time, webcam_time, screen_time
       FROM tl WHERE event IN ('start', 'stop')""", TL_CTE)

SQL["mouse_points"] = with_form(
    """SELECT pid, ts_us, rec_time, webcam_time, screen_time, event, mouse_x AS x, mouse_y AS y,
              255 AS r, CASE WHEN event = 'click' THEN 140 ELSE 255 END AS g,
              CASE WHEN event = 'click' THEN 0 ELSE 0 END AS b
       FROM tl WHERE source = 'mouse'""", TL_CTE)

_E = lambda i: f"CAST(embedding[{i + 1}] AS DOUBLE)"
GAZE_CTE = f"""
gaze AS (
  SELECT CAST(label AS INTEGER) AS pid,
    CAST(trunc((CAST(1704067200000000 + vec_id * 16667 AS DOUBLE) / CAST(1e6 AS DOUBLE))
               * CAST(1e6 AS DOUBLE)) AS BIGINT) AS ts_us,
    1704067200000000 + vec_id * 16667 AS clock_us, vec_id * 16667 AS device_us,
    coalesce({_E(6)} > 0, false) AS pupil_valid_l,
    CAST(3 AS DOUBLE) - {_E(8)} AS pupil_diameter_r,
    coalesce({_E(2)} > 0, false) AS gaze_valid_l,
    coalesce({_E(5)} > 0, false) AS gaze_valid_r,
    {_E(0)} AS gaze_x_l, {_E(1)} AS gaze_y_l, {_E(3)} AS gaze_x_r, {_E(4)} AS gaze_y_r,
    {_E(11)} AS gaze_ucs_z_l,
    coalesce({_E(7)} > 0, false) AS origin_valid_r,
    {_E(24)} AS trackbox_x_r, {_E(16)} AS origin_ucs_y_l
  FROM embeddings
)"""

SQL["shape_gaze"] = (
    "WITH " + GAZE_CTE + "\nSELECT * EXCLUDE (gaze_y_l, gaze_x_r) FROM gaze"
)

SQL["merge_gaze"] = with_form(
    """
SELECT g.pid, g.ts_us, g.ts_us - f.init_start_us AS rec_time,
  (g.ts_us - f.init_start_us) - (f.webcam_start_us - f.init_start_us) AS webcam_time,
  (g.ts_us - f.init_start_us) - (f.bscreen_start_us - f.init_start_us) AS screen_time,
  CASE WHEN gaze_valid_l AND gaze_valid_r THEN (gaze_x_l + gaze_x_r) / CAST(2 AS DOUBLE)
       WHEN gaze_valid_l THEN gaze_x_l ELSE gaze_x_r END * f.display_w AS x,
  CASE WHEN gaze_valid_l AND gaze_valid_r THEN (gaze_y_l + gaze_y_r) / CAST(2 AS DOUBLE)
       WHEN gaze_valid_l THEN gaze_y_l ELSE gaze_y_r END * f.display_h AS y,
  0 AS r,
  CASE WHEN gaze_valid_l AND NOT gaze_valid_r THEN 0 ELSE 255 END AS g,
  CASE WHEN gaze_valid_r THEN 255 ELSE 255 END * CASE WHEN gaze_valid_l AND gaze_valid_r THEN 1
       WHEN gaze_valid_l THEN 1 ELSE 0 END AS b
FROM gaze g JOIN bform f ON f.pid = g.pid
WHERE gaze_valid_l OR gaze_valid_r""",
    GAZE_CTE,
)

DOTS_CTE = """
dots AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS pid,
    CAST(trunc(CAST(1704067200000 AS DOUBLE) + o.o_orderkey * CAST(1000.5 AS DOUBLE)) AS BIGINT) * 1000
      AS ts_us,
    CAST((o.o_orderkey * 37) % 1280 AS INTEGER) AS x,
    CAST((o.o_orderkey * 53) % 720 AS INTEGER) + f.screen_viewport_y AS y
  FROM orders o LEFT JOIN bform f ON f.pid = o.o_custkey
)"""

SQL["dot_correction"] = with_form("SELECT * FROM dots", DOTS_CTE)

SQL["dot_points"] = with_form(
    """SELECT d.pid, d.ts_us, d.ts_us - f.init_start_us AS rec_time,
         (d.ts_us - f.init_start_us) - (f.webcam_start_us - f.init_start_us) AS webcam_time,
         (d.ts_us - f.init_start_us) - (f.bscreen_start_us - f.init_start_us) AS screen_time,
         d.x, d.y
       FROM dots d JOIN bform f ON f.pid = d.pid""", DOTS_CTE)

SQL["shape_calibration"] = """
SELECT CAST(l_suppkey AS INTEGER) AS pid,
  l_quantity * CAST(20 AS DOUBLE) AS point_x,
  l_extendedprice / CAST(100 AS DOUBLE) AS point_y,
  l_returnflag = 'R' AS valid_l,
  l_linestatus = 'O' AS valid_r,
  l_quantity * CAST(20 AS DOUBLE) + l_discount * CAST(100 AS DOUBLE) AS left_x,
  l_extendedprice / CAST(100 AS DOUBLE) - l_tax * CAST(100 AS DOUBLE) AS left_y,
  l_quantity * CAST(20 AS DOUBLE) - l_discount * CAST(50 AS DOUBLE) AS right_x,
  l_extendedprice / CAST(100 AS DOUBLE) + l_tax * CAST(50 AS DOUBLE) AS right_y
FROM lineitem
WHERE l_linenumber <> 7 AND l_suppkey IS NOT NULL AND l_quantity IS NOT NULL
  AND l_extendedprice IS NOT NULL AND l_discount IS NOT NULL AND l_tax IS NOT NULL
"""

SQL["calibration_targets"] = with_log(
    """
SELECT l.pid, l.study, (l.ts_us - fs.webcam_start_us) // 1000 AS ts_ms,
  l.mouse_x AS screen_x, l.mouse_y AS screen_y, l.event,
  fs.webcam_start_us,
  CASE l.event WHEN 'click' THEN CAST(1 AS DOUBLE) WHEN 'move' THEN CAST(0.5 AS DOUBLE)
       ELSE CAST(0 AS DOUBLE) END AS weight
FROM log l LEFT JOIN first_start fs ON fs.pid = l.pid
WHERE l.study IN ('dot_test', 'fitts_law') AND l.mouse_x IS NOT NULL AND l.mouse_y IS NOT NULL""",
    "first_start AS (SELECT pid, min(ts_us) AS webcam_start_us FROM log WHERE event = 'start' GROUP BY pid)",
)

SQL["paired_targets"] = with_log(
    """
SELECT fr.pid, fr.record, fr.frame AS id, pt.x, pt.y, pt.w
FROM fr JOIN pt ON fr.pid = pt.pid AND fr.record = pt.record AND fr.n = pt.n
WHERE fr.frame IS NOT NULL AND pt.x IS NOT NULL AND pt.y IS NOT NULL""",
    """
fr AS (
  SELECT CAST(user_id AS INTEGER) AS pid, CAST(dayofmonth(ts) AS INTEGER) AS record, CASE WHEN event_id % 7 <> 0 THEN event_id END AS frame,
         row_number() OVER (PARTITION BY user_id, dayofmonth(ts) ORDER BY event_id) AS n
  FROM events WHERE event_type = 'error'
),
pt AS (
  SELECT pid, record, mouse_x AS x, mouse_y AS y,
         CASE WHEN event = 'click' THEN CAST(1 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS w,
         row_number() OVER (PARTITION BY pid, record ORDER BY ts_us NULLS FIRST,
           mouse_x NULLS FIRST, mouse_y NULLS FIRST, event NULLS FIRST) AS n
  FROM log WHERE source = 'mouse'
)""",
)

CLIPS_CTE = f"""
clips AS (
  SELECT CAST(user_id AS INTEGER) AS pid,
    (epoch_us(ts) - epoch_us(ts) % 86400000000) // 1000 AS log,
    CAST(dayofmonth(ts) AS INTEGER) AS record,
    {_STUDY_LIST}[CAST(hour(ts) % 20 + 1 AS INTEGER)] AS study,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 > 0
         THEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 END AS aux,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 <> 0
         THEN CAST(trunc((CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) - 50 AS DOUBLE)
              / CAST(1000 AS DOUBLE)) * CAST(1000 AS DOUBLE)) AS BIGINT) * 1000 END AS frameshift_us,
    value
  FROM events WHERE event_type = 'signup'
)"""

SQL["parse_alignment"] = "WITH " + CLIPS_CTE + "\nSELECT pid, log, record, study, aux, frameshift_us FROM clips"

SQL["align_log"] = with_log(
    """
SELECT l.pid, l.record, l.study, l.event, l.ts_us - coalesce(c.frameshift_us, 0) AS ts_us
FROM log l LEFT JOIN clips c ON c.pid = l.pid AND c.record = l.record AND c.study = l.study""",
    CLIPS_CTE,
)

SQL["align_log_dedupe"] = with_log(
    """
SELECT l.pid, l.record, l.study, l.event, l.ts_us - coalesce(s.shift, 0) AS ts_us
FROM log l LEFT JOIN shifts s ON s.pid = l.pid AND s.record = l.record AND s.study = l.study""",
    CLIPS_CTE + """,
shifts AS (
  SELECT pid, record, study, coalesce(frameshift_us, 0) AS shift FROM clips
  QUALIFY row_number() OVER (PARTITION BY pid, record, study
                             ORDER BY coalesce(aux, 0), coalesce(frameshift_us, 0)) = 1
)""",
)

_MEMBER = """'archive/' || printf('P_%02d/%d_%d_-study-%s', pid, log, record, study)
    || CASE WHEN aux IS NOT NULL THEN printf(' (%d)', aux) ELSE '' END || '.webm'"""
SQL["clip_manifest"] = "WITH " + CLIPS_CTE + f"""
SELECT pid, log, record, study, aux, {_MEMBER} AS member,
  CAST(trunc((value / CAST(100 AS DOUBLE)) * 1000000) AS BIGINT) AS size,
  printf('P_%02d/%02d-%s', pid, record, study)
    || CASE WHEN aux IS NOT NULL THEN '-' || CAST(aux AS VARCHAR) ELSE '' END || '.mp4' AS part_path
FROM clips"""

SQL["fragments"] = "WITH " + CLIPS_CTE + f""",
clipm AS (SELECT *, {_MEMBER} AS member FROM clips),
grp AS (
  SELECT pid, record, study, count(*) AS n_parts FROM clips
  GROUP BY pid, record, study HAVING max(aux) IS NOT NULL
)
SELECT c.pid, c.record, c.study, coalesce(c.aux, 0) AS part, c.member,
  printf('P_%02d/%02d-%s', c.pid, c.record, c.study) || '-' || CAST(coalesce(c.aux, 0) AS VARCHAR)
    || '.mp4' AS part_path,
  printf('P_%02d/%02d-%s', c.pid, c.record, c.study) || '.mp4' AS merged_path,
  g.n_parts
FROM clipm c JOIN grp g ON g.pid = c.pid AND g.record = c.record AND g.study = c.study"""

_SEQ_CTE = """
durs AS (
  SELECT s.pid, s.record, s.study, max(COALESCE(b.ts_us, n.ts_us) - s.ts_us) AS dur
  FROM log s
  LEFT JOIN log b ON b.event = 'stop' AND b.pid = s.pid AND b.record = s.record
  LEFT JOIN log n ON n.event = 'start' AND n.pid = s.pid AND n.record = s.record + 1 AND s.record > 1
    AND NOT EXISTS (SELECT 1 FROM log x WHERE x.event = 'stop' AND x.pid = s.pid AND x.record = s.record)
  WHERE s.event = 'start' AND s.study <> 'thank_you'
  GROUP BY s.pid, s.record, s.study
),
fs AS (SELECT pid, min(ts_us) AS ws FROM log WHERE event = 'start' GROUP BY pid),
seq AS (
  SELECT l.pid, l.record, l.study, l.ts_us - fs.ws AS offset_us, d.dur,
    row_number() OVER (PARTITION BY l.pid ORDER BY l.ts_us - fs.ws, l.record,
      coalesce(list_position(""" + _STUDY_LIST + """, l.study) - 1, -1), l.study) AS rn
  FROM log l JOIN fs ON fs.pid = l.pid
  LEFT JOIN durs d ON d.pid = l.pid AND d.record = l.record AND d.study = l.study
  WHERE l.event = 'start'
),
"""

_DENSE_SEQ_CTE = """
src AS (
  SELECT CAST(user_id % 5 AS INTEGER) AS pid, CAST(event_id AS INTEGER) AS record, epoch_us(ts) AS us, event_id
  FROM events
),
seq AS (
  SELECT pid, record, 'dot_test' AS study, us - min(us) OVER (PARTITION BY pid) AS offset_us,
    CASE WHEN event_id % 10 <> 3 THEN event_id * 7919 % 180000 * 1000000 END AS dur,
    row_number() OVER (PARTITION BY pid ORDER BY us, record) AS rn
  FROM src
),
"""

# the plain loop over each participant's starts, as a recursion
_FOLD_CTE = """
fold AS (
  SELECT pid, rn, record, study, offset_us, dur,
    dur IS NOT NULL AS has_file,
    dur IS NOT NULL AND offset_us >= 0 AS accepted,
    CASE WHEN dur IS NOT NULL THEN offset_us END AS gap_us,
    CAST(NULL AS BIGINT) AS filler_us,
    CASE WHEN dur IS NOT NULL AND offset_us >= 0 THEN offset_us + dur ELSE 0 END AS end_us,
    CASE WHEN dur IS NOT NULL AND offset_us >= 0 THEN 1 ELSE 0 END AS n_acc
  FROM seq WHERE rn = 1
  UNION ALL
  SELECT s.pid, s.rn, s.record, s.study, s.offset_us, s.dur,
    s.dur IS NOT NULL,
    s.dur IS NOT NULL AND s.offset_us - f.end_us >= 0,
    CASE WHEN s.dur IS NOT NULL THEN s.offset_us - f.end_us END,
    CASE WHEN s.dur IS NOT NULL AND s.offset_us - f.end_us >= 30000 AND f.n_acc > 0
         THEN s.offset_us - f.end_us END,
    CASE WHEN s.dur IS NOT NULL AND s.offset_us - f.end_us >= 0 THEN s.offset_us + s.dur
         ELSE f.end_us END,
    f.n_acc + CASE WHEN s.dur IS NOT NULL AND s.offset_us - f.end_us >= 0 THEN 1 ELSE 0 END
  FROM fold f JOIN seq s ON s.pid = f.pid AND s.rn = f.rn + 1
)"""

_FOLD_OUT = """
SELECT pid, record, study, offset_us, dur AS duration_us, has_file, accepted, gap_us, filler_us, end_us
FROM fold"""
SQL["clip_timeline"] = "WITH RECURSIVE " + LOG_CTES + "," + _SEQ_CTE + _FOLD_CTE + _FOLD_OUT
SQL["clip_timeline_dense"] = "WITH RECURSIVE " + _DENSE_SEQ_CTE + _FOLD_CTE + _FOLD_OUT

SQL["frame_index"] = with_form(
    """
SELECT v.pid, v.video, v.frame AS frame_us,
  CASE WHEN v.video = 'webcam' THEN f.webcam_start_us ELSE f.bscreen_start_us END + v.frame AS log_time_us,
  CASE WHEN v.video = 'webcam' THEN f.webcam_start_us ELSE f.bscreen_start_us END
    - f.init_start_us + v.frame AS rec_time_us,
  v.frame AS own_time_us,
  CASE WHEN v.video = 'webcam' THEN v.frame + (f.webcam_start_us - f.bscreen_start_us)
       ELSE v.frame - (f.webcam_start_us - f.bscreen_start_us) END AS other_time_us
FROM frames v JOIN bform f ON f.pid = v.pid
WHERE v.video = 'webcam' OR f.bscreen_start_us IS NOT NULL""",
    """
frames AS (
  SELECT CAST(label AS INTEGER) AS pid,
         CASE WHEN vec_id % 2 = 0 THEN 'webcam' ELSE 'screen' END AS video,
         (vec_id - vec_id % 2) // 2 * 33333 AS frame
  FROM embeddings
)""",
)

SQL["duration_text"] = """
SELECT o_orderkey,
  CASE o_orderkey % 5
    WHEN 0 THEN printf('%dh %dm %ds %dms', o_orderkey % 5, o_orderkey % 60, o_custkey % 60, o_orderkey % 1000)
    WHEN 1 THEN printf('%dMS%dS', o_orderkey % 1000, o_custkey % 60)
    WHEN 2 THEN printf('%d.5s %dm', o_custkey % 60, o_orderkey % 60)
    WHEN 3 THEN printf('%dm %dx', o_orderkey % 60, o_custkey % 60)
    ELSE printf('%ds %ds', o_custkey % 60, o_orderkey % 60) END AS text,
  CASE o_orderkey % 5
    WHEN 0 THEN (o_orderkey % 5) * 3600000000 + (o_orderkey % 60) * 60000000
                + (o_custkey % 60) * 1000000 + (o_orderkey % 1000) * 1000
    WHEN 1 THEN (o_orderkey % 1000) * 1000 + (o_custkey % 60) * 1000000
    WHEN 2 THEN (o_custkey % 60) * 1000000 + 500000 + (o_orderkey % 60) * 60000000
    WHEN 3 THEN NULL
    ELSE (o_orderkey % 60) * 1000000 END AS parsed_us
FROM orders"""

SQL["indexed_frames"] = f"""
SELECT CAST(label AS INTEGER) AS pid, CAST(vec_id % 3 + 1 AS INTEGER) AS record, 0 AS aux,
  row_number() OVER (PARTITION BY label, vec_id % 3 ORDER BY vec_id) - 1 AS index,
  CAST(trunc(CAST(vec_id AS DOUBLE) * CAST(33.4 AS DOUBLE)) AS BIGINT) * 1000 AS ts_us,
  CAST(CASE WHEN {_E(0)} > 0 THEN 1 ELSE 0 END AS TINYINT) AS tracking,
  CAST(label AS INTEGER) AS offset_x,
  CAST({_E(5)} AS FLOAT) AS target_s,
  CAST({_E(11)} AS FLOAT) AS yaw,
  CAST({_E(14)} AS FLOAT) AS eye_l_s,
  CAST({_E(39)} AS FLOAT) AS gaze_r_y,
  CAST(trunc(abs({_E(35)}) * CAST(1000 AS DOUBLE)) AS BIGINT) * 1000 AS gazedur_us,
  CAST(3 AS INTEGER) AS face_n,
  CAST({_E(49)} AS FLOAT) AS face_2_y
FROM embeddings"""

SQL["video_parts"] = "WITH " + CLIPS_CTE + """
SELECT pid, record, study, aux,
  'webcam/' || printf('P_%02d/%02d-%s', pid, record, study)
    || CASE WHEN aux IS NOT NULL THEN '-' || CAST(aux AS VARCHAR) ELSE '' END || '.mp4' AS member,
  CAST(trunc((value / CAST(100 AS DOUBLE)) * 1000000) AS BIGINT) AS size
FROM clips"""

SQL["form_delays"] = with_form("""
SELECT pid, webcam_start_us - init_start_us AS webcam_delay,
       bscreen_start_us - init_start_us AS screen_delay,
       webcam_start_us - bscreen_start_us AS video_delay
FROM bform""")


_BSCR = """
bscr AS (
  SELECT * EXCLUDE (bscreen_start_us),
    CASE WHEN pid IN (SELECT c_custkey FROM customer WHERE c_nationkey % 2 = 0) THEN bscreen_start_us END
      AS bscreen_start_us
  FROM bform
),"""


def _with_screens(sql: str) -> str:
    """The same query with the screen start of listed participants only."""
    head, mark, tail = sql.partition(BFORM_CTE)
    return head + mark + "," + _BSCR.rstrip(",") + tail.replace("bform f", "bscr f")


SQL["frame_index_screens"] = _with_screens(SQL["frame_index"])
SQL["with_timelines_screens"] = _with_screens(SQL["with_timelines"])

SQL["hms_durations"] = """
WITH u AS (
  SELECT CAST(user_id AS INTEGER) AS pid, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS secs
  FROM events GROUP BY 1
)
SELECT pid, printf('%d:%d:%d', secs // 3600, secs % 3600 // 60, secs % 60) AS text, secs * 1000000 AS duration_us
FROM u"""

SQL["clip_order"] = "WITH " + CLIPS_CTE + f""",
m AS (
  SELECT *, {_MEMBER} AS member, CAST(trunc((value / CAST(100 AS DOUBLE)) * 1000000) AS BIGINT) AS size FROM clips
)
SELECT pid, member, size, CAST(row_number() OVER (
  PARTITION BY pid ORDER BY log, record, list_position({_STUDY_LIST}, study), coalesce(aux, 0), member, size
) AS INTEGER) AS place FROM m"""

SQL["read_log_files"] = with_log("SELECT * FROM log WHERE NOT (pid % 10 = 3 AND record % 2 = 0)")
SQL["read_gaze_lines"] = SQL["shape_gaze"] + " WHERE device_us // 16667 % 50 NOT IN (7, 9)"
SQL["read_gaze_recordings"] = SQL["shape_gaze"] + """
WHERE device_us // 16667 <> (SELECT max(e.vec_id) FROM embeddings e WHERE CAST(e.label AS INTEGER) = gaze.pid)"""
SQL["read_log_elements"] = SQL["read_log_files"].replace("FROM events", "FROM events WHERE event_id % 37 <> 5", 1)
SQL["log_reject_counts"] = """
WITH f AS (
  SELECT CAST(user_id AS INTEGER) AS pid, event_id, event_id // 1000 AS file, dayofmonth(ts) AS record,
         user_id % 10 = 3 AND dayofmonth(ts) % 2 = 0 AS cut
  FROM events
)
SELECT pid, count(*) FILTER (WHERE NOT cut AND event_id % 37 = 5) AS bad_events,
       count(DISTINCT (record, file)) FILTER (WHERE cut) AS bad_files
FROM f GROUP BY pid HAVING bad_events + bad_files > 0"""
SQL["read_alignment_lines"] = SQL["parse_alignment"]
SQL["read_tracker_lines"] = SQL["indexed_frames"]
SQL["read_dot_lines"] = """
SELECT CAST(o_custkey AS INTEGER) AS pid,
  CAST(trunc(CAST(1704067200000 AS DOUBLE) + o_orderkey * CAST(1000.5 AS DOUBLE)) AS BIGINT) * 1000 AS ts_us,
  CAST((o_orderkey * 37) % 1280 AS INTEGER) AS x,
  CASE WHEN o_orderkey % 11 <> 5 THEN CAST((o_orderkey * 53) % 720 AS INTEGER) END AS y
FROM orders"""
SQL["read_calibration_lines"] = """
SELECT CAST(l_suppkey AS INTEGER) AS pid, l_quantity * CAST(20 AS DOUBLE) AS point_x, l_returnflag = 'R' AS valid_l,
  l_linenumber = 2 AS nan,
  CASE WHEN l_linenumber = 2 THEN CAST(-1 AS DOUBLE)
       ELSE l_quantity * CAST(20 AS DOUBLE) - l_discount * CAST(50 AS DOUBLE) END AS right_x,
  l_extendedprice / CAST(100 AS DOUBLE) + l_tax * CAST(50 AS DOUBLE) AS right_y
FROM lineitem
WHERE l_linenumber <> 7 AND l_suppkey IS NOT NULL AND l_quantity IS NOT NULL
  AND l_extendedprice IS NOT NULL AND l_discount IS NOT NULL AND l_tax IS NOT NULL"""

_ISO = lambda us: (
    f"strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S') || CASE WHEN {us} % 1000000 <> 0 "
    f"THEN printf('.%06d', {us} % 1000000) ELSE '' END")
SQL["form_json"] = with_form(f"""
SELECT pid, {_ISO('init_start_us')} AS init_start, {_ISO('webcam_start_us')} AS webcam_start,
  time_of_day || ':00' AS time_of_day, CAST(display_w AS VARCHAR) AS display_w,
  CAST(b_lo_l_x AS VARCHAR) AS corner_x, setting, true AS no_helper
FROM bform""")

# every leaf of the gaze table, from the vector's components
_LEAVES = []
for _name, _left, _right in (
    ("gazepoint_display", (0, 1), (3, 4)), ("gazepoint_ucs", (9, 10, 11), (12, 13, 14)),
    ("gazeorigin_ucs", (15, 16, 17), (18, 19, 20)), ("gazeorigin_trackbox", (21, 22, 23), (24, 25, 26)),
):
    for _side, _at in (("left", _left), ("right", _right)):
        _LEAVES += [(f"{_name}.{'xyz'[i]}", _side, _E(k)) for i, k in enumerate(_at)]
for _name, _left, _right in (("pupil_validity", 6, 6), ("gazeorigin_validity", 7, 7), ("gazepoint_validity", 2, 5)):
    _LEAVES += [(_name, s, f"CAST(coalesce({_E(k)} > 0, false) AS DOUBLE)") for s, k in (("left", _left), ("right", _right))]
_LEAVES += [("pupil_diameter", "left", f"CAST(3 AS DOUBLE) + {_E(8)}"), ("pupil_diameter", "right", f"CAST(3 AS DOUBLE) - {_E(8)}")]
SQL["shape_gaze_leaves"] = " UNION ALL ".join(
    f"SELECT CAST(label AS INTEGER) AS pid, vec_id * 16667 AS device_us, '{n}' AS name, '{s}' AS side, {e} AS value FROM embeddings"
    for n, s, e in _LEAVES)
