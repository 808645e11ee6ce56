"""Declared schemas of every raw source and the fixed values of the dataset.

Raw files are always read with a literal StructType (never inferred).
Unsigned widths of the original data are widened to the next signed Spark
type; participant ids are INT so that the tables scale past 255 people.
Durations are BIGINT microseconds, wall-clock times TIMESTAMP_NTZ.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# Fixed values. These must equal the dataset's own vocabulary for results to
# match; they are listed in their natural (declaration) order.
# ---------------------------------------------------------------------------

# Study pages in the order participants saw them; the index is the study order.
STUDIES = [
    "dot_test_instructions",
    "dot_test",
    "fitts_law_instructions",
    "fitts_law",
    "serp_instructions",
    "benefits_of_running_instructions",
    "benefits_of_running",
    "benefits_of_running_writing",
    "educational_advantages_of_social_networking_sites_instructions",
    "educational_advantages_of_social_networking_sites",
    "educational_advantages_of_social_networking_sites_writing",
    "where_to_find_morel_mushrooms_instructions",
    "where_to_find_morel_mushrooms",
    "where_to_find_morel_mushrooms_writing",
    "tooth_abscess_instructions",
    "tooth_abscess",
    "tooth_abscess_writing",
    "dot_test_final_instructions",
    "dot_test_final",
    "thank_you",
]
THANK_YOU = "thank_you"
# The thank-you page is logged as `thankyou.htm`.
PAGE_RENAMES = {"thankyou": "thank_you"}

# Closed value sets of the questionnaire (form) columns.
FORM_DOMAINS = {
    "setting": ["Laptop", "PC"],
    "gender": ["Male", "Female"],
    "race": ["White", "Black", "Asian", "Other"],
    "skin_color": ["1", "2", "3", "4", "5", "6"],
    "eye_color": [
        "Dark Brown to Brown",
        "Gray to Blue or Pink",
        "Green-Hazel to Blue-Hazel",
        "Green-Hazel to Green",
        "Amber",
    ],
    "facial_hair": ["Beard", "Little", "None"],
    "vision": ["Normal", "Glasses", "Contacts"],
    "handedness": ["Left", "Right"],
    "weather": ["Cloudy", "Indoors", "Sunny"],
    "pointing_device": ["Trackpad", "Mouse"],
    "illumination_mode": ["Default"],
}

# Raw browser-log `type` values and their canonical event names.
TYPE_ALIASES = {
    "mouseclick": "click",
    "mousemove": "move",
    "recording start": "start",
    "recording stop": "stop",
    "scrollEvent": "scroll",
    "textInput": "input",
    "text_input": "text",
}
RECORDING_TYPES = ["recording start", "recording stop"]
VIDEO_EVENTS = ["video started", "video stop", "video saved"]
MOUSE_TYPES = ["mousemove", "mouseclick"]
VIDEO_SAVED = "video saved"

# Screen recordings: (participant, time of the first task frame in the
# screen video, ms at which the screen clock changes minute).
SCREEN_START_ADJUSTMENTS = [
    ("P_01", "11s 733ms", 407),
    ("P_02", "3s 350ms", 403),
    ("P_06", "36s 828ms", -378),
    ("P_07", "5s 160ms", 436),
    ("P_08", "32s 32ms", -68),
    ("P_10", "2m 34s 29ms", -647),
    ("P_12", "34s 451ms", -159),
    ("P_13", "1m 3s 689ms", -209),
    ("P_16", "29s 863ms", -332),
    ("P_17", "21s 939ms", -549),
    ("P_18", "24s 441ms", -815),
    ("P_19", "25s 275ms", -765),
    ("P_20", "27s 27ms", -158),
    ("P_23", "24s 733ms", -82),
    ("P_25", "29s 655ms", -497),
    ("P_27", "25s 651ms", -819),
    ("P_31", "3m 51s 273ms", 6),
    ("P_35", "28s 362ms", -42),
    ("P_40", "21s 230ms", -743),
    ("P_41", "20s 395ms", -169),
    ("P_42", "18s 852ms", -376),
    ("P_44", "23s 398ms", -173),
    ("P_45", "30s 697ms", -501),
    ("P_46", "1m 1s 645ms", 6),
    ("P_55", "13s 805ms", -840),
    ("P_56", "22s 856ms", -122),
    ("P_59", "21s 813ms", -214),
]

# Browser viewport offset (pixels from the screen top) per setting.
VIEWPORT_Y = [("Laptop", 97), ("PC", 66)]

# Colours of the derived point views (r, g, b).
COLOR_BOTH_EYES = (0, 255, 255)
COLOR_LEFT_EYE = (0, 0, 255)
COLOR_RIGHT_EYE = (0, 255, 0)
COLOR_CLICK = (255, 140, 0)
COLOR_MOVE = (255, 255, 0)
COLOR_DOT = (0, 0, 0)

# Events shown in the event view.
EVENT_VIEW_EVENTS = ["start", "stop", "click", "save", "response"]
# Studies whose mouse points serve as calibration targets, and weights.
CALIBRATION_STUDIES = ["dot_test", "fitts_law"]
TARGET_WEIGHTS = {"click": 1.0, "move": 0.5}

# A filler clip is planned when a gap reaches this many microseconds.
MIN_FILLER_GAP_US = 30_000

# Raw webcam clip names are `<log>_<record>_-study-<study>[ (<aux>)].webm`.
CLIP_STUDY_MARK = "_-study-"
CLIP_SUFFIX = ".webm"
# A path segment that names a participant: `P_` and any number of digits,
# then the end or something that is no digit or letter.
PID_SEGMENT = r"^P_([0-9]+)(?![0-9A-Za-z])"

# Device spec text lines: `<name>: <value>`.
SPEC_ILLUMINATION = "Illumination mode"
SPEC_FREQUENCY = "Initial gaze output frequency"

# Questionnaire CSV header -> tidy column name.
FORM_COLUMNS = {
    "Participant ID": "pid",
    "Participant Log ID": "log",
    "Date": "date",
    "Setting": "setting",
    "Display Width (pixels)": "display_width",
    "Display Height (pixels)": "display_height",
    "Screen Width (cm)": "screen_width",
    "Screen Height (cm)": "screen_height",
    "Distance From Screen (cm)": "screen_distance",
    "Screen Recording Start Time (Unix milliseconds)": "screen_start",
    "Screen Recording Start Time (Wall Clock)": "wall_clock",
    "Gender": "gender",
    "Age": "age",
    "Self-Reported Race": "race",
    "Self-Reported Skin Color": "skin_color",
    "Self-Reported Eye Color": "eye_color",
    "Facial Hair": "facial_hair",
    "Self-Reported Vision": "vision",
    "Touch Typer": "touch_typer",
    "Self-Reported Handedness": "handedness",
    "Weather": "weather",
    "Pointing Device": "pointing_device",
    "Notes": "notes",
    "Time of day": "time_of_day",
    "Duration": "duration",
}

# ---------------------------------------------------------------------------
# Raw source schemas.
# ---------------------------------------------------------------------------


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


FORM_CSV_SCHEMA = _struct(
    ("Participant ID", StringType()),
    ("Participant Log ID", LongType()),
    ("Date", StringType()),
    ("Setting", StringType()),
    ("Display Width (pixels)", IntegerType()),
    ("Display Height (pixels)", IntegerType()),
    ("Screen Width (cm)", DoubleType()),
    ("Screen Height (cm)", DoubleType()),
    ("Distance From Screen (cm)", DoubleType()),
    ("Screen Recording Start Time (Unix milliseconds)", LongType()),
    ("Screen Recording Start Time (Wall Clock)", StringType()),
    ("Gender", StringType()),
    ("Age", IntegerType()),
    ("Self-Reported Race", StringType()),
    ("Self-Reported Skin Color", StringType()),
    ("Self-Reported Eye Color", StringType()),
    ("Facial Hair", StringType()),
    ("Self-Reported Vision", StringType()),
    ("Touch Typer", StringType()),
    ("Self-Reported Handedness", StringType()),
    ("Weather", StringType()),
    ("Pointing Device", StringType()),
    ("Notes", StringType()),
    ("Time of day", StringType()),
    ("Duration", StringType()),
)

# Numbers of the browser log are read as DOUBLE: whole numbers are sometimes
# written `1.0`, which an integer schema turns into null. D3 casts them.
LOG_JSON_SCHEMA = _struct(
    ("isTrusted", BooleanType()),
    ("sessionId", StringType()),
    ("webpage", StringType()),
    ("sessionString", StringType()),
    ("epoch", DoubleType()),
    ("time", DoubleType()),
    ("type", StringType()),
    ("event", StringType()),
    ("text", StringType()),
    ("pos", _struct(("top", DoubleType()), ("left", DoubleType()))),
    ("screenX", DoubleType()),
    ("screenY", DoubleType()),
    ("clientX", DoubleType()),
    ("clientY", DoubleType()),
    ("pageX", DoubleType()),
    ("pageY", DoubleType()),
    ("scrollX", DoubleType()),
    ("scrollY", DoubleType()),
    ("windowX", DoubleType()),
    ("windowY", DoubleType()),
    ("windowInnerWidth", DoubleType()),
    ("windowInnerHeight", DoubleType()),
    ("windowOuterWidth", DoubleType()),
    ("windowOuterHeight", DoubleType()),
)

_vec = ArrayType(DoubleType())
# Whole numbers may be written as `1.0`: read as double, cast when shaped.
TOBII_JSON_SCHEMA = _struct(
    ("device_time_stamp", DoubleType()),
    ("system_time_stamp", DoubleType()),
    ("true_time", DoubleType()),
    ("left_pupil_validity", DoubleType()),
    ("right_pupil_validity", DoubleType()),
    ("left_gaze_origin_validity", DoubleType()),
    ("right_gaze_origin_validity", DoubleType()),
    ("left_gaze_point_validity", DoubleType()),
    ("right_gaze_point_validity", DoubleType()),
    ("left_pupil_diameter", DoubleType()),
    ("right_pupil_diameter", DoubleType()),
    ("left_gaze_origin_in_user_coordinate_system", _vec),
    ("right_gaze_origin_in_user_coordinate_system", _vec),
    ("left_gaze_origin_in_trackbox_coordinate_system", _vec),
    ("right_gaze_origin_in_trackbox_coordinate_system", _vec),
    ("left_gaze_point_in_user_coordinate_system", _vec),
    ("right_gaze_point_in_user_coordinate_system", _vec),
    ("left_gaze_point_on_display_area", _vec),
    ("right_gaze_point_on_display_area", _vec),
    ("_corrupt_record", StringType()),
)

CALIB_TSV_SCHEMA = _struct(
    ("point_x", DoubleType()),
    ("point_y", DoubleType()),
    ("prediction_x_left", DoubleType()),
    ("prediction_y_left", DoubleType()),
    ("validity_left", ByteType()),
    ("prediction_x_right", DoubleType()),
    ("prediction_y_right", DoubleType()),
    ("validity_right", ByteType()),
)

DOT_TSV_SCHEMA = _struct(
    ("Dot_X", IntegerType()),
    ("Dot_Y", IntegerType()),
    ("Epoch", DoubleType()),
)

ALIGNMENT_CSV_SCHEMA = _struct(
    ("video", StringType()),
    ("frameshift", DoubleType()),
    ("corrOptimal", DoubleType()),
    ("corrOrig", DoubleType()),
)

_pair_d = _struct(("left", DoubleType()), ("right", DoubleType()))
_pair_v = _struct(("left", _vec), ("right", _vec))
TRACKER_JSON_SCHEMA = _struct(
    ("trackTime", DoubleType()),
    ("trackEvent", LongType()),
    ("frameOffset", ArrayType(LongType())),
    ("frameOrigin", ArrayType(LongType())),
    ("cameraFocal", _vec),
    ("screenOrigin", ArrayType(LongType())),
    ("faceTarget", _vec),
    ("facePosition", _vec),
    ("faceRotation", _vec),
    ("eyeTarget", _pair_v),
    ("eyeAspectRatio", _pair_d),
    ("pupilConfidence", _pair_d),
    ("pupilCenter", _pair_v),
    ("calibConfidence", _pair_d),
    ("calibShift", _vec),
    ("calibEdge", _vec),
    ("gazeEvent", LongType()),
    ("gazeDuration", DoubleType()),
    ("gazePoint", _pair_v),
    ("gazeBestPoint", _vec),
    ("fixationPoint", _vec),
    ("faceShape", ArrayType(_vec)),
)

