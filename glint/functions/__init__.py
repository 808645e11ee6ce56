"""Column functions."""

from .exprs import (
    add_us,
    checked,
    diff_ms,
    diff_us,
    duration_text_us,
    epoch_ntz,
    from_micros,
    from_millis,
    hms_to_us,
    micros,
    minute_of_day,
    ms_to_us,
    padded,
    pid_from_name,
    rgb,
    split_part,
    strip_affixes,
    study_ord,
    to_struct,
    value_map,
)

__all__ = [
    "add_us", "checked", "diff_ms", "diff_us", "duration_text_us", "epoch_ntz",
    "from_micros", "from_millis", "hms_to_us", "micros", "minute_of_day",
    "ms_to_us", "padded", "pid_from_name", "rgb", "split_part", "strip_affixes",
    "study_ord", "to_struct", "value_map",
]
