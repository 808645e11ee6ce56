"""User-level operators D1-D20 (DataFrame -> DataFrame)."""

from .form import (
    build_form,
    check_domains,
    clean_form,
    domain_violations,
    first_starts,
    form_delays,
    parse_specs,
    screen_adjustments,
    spec_lines,
    viewport_offsets,
)
from .frames import shape_tracker_frames
from .gaze import calibration_targets, paired_targets, shape_calibration, shape_dots, shape_gaze
from .log import align_log, normalize_log, parse_alignment
from .ordering import prefix_last, prefix_sum, prefixes, row_index
from .recordings import (
    clip_manifest,
    clip_sort_key,
    clip_timeline,
    fragment_parts,
    frame_index,
    recording_durations,
    recording_ends,
)
from .timelines import (
    dot_points,
    event_log,
    merge_gaze,
    mouse_points,
    recording_markers,
    with_timelines,
)

__all__ = [
    "align_log", "build_form", "calibration_targets", "check_domains", "clean_form", "clip_manifest",
    "clip_sort_key", "clip_timeline", "domain_violations", "dot_points", "event_log", "first_starts",
    "form_delays", "fragment_parts", "frame_index", "merge_gaze", "mouse_points", "normalize_log",
    "paired_targets", "parse_alignment", "parse_specs", "prefix_last", "prefix_sum", "prefixes", "recording_durations",
    "recording_ends", "recording_markers", "row_index", "screen_adjustments", "shape_calibration",
    "shape_dots", "shape_gaze", "shape_tracker_frames", "spec_lines", "viewport_offsets",
    "with_timelines",
]
