"""Sources: raw-file readers (S2-S12) and the zip-member data source."""

from .archive import (
    index_zip,
    read_zip,
    screen_files,
    webcam_files,
    zip_calibration,
    zip_dots,
    zip_form,
    zip_logs,
    zip_specs,
    zip_tobii,
)
from .readers import (
    read_alignment_csv,
    read_calib_tsv,
    read_dot_tsv,
    read_form_csv,
    read_log_json,
    read_spec_text,
    read_tobii,
    read_tracker_frames,
    read_video_manifest,
    video_parts,
)

__all__ = [
    "index_zip",
    "read_alignment_csv", "read_calib_tsv", "read_dot_tsv", "read_form_csv", "read_log_json",
    "read_spec_text", "read_tobii", "read_tracker_frames", "read_video_manifest", "read_zip",
    "video_parts", "screen_files", "webcam_files", "zip_calibration", "zip_dots", "zip_form", "zip_logs", "zip_specs", "zip_tobii",
]
