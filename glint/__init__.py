"""glint: gaze and interaction analytics on Spark.

Raw study files (questionnaire CSV, browser-log JSON, eye-tracker NDJSON,
dot and calibration TSV, device specs, alignment CSV, tracker frames,
video manifests) are read with declared schemas and turned into tidy
tables and derived views with DataFrame operations only.
"""

__version__ = "0.1.0"
