"""Command line: `python -m glint etl|prepare|frames ...` (or spark-submit).

etl      raw folder or zip -> tidy tables (form, log, tobii, dot, calib)
prepare  tidy tables -> per-participant views
index    archive -> restart points of its deflated recordings
frames   tracker-output NDJSON -> one sorted lz4 table
"""

from __future__ import annotations

import argparse
import sys
import time

from .plans.jobs import TABLES, VIEWS, etl, prepare, tracker_frames
from .session import get_session
from .sources import index_zip


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="glint")
    sub = p.add_subparsers(dest="command", required=True)

    e = sub.add_parser("etl", help="raw files -> tidy tables")
    e.add_argument("dataset", help="raw folder, or the dataset zip with --zip")
    e.add_argument("--output-path", required=True)
    e.add_argument("--zip", action="store_true", help="read the dataset from a zip archive")
    e.add_argument("--alignment-path", default=None)
    e.add_argument("--no-sync-video", action="store_true", help="leave every screen start null")
    e.add_argument("--align-first", action="store_true", help="webcam start from the aligned log")
    e.add_argument("--process", nargs="*", default=TABLES, choices=TABLES)
    e.add_argument("--overwrite", action="store_true")
    e.add_argument("--dry-run", action="store_true")
    e.add_argument("--tolerant", action="store_true", help="set aside what does not parse instead of failing")

    e.add_argument("--zip-index", default=None, help="restart points written by `index`, so that one recording is many tasks")

    e.add_argument("--point-reads", action="store_true", help="Bloom filters for pid and study in the log")

    x = sub.add_parser("index", help="restart points of an archive's deflated recordings")
    x.add_argument("dataset", help="the dataset zip")
    x.add_argument("--output-path", required=True)
    x.add_argument("--overwrite", action="store_true")

    r = sub.add_parser("prepare", help="tidy tables -> views")
    r.add_argument("input_path")
    r.add_argument("--output-path", required=True)
    r.add_argument("--clips", default=None, help="parquet of (pid, record, study, duration us)")
    r.add_argument("--frames", default=None, help="parquet of (pid, video, frame us)")
    r.add_argument("--screen-videos", default=None, help="parquet of the pids that have a screen video")
    r.add_argument("--process", nargs="*", default=VIEWS, choices=VIEWS)
    r.add_argument("--overwrite", action="store_true")

    f = sub.add_parser("frames", help="tracker NDJSON -> sorted table")
    f.add_argument("glob")
    f.add_argument("--output-path", required=True)
    f.add_argument("--overwrite", action="store_true")
    return p


def main(argv: list[str] | None = None) -> list[str]:
    args = _parser().parse_args(argv)
    spark = get_session(app=f"glint-{args.command}")
    start = time.perf_counter()
    if args.command == "etl":
        done = etl(
            spark, args.dataset, args.output_path, process=args.process,
            layout="zip" if args.zip else "dir", alignment_path=args.alignment_path,
            sync=not args.no_sync_video, overwrite=args.overwrite, dry_run=args.dry_run,
            align_first=args.align_first, strict=not args.tolerant, index=args.zip_index, point_reads=args.point_reads,
        )
        for name, n in done.counts.items():
            print(f"{name}: {n['rows']} rows, {n['rejects']} left out")
    elif args.command == "index":
        index_zip(spark, args.dataset, args.output_path, overwrite=args.overwrite)
        done = ["index"]
    elif args.command == "prepare":
        inputs = {}
        if args.clips:
            inputs["clips"] = spark.read.parquet(args.clips)
        if args.frames:
            inputs["frames"] = spark.read.parquet(args.frames)
        if args.screen_videos:
            inputs["screen_videos"] = spark.read.parquet(args.screen_videos)
        process = [v for v in args.process if v not in ("timeline", "frames") or
                   (v == "timeline" and args.clips) or (v == "frames" and args.frames)]
        done = prepare(spark, args.input_path, args.output_path, process=process,
                       overwrite=args.overwrite, **inputs)
    else:
        tracker_frames(spark, args.glob, args.output_path, overwrite=args.overwrite)
        done = ["frames"]
    print(f"{args.command}: {', '.join(done)} in {time.perf_counter() - start:.1f} s")
    return done


if __name__ == "__main__":
    main(sys.argv[1:])
