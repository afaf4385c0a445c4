"""Command line: the reference's jobs as Spark applications.

  classify  CSV folder -> classified CSV (+ class/severity statistics, preview)
  curate    CSV folder -> curated Parquet table + the three rollup tables
  land      JSON-lines folder -> dt=/hour= landing zone (batch or stream)
  upsert    JSON-lines folder -> latest-wins dedup table (batch or stream)
  compact   merge the days of a dedup table that were touched since they were last merged

Run with ``spark-submit -m``-style launchers or ``python -m emberwall.cli``.
"""

from __future__ import annotations

import argparse
import json
import sys

from .operators import aggregates as A
from .operators.classify import analyze_batch
from .operators.search import preview
from .session import build_session
from .sinks import files as K
from .sinks.grams import refresh_grams
from .sinks.manifest import manifest_totals
from .sinks.zones import refresh_zones
from .sources.csv import scan_csv
from .sources.jsonl import scan_jsonl
from .streaming import jobs as ST
from .streaming.progress import ProgressCollector, watched


def cmd_classify(spark, args) -> int:
    classified = analyze_batch(scan_csv(spark, args.input), args.timestamp_mode)
    if not K.write_classified_csv(classified, args.output):
        print("empty result: nothing written", file=sys.stderr)
        return 1
    # statistics and preview come from what was written, so the input is classified once
    written = scan_csv(spark, args.output)
    print(json.dumps(A.batch_stats(written).first().asDict()))
    if args.preview:
        preview(written).show(truncate=False)
    return 0


def cmd_curate(spark, args) -> int:
    classified = analyze_batch(scan_csv(spark, args.input), args.timestamp_mode)
    K.curated_write(classified, f"{args.output}/firewall_logs")
    curated = spark.read.parquet(f"{args.output}/firewall_logs")
    K.write_rollup_tables(curated, args.output)
    refresh_zones(spark, f"{args.output}/firewall_logs")
    refresh_grams(spark, f"{args.output}/firewall_logs")
    print(json.dumps(A.overview(curated).first().asDict()))
    return 0


def _checkpoint(args) -> str:
    """A stream's progress folder: the same for every run over an output, so a restart goes on where the last ended."""
    return args.checkpoint or f"{args.output.rstrip('/')}__checkpoint"


def _admission(args) -> dict:
    return {"trigger": args.trigger, "max_files_per_trigger": args.max_files_per_trigger,
            "max_bytes_per_trigger": args.max_bytes_per_trigger, "max_records_per_trigger": args.max_records_per_trigger}


def cmd_land(spark, args) -> int:
    if args.stream:
        document = f"{args.output.rstrip('/')}__meta/progress"
        collector = ProgressCollector(
            on_snapshot=lambda snap: K.write_progress(spark, snap, document),
            count_parts=lambda: manifest_totals(spark, args.output).first()["files"])
        q = watched(spark, lambda: ST.stream_landing(spark, args.input, args.output, _checkpoint(args),
                                                     **_admission(args)), collector)
        print(json.dumps(collector.snapshot(str(q.id))))
    else:
        K.landing_write(scan_jsonl(spark, args.input), args.output)
    return 0


def cmd_upsert(spark, args) -> int:
    if args.stream:
        ST.stream_upsert(spark, args.input, args.output, _checkpoint(args), **_admission(args))
    else:
        K.dedup_append(scan_jsonl(spark, args.input), args.output)
    return 0


def cmd_compact(spark, args) -> int:
    print(json.dumps({"merged_days": K.dedup_compact(spark, args.table)}))
    return 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="emberwall")
    ap.add_argument("--master", default=None, help="Spark master (default: the launcher's)")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("classify", "curate"):
        p = sub.add_parser(name)
        p.add_argument("input", help="CSV file, folder or glob")
        p.add_argument("output")
        p.add_argument("--timestamp-mode", default="parsed", choices=("parsed", "raw"))
        if name == "classify":
            p.add_argument("--preview", action="store_true")
    for name in ("land", "upsert"):
        p = sub.add_parser(name)
        p.add_argument("input", help="folder of JSON-lines files")
        p.add_argument("output")
        p.add_argument("--stream", action="store_true", help="run as a file stream (resumable)")
        p.add_argument("--checkpoint", default=None)
        p.add_argument("--trigger", default=None, help="processing-time interval; default: available now")
        p.add_argument("--max-files-per-trigger", type=int, default=None)
        p.add_argument("--max-bytes-per-trigger", default=None, help="such as 64m; with --trigger this bounds the rate")
        p.add_argument("--max-records-per-trigger", type=int, default=None, help="with --trigger this is the rate")
    sub.add_parser("compact").add_argument("table")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    handler = {"classify": cmd_classify, "curate": cmd_curate, "land": cmd_land, "upsert": cmd_upsert,
               "compact": cmd_compact}[args.cmd]
    return handler(spark, args)


if __name__ == "__main__":
    sys.exit(main())
