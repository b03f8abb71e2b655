"""Command line of the jobs: `spark-submit <this file> <job> ...` or `python -m solvind <job> ...`."""

from __future__ import annotations

import argparse
import datetime as dt
import json

from solvind.operators.retention import LANDING_DAYS
from solvind.plans import jobs
from solvind.session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="solvind")
    job = parser.add_subparsers(dest="job", required=True)

    landing = argparse.ArgumentParser(add_help=False)
    landing.add_argument("--landing", required=True, help="landing folder")
    landing.add_argument("--kind", choices=jobs.LANDING_KINDS, default="stream")
    landing.add_argument("--since", type=dt.date.fromisoformat, help="skip data that arrived before this day")
    landing.add_argument("--corrections", action="store_true", help="later deliveries replace stored observations that differ")
    landing.add_argument("--history", required=True, help="consolidated history table")
    aside = argparse.ArgumentParser(add_help=False)
    aside.add_argument("--quarantine", help="table for what cannot be read or cannot be true")
    units = argparse.ArgumentParser(add_help=False)
    units.add_argument("--temp-unit", choices=("C", "K"), default="C")

    job.add_parser("consolidate", parents=[landing, units, aside], help="landing -> history")
    follow = job.add_parser("follow", parents=[units, aside], help="landing table -> history, as a stream that reads each file once")
    follow.add_argument("--landing", required=True, help="landing table of the message stream")
    follow.add_argument("--history", required=True)
    follow.add_argument("--checkpoint", required=True)
    follow.add_argument("--every", help='time between batches, such as "10 minutes"; without it, take what is there and stop')
    follow.add_argument("--max-files", type=int, help="files a batch")
    follow.add_argument("--corrections", action="store_true", help="later deliveries replace stored observations that differ")
    update = job.add_parser("update", parents=[landing, units, aside], help="landing -> history -> Silver -> Gold, touched months")
    update.add_argument("--silver", required=True)
    update.add_argument("--gold", required=True)

    silver = job.add_parser("silver", parents=[units, aside], help="documents and history -> Silver")
    silver.add_argument("--documents", nargs="*", default=[], metavar="CITY=PATH")
    silver.add_argument("--json-lines", action="store_true", help="documents are JSON Lines, not arrays")
    silver.add_argument("--history")
    silver.add_argument("--silver", required=True)
    silver.add_argument("--partition-by", nargs="+", default=["city"])

    gold = job.add_parser("gold", help="Silver -> five Gold tables")
    gold.add_argument("--silver", required=True)
    gold.add_argument("--gold", required=True)

    stream = job.add_parser("stream", parents=[aside], help="topics -> landing table")
    stream.add_argument("--servers", required=True)
    stream.add_argument("--topics", required=True, help="comma-separated")
    stream.add_argument("--landing", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--every", default="1 minute")
    stream.add_argument("--retention", help='forget files older than this, such as 30d')
    stream.add_argument("--max-offsets", help="messages per micro-batch")

    compact = job.add_parser("compact", help="few files for the many small ones of a landing table")
    compact.add_argument("--landing", required=True)
    compact.add_argument("--target-mb", type=int, default=128)
    compact.add_argument("--grace-hours", type=float, default=24, help="keep replaced files for readers that still use them")

    expire = job.add_parser("expire", help="drop old arrival days of a landing table or folder")
    what = expire.add_mutually_exclusive_group(required=True)
    what.add_argument("--table", help="catalog table")
    what.add_argument("--landing", help="landing folder")
    expire.add_argument("--days", type=int, default=LANDING_DAYS)
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = build_session(f"solvind-{args.job}")
    if args.job in ("consolidate", "update"):
        rows = jobs.landing_as_history(spark, args.landing, args.kind, temp_unit=args.temp_unit, since=args.since)
        if args.job == "consolidate":
            report = jobs.consolidate(rows, args.history, args.quarantine, args.corrections)
        else:
            report = jobs.update_from_landing(spark, rows, args.history, args.silver, args.gold, args.quarantine, args.corrections)
    elif args.job == "silver":
        documents = [(path, city) for city, path in (pair.split("=", 1) for pair in args.documents)]
        report = jobs.build_silver(
            spark, documents, args.history, args.silver, args.partition_by, args.temp_unit, not args.json_lines,
            quarantine=args.quarantine,
        )
    elif args.job == "gold":
        report = jobs.build_gold(spark, args.silver, args.gold)
    elif args.job == "stream":
        limits = {"maxOffsetsPerTrigger": args.max_offsets} if args.max_offsets else {}
        jobs.run_stream(
            spark, args.servers, args.topics, args.landing, args.checkpoint, args.every, args.retention, args.quarantine, **limits
        ).awaitTermination()
        return
    elif args.job == "follow":
        jobs.consolidate_stream(
            spark, args.landing, args.history, args.checkpoint, args.every, None, args.temp_unit, args.quarantine,
            args.corrections, args.max_files,
        ).awaitTermination()
        return
    elif args.job == "compact":
        report = jobs.compact_landing(spark, args.landing, args.target_mb << 20, 3600 * args.grace_hours)
    else:
        today = dt.datetime.now(dt.timezone.utc).date()
        if args.table:
            report = {"partitions_dropped": jobs.expire_landing(spark, args.table, today, args.days)}
        else:
            report = jobs.expire_landing_folder(spark, args.landing, today, args.days)
    print(json.dumps(report))


if __name__ == "__main__":
    main()
