"""Command line: ``python -m emberlake --root PATH --source '.../{month}.csv' [--date yyyyMMdd]``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from emberlake.plans import jobs
from emberlake.schema import GOLD_TABLES
from emberlake.sources.bronze import LAYOUTS
from emberlake.sources.lake import Lake


def _date(text: str) -> dt.date:
    return dt.datetime.strptime(text, "%Y%m%d").date()


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="emberlake")
    parser.add_argument("--root", required=True, help="root folder of the lake")
    parser.add_argument("--source", help="monthly CSV path; {month} stands for yyyyMM")
    parser.add_argument(
        "--step", choices=["bronze", "silver", "gold", *GOLD_TABLES, "all"], default="all"
    )
    parser.add_argument("--date", type=_date, help="reference date yyyyMMdd; default yesterday, UTC")
    parser.add_argument("--until", type=_date, help="last date of a backfill that starts at --date")
    parser.add_argument(
        "--no-compact", action="store_true", help="write silver without a shuffle (large backfills)"
    )
    parser.add_argument(
        "--layout",
        choices=LAYOUTS,
        default="snapshot",
        help="bronze holds the whole file under every date, or each row once under its own",
    )
    parser.add_argument(
        "--source-zone", help="zone that another writer of silver took the times for, where it stored instants"
    )
    for layer in ("bronze", "silver", "gold"):
        parser.add_argument(f"--{layer}-path", help=f"the {layer} tables' path below the root, as in an existing lake")
    args = parser.parse_args(argv)
    if args.step in ("bronze", "all") and not args.source:
        parser.error("--source is needed to land bronze")
    if args.until and (not args.date or args.until < args.date):
        parser.error("--until needs an earlier --date")
    return args


def dates_of(args: argparse.Namespace) -> list[dt.date]:
    first = args.date or jobs.yesterday()
    last = args.until or first
    return [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    dates = dates_of(args)
    paths = {f"{n}_path": getattr(args, f"{n}_path") for n in ("bronze", "silver", "gold")}
    lake = Lake(args.root, **{name: path for name, path in paths.items() if path})
    spark = SparkSession.builder.appName(f"emberlake-{args.step}").getOrCreate()
    if args.step in ("bronze", "all"):
        jobs.bronze_job(spark, lake, args.source, dates, args.layout)
    if args.step in ("silver", "all"):
        jobs.silver_job(spark, lake, dates, compact=not args.no_compact and args.layout != "by_date")
    if args.step in ("gold", "all"):
        jobs.gold_job(spark, lake, dates, source_zone=args.source_zone)
    elif args.step in GOLD_TABLES:
        jobs.gold_job(spark, lake, dates, tables=[args.step], source_zone=args.source_zone)


if __name__ == "__main__":
    main()
