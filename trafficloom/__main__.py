"""The jobs as commands for ``spark-submit`` or a scheduler.

    python -m trafficloom create   --export DIR --target T --shuffle-partitions 8000 --prior-days 90
    python -m trafficloom daily    --export DIR --target T --prior-days 3 --conversion-event purchase
    python -m trafficloom follow   --export DIR --target T --state DIR
    python -m trafficloom backfill --landed DIR --target T --start 2021-11-15 --goal-metric ga:goal1Completions
    python -m trafficloom review   --target T
"""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import functions as F

from trafficloom.functions.dates import iso_date
from trafficloom.plans.jobs import backfill, daily_pull, initial_pull
from trafficloom.plans.reports import acquisition_report, landing_page_report
from trafficloom.schemas import DEFAULT_GOAL_METRIC, SOURCE_MEDIUM, TARGET
from trafficloom.session import build_session
from trafficloom.sinks.target import read_target, review, review_months, review_sources
from trafficloom.streaming.daily import pull_new_days

REPORTS = {
    "landing": {"build": landing_page_report, "schema": TARGET},
    "source-medium": {"build": acquisition_report, "schema": SOURCE_MEDIUM},
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="trafficloom")
    commands = top.add_subparsers(dest="command", required=True)
    for name in ("create", "daily", "follow", "backfill", "review"):
        command = commands.add_parser(name)
        command.add_argument("--target", required=True, help="folder or table name")
        command.add_argument("--shuffle-partitions", type=int, required=True, help="about shuffle bytes / 128 MB")
        if name != "backfill":
            command.add_argument("--report", choices=REPORTS, default="landing")
        if name in ("create", "daily", "follow"):
            command.add_argument("--export", required=True, help="folder with day partitions or shards")
            command.add_argument("--conversion-event")
            command.add_argument("--landing-page-unset", help="label of a missing landing page")
            command.add_argument("--on-bad-suffix", choices=["error", "skip"], default="error")
            command.add_argument("--days-per-commit", type=int)
        if name in ("create", "daily"):
            command.add_argument("--prior-days", type=int, default=0)
            command.add_argument("--as-of", type=iso_date, help="last day, today in UTC if left out")
            command.add_argument("--table-prefix", help="name of a day's shard without its day")
            command.add_argument("--day-from-name", action="store_true", help="shards hold their day in the name only")
    commands.choices["follow"].add_argument("--state", required=True, help="folder for stream progress")
    commands.choices["review"].add_argument("--rows", type=int, default=20)
    old = commands.choices["backfill"]
    old.add_argument("--landed", required=True, help="folder with landed legacy pages")
    old.add_argument("--start", type=iso_date, required=True)
    old.add_argument("--goal-metric", default=DEFAULT_GOAL_METRIC)
    old.add_argument("--json-lines", action="store_true", help="one response per line, not per file")
    old.add_argument("--missing-months", choices=["error", "skip"], default="error")
    old.add_argument("--broken-months", choices=["error", "skip"], default="error", help="months with unreadable pages")
    old.add_argument("--break-lease", action="store_true", help="go on after a run that was killed")
    old.add_argument("--time-on-page", choices=["total", "per_session"], default="total")
    old.add_argument("--quarantine", help="folder for unreadable pages and for rows with unreadable metrics")
    old.add_argument("--lenient", action="store_true", help="unreadable metrics become NULL")
    old.add_argument("--log", help="folder of the log, needed for a table")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(spark__sql__shuffle__partitions=str(args.shuffle_partitions))
    if args.command == "backfill":
        loaded = backfill(
            spark, args.target, args.landed, args.start, args.goal_metric,
            one_page_per_file=not args.json_lines, missing_months=args.missing_months,
            time_on_page=args.time_on_page, quarantine=args.quarantine, lenient=args.lenient, log_folder=args.log,
            broken_months=args.broken_months, break_lease=args.break_lease,
        )
        print(f"{len(loaded)} months loaded")
        return
    kind = dict(REPORTS[args.report])
    if getattr(args, "landing_page_unset", None) is not None:
        if args.report != "landing":
            raise SystemExit("--landing-page-unset belongs to the landing report")
        kind["build"] = partial(landing_page_report, landing_page_unset=args.landing_page_unset)
    if args.command == "review":
        target = read_target(spark, args.target, kind["schema"])
        months = review_months(target).orderBy(F.desc("month"))
        months.show(months.count())  # one row per month, all of them
        review_sources(target).orderBy(F.desc("sessions"), "utm_source", "utm_medium").show(args.rows)
        review(target, args.rows).show(args.rows, truncate=False)
        return
    if args.command == "follow":
        pull_new_days(
            spark, args.export, args.target, args.state, args.conversion_event,
            days_per_commit=args.days_per_commit, on_bad_suffix=args.on_bad_suffix, **kind,
        )
        return
    pull = {
        "days_per_commit": args.days_per_commit,
        "on_bad_suffix": args.on_bad_suffix,
        "prior_days": args.prior_days,
        "conversion_event": args.conversion_event,
        "as_of": args.as_of,
        "table_prefix": args.table_prefix,
        "day_from_name": args.day_from_name,
        **kind,
    }
    job = initial_pull if args.command == "create" else daily_pull
    for day in job(spark, args.export, args.target, **pull):
        print(f"{day.date}: {day.report_rows} rows, {day.users} users, {day.sessions} sessions, {day.conversions} conversions")


if __name__ == "__main__":
    main()
