"""The jobs around the unified table: initial pull, daily pull and legacy backfill."""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficloom.functions.dates import iso_date
from trafficloom.operators.legacy import (
    flatten_report_pages,
    month_windows,
    normalize_legacy,
    split_bad_metrics,
)
from trafficloom.plans.reports import landing_page_report
from trafficloom.schemas import DEFAULT_GOAL_METRIC, TARGET
from trafficloom.session import shared_folder
from trafficloom.sinks.target import DayTotal, DayTotals, append_days, create_target, is_folder, replace_days, stored_days
from trafficloom.sources.export import day_window, held_days, scan_export, split_days
from trafficloom.sources.report_pages import UNREADABLE, last_pages, read_report_pages, stage_report_pages
from trafficloom.storage import child_names, create_file, delete_folder, make_folder

Build = Callable[[DataFrame, str | None], DataFrame]


def initial_pull(
    spark: SparkSession,
    export_root: str,
    target: str,
    prior_days: int,
    conversion_event: str | None = None,
    as_of: dt.date | None = None,
    table_prefix: str | None = None,
    build: Build = landing_page_report,
    schema: T.StructType = TARGET,
    days_per_commit: int | None = None,
    on_bad_suffix: str = "error",
    day_from_name: bool = False,
) -> list[DayTotal]:
    """Create the target from the last ``prior_days`` days; fails if it exists.

    No group spans two days, so a long window may be computed and committed in
    runs of ``days_per_commit`` days, newest first, which bounds the shuffled
    data on disk at any time. A daily pull of the missing days completes a run
    that was stopped. Days the export does not hold are left out. Returns rows and totals of
    the days that were written.
    """
    first, last = day_window(as_of, prior_days)
    held = held_days(spark, export_root, as_of, prior_days, table_prefix, on_bad_suffix)
    write, written = create_target, []
    for begin, end in split_days(first, last, days_per_commit or prior_days + 1):
        days = [day for day in held if begin <= day <= end]
        if not days:
            continue
        export = scan_export(spark, export_root, end, (end - begin).days, table_prefix, on_bad_suffix, day_from_name)
        totals = DayTotals(days)
        write(build(export, conversion_event), target, schema, totals)
        written += totals.totals()
        write = append_days
    return sorted(written, key=lambda total: total.date)


def daily_pull(
    spark: SparkSession,
    export_root: str,
    target: str,
    prior_days: int = 0,
    conversion_event: str | None = None,
    as_of: dt.date | None = None,
    table_prefix: str | None = None,
    build: Build = landing_page_report,
    schema: T.StructType = TARGET,
    days_per_commit: int | None = None,
    on_bad_suffix: str = "error",
    day_from_name: bool = False,
) -> list[DayTotal]:
    """Recompute the days of the window that the export holds and replace them in the target.

    Other days of the target stay as they are: the export may have expired them, and
    history before it came from elsewhere. With ``days_per_commit`` the window is replaced
    in runs, newest first. Returns rows and totals of the replaced days.
    """
    first, last = day_window(as_of, prior_days)
    held = held_days(spark, export_root, as_of, prior_days, table_prefix, on_bad_suffix)
    written = []
    for begin, end in split_days(first, last, days_per_commit or prior_days + 1):
        days = [day for day in held if begin <= day <= end]
        if days:
            export = scan_export(spark, export_root, end, (end - begin).days, table_prefix, on_bad_suffix, day_from_name)
            totals = DayTotals(days)
            replace_days(build(export, conversion_event), target, days, schema, totals)
            written += totals.totals()
    return sorted(written, key=lambda total: total.date)


def pull_window(
    pages: DataFrame,
    first: dt.date,
    last: dt.date,
    goal_metric: str = DEFAULT_GOAL_METRIC,
    time_on_page: str = "total",
    quarantine: str | None = None,
    lenient: bool = False,
) -> DataFrame:
    """Unified rows of one month's landed pages, fenced to the given days.

    Rows with a metric that is no number are an error, or go to the ``quarantine`` folder
    as they are, or lose that metric if ``lenient``.
    """
    month = first.replace(day=1)
    rows = flatten_report_pages(pages.filter(F.col("window_start").between(F.lit(month), F.lit(last))), goal_metric)
    if quarantine is not None:
        rows, bad = split_bad_metrics(rows, goal_metric)
        if not bad.isEmpty():
            bad.write.mode("overwrite").json(f"{quarantine}/window_start={first}")
    unified = normalize_legacy(rows, goal_metric, time_on_page, lenient)
    return unified.filter(F.col("date").between(F.lit(first), F.lit(last)))


Window = tuple[dt.date, dt.date]


def _complete(staged: DataFrame, windows: list[Window], missing_months: str, broken_months: str) -> list[Window]:
    """The windows whose landed pages can all be read and end in one last page.

    Others are an error, or are left out and so not logged: ``missing_months`` says so for
    months without any page, ``broken_months`` for those that are cut off or hold an unreadable one.
    """
    for option, value in (("missing_months", missing_months), ("broken_months", broken_months)):
        if value not in ("error", "skip"):
            raise ValueError(f"unknown {option}: {value!r}")
    found = {row["window_start"].replace(day=1): row for row in last_pages(staged).collect()}  # one per month
    month = lambda window: window[0].replace(day=1)
    missing = [w for w in windows if month(w) not in found]
    unreadable = [str(m) for m, row in sorted(found.items()) if row["unreadable_pages"]]
    uneven = [str(m) for m, row in sorted(found.items()) if row["last_pages"] != 1]
    problems = []
    if missing and missing_months == "error":
        problems.append(f"none for {[str(first) for first, _ in missing]}")
    if broken_months == "error":
        if uneven:
            problems.append(f"not exactly one last page for {uneven}")
        if unreadable:
            problems.append(f"unreadable pages for {unreadable}")
    if problems:
        raise ValueError(f"landed pages: {', '.join(problems)}")
    return [w for w in windows if month(w) in found and str(month(w)) not in {*unreadable, *uneven}]


def _set_aside(staged: DataFrame, quarantine: str) -> None:
    """Keep the unreadable pages as they came, a folder per window."""
    bad = staged.filter(F.col(UNREADABLE).isNotNull()).select("window_start", UNREADABLE)
    if not bad.isEmpty():
        bad.write.mode("overwrite").partitionBy("window_start").json(f"{quarantine}/unreadable")


class BackfillLog:
    """What a backfill has finished, as empty folders beside or below the target, and who is at it.

    Spark and the listing of days pass over names that start with an underscore. A table
    keeps the log where ``folder`` says.
    """

    def __init__(self, spark: SparkSession, target: str, folder: str | None = None):
        if folder is None and not is_folder(target):
            raise ValueError("a backfill into a table needs a folder for its log")
        self.spark, self.folder = spark, folder or f"{target}/_backfill"

    @contextlib.contextmanager
    def lease(self, break_lease: bool = False) -> Iterator[None]:
        """Hold the log alone. The lease is a file that only one run can create."""
        path = f"{self.folder}/lease"
        if break_lease:
            delete_folder(self.spark, path)
        if not create_file(self.spark, path):
            raise RuntimeError(f"another backfill holds {path}; if it was killed, run with break_lease")
        try:
            yield
        finally:
            delete_folder(self.spark, path)

    def _entries(self, kind: str) -> set[str]:
        return {n.removeprefix(kind) for n in child_names(self.spark, self.folder) if n.startswith(kind)}

    def bound(self, days: list[dt.date]) -> dt.date:
        """The last day to fill: the day before the target's first when the backfill began."""
        known = self._entries("until=")
        if len(known) > 1:
            raise ValueError(f"{self.folder} names several last days: {sorted(known)}; keep the right one")
        if known:
            return dt.date.fromisoformat(known.pop())
        until = days[0] - dt.timedelta(days=1)
        make_folder(self.spark, f"{self.folder}/until={until}")
        return until

    def finished(self, window: Window) -> bool:
        return f"{window[0]}_{window[1]}" in self._entries("done=")

    def finish(self, window: Window) -> None:
        make_folder(self.spark, f"{self.folder}/done={window[0]}_{window[1]}")


def backfill(
    spark: SparkSession,
    target: str,
    landed_root: str,
    pull_start_date: str | dt.date,
    goal_metric: str = DEFAULT_GOAL_METRIC,
    one_page_per_file: bool = True,
    missing_months: str = "error",
    time_on_page: str = "total",
    quarantine: str | None = None,
    lenient: bool = False,
    log_folder: str | None = None,
    broken_months: str = "error",
    break_lease: bool = False,
) -> list[Window]:
    """Fill in legacy history up to the day before the target's first day.

    The landed pages are parsed once, into staging. Months are then swapped in one by one,
    newest first, and logged when they are whole, so a run that was stopped at any point,
    also halfway through a month's files, can simply be repeated: it replaces what is not
    logged. The target's first day is read from its partitions and logged with the first run.
    A month without rows lands one empty page; one that was never landed is an
    error unless ``missing_months`` is ``skip``. A month with a page that cannot be read, or
    without exactly one last page, is an error before anything is loaded. With
    ``broken_months`` set to ``skip`` it is neither loaded nor logged, so that a run after
    the page was landed again picks it up; unreadable pages are copied to ``quarantine``.

    One backfill at a time works on a target: a second one fails at once, until the first has
    ended or, if that was killed, ``break_lease`` is given.
    Returns the windows that were loaded; none if history is already complete.
    """
    begin = iso_date(pull_start_date)
    days = stored_days(spark, target)
    if not days:
        raise ValueError(f"nothing to backfill before: {target} has no rows")
    log = BackfillLog(spark, target, log_folder)
    with log.lease(break_lease):
        windows = [tuple(w) for w in month_windows(spark, begin, log.bound(days)).collect()]  # one per month
        windows = [w for w in windows if not log.finished(w)]
        if not windows:
            return []
        pages = read_report_pages(spark, landed_root, one_page_per_file)
        needed = F.col("window_start").between(F.lit(windows[-1][0].replace(day=1)), F.lit(windows[0][1]))
        staging = shared_folder(spark, "legacy")
        try:
            staged = stage_report_pages(pages.filter(needed), staging)
            if quarantine is not None:
                _set_aside(staged, quarantine)
            windows = _complete(staged, windows, missing_months, broken_months)
            for window in windows:
                first, last = window
                rows = pull_window(staged, first, last, goal_metric, time_on_page, quarantine, lenient)
                replace_days(rows, target, [first + dt.timedelta(days=n) for n in range((last - first).days + 1)])
                log.finish(window)
        finally:
            delete_folder(spark, staging)
    return windows
