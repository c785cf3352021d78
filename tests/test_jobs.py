"""Scans, target writes, backfill and the daily pulls."""

import datetime as dt
from functools import partial
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.builders import METRICS, DIMENSIONS, changed, event, export, landed, legacy_page, legacy_row, session_params
from trafficloom.__main__ import main
from trafficloom.operators.legacy import backfill_bound
from trafficloom.plans.jobs import BackfillLog, backfill, daily_pull, initial_pull
from trafficloom.plans.reports import acquisition_report, landing_page_report
from trafficloom.schemas import RATIO_METRIC, SOURCE_MEDIUM, TARGET
from trafficloom.session import shared_folder
from trafficloom.sinks.target import append_days, create_target, read_target, replace_days, review, review_months
from trafficloom.sources.export import scan_export, scan_table, shard_days, split_days
from trafficloom.storage import child_names, create_file, make_folder
from trafficloom.streaming.daily import consecutive, pull_new_days

D = lambda day, month=1, year=2024: dt.date(year, month, day)
COUNTER = iter(range(10**6))


def place(spark, kind):
    return shared_folder(spark, "target") if kind == "folder" else f"target_{next(COUNTER)}"


def visits(*days, user="u1", pages=1):
    return [
        event(params=session_params(day, f"https://x/{p}"), at=day * 100 + p, day=f"202401{day:02d}", user=user)
        for day in days
        for p in range(pages)
    ]


def land(spark, root, events, mode="append"):
    writer = export(spark, *events).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("event_date").parquet(root)


def per_day(spark, target, schema=TARGET):
    rows = read_target(spark, target, schema).groupBy("date").agg(F.sum("page_views")).collect()
    return {r[0].day: r[1] for r in rows}


# scans

@pytest.mark.parametrize("prior_days, days", [(0, 1), (1, 2), (30, 5)])
def test_window_includes_both_ends(spark, prior_days, days):
    root = shared_folder(spark, "export")
    land(spark, root, visits(1, 2, 3, 4, 5, 9))
    scan = scan_export(spark, root, D(5), prior_days)
    assert scan.select("event_date").distinct().count() == days


def test_window_prunes_partitions_and_columns(spark):
    root = shared_folder(spark, "export")
    land(spark, root, visits(1, 2, 3))
    report = acquisition_report(scan_export(spark, root, D(3), 1))
    plan = report._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    opened = scan_export(spark, root, D(3), 1).inputFiles()
    assert opened and not any("event_date=20240101" in name for name in opened)
    for unused in ("geo", "device", "float_value", "language"):
        assert unused not in scan.split("ReadSchema")[1]


def test_shards_by_table_prefix(spark):
    root = shared_folder(spark, "shards")
    for day in (1, 2, 3):
        export(spark, *visits(day)).write.parquet(f"{root}/events_2024010{day}")
        export(spark, *visits(day)).write.parquet(f"{root}/other_2024010{day}")
    scan = scan_export(spark, root, D(3), 1, table_prefix="events_")
    assert scan.count() == 2
    assert all("events_2024010" in name for name in scan.inputFiles())
    with pytest.raises(ValueError, match="holds no day"):
        scan_export(spark, root, D(20), 1, table_prefix="events_")
    for mistyped in ({"root": root, "table_prefix": "evnts_"}, {"root": root + "x", "table_prefix": "events_"}):
        with pytest.raises(ValueError, match="nothing named"):
            scan_export(spark, as_of=D(3), **mistyped)
    export(spark, *visits(3)).write.parquet(f"{root}/events_intraday_20240103")
    with pytest.raises(ValueError, match="intraday"):
        scan_export(spark, root, D(3), 1, table_prefix="events_")
    assert scan_export(spark, root, D(3), 1, table_prefix="events_", on_bad_suffix="skip").count() == 2


def test_shard_names():
    assert shard_days(["p20240229", "q1", "p20240301.parquet"], "p") == {
        "p20240229": D(29, 2), "p20240301.parquet": D(1, 3),
    }
    for bad in ("p20230229", "p2024", "p202401011", "pintraday_20240101"):
        with pytest.raises(ValueError):
            shard_days([bad], "p")


@pytest.mark.parametrize("column", ["event_date", "to_date(event_date, 'yyyyMMdd')"])
def test_scan_of_a_table(spark, column):
    name = f"export_{next(COUNTER)}"
    events = export(spark, *visits(1, 2, 3)).withColumn("event_date", F.expr(column))
    events.write.partitionBy("event_date").saveAsTable(name)
    scan = scan_table(spark, name, D(3), 1)
    assert sorted(r["event_date"] for r in scan.collect()) == ["20240102", "20240103"]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_a_table_with_a_malformed_day(spark):
    name = f"export_{next(COUNTER)}"
    events = visits(1, 2, 3) + [event(day="intraday_20240103")] + [event(day="20240230")]
    export(spark, *events).write.saveAsTable(name)
    with pytest.raises(Exception, match="not a day"):
        scan_table(spark, name, D(3), 1).collect()
    assert scan_table(spark, name, D(3), 1, on_bad_suffix="skip").count() == 2


# target

@pytest.mark.parametrize("kind", ["folder", "table"])
def test_daily_pull_replaces_exactly_its_days(spark, kind):
    root, target = shared_folder(spark, "export"), place(spark, kind)
    land(spark, root, visits(1, 2, 3))
    initial_pull(spark, root, target, 2, as_of=D(3))
    assert per_day(spark, target) == {1: 1, 2: 1, 3: 1}
    with pytest.raises(AnalysisException, match="ALREADY_EXISTS"):
        initial_pull(spark, root, target, 2, as_of=D(3))

    land(spark, root, visits(3, 4, pages=5), mode="overwrite")
    for _ in range(2):
        daily_pull(spark, root, target, 1, as_of=D(4))
        assert per_day(spark, target) == {1: 1, 2: 1, 3: 5, 4: 5}
    assert read_target(spark, target).schema.fieldNames() == TARGET.fieldNames()


@pytest.mark.parametrize("kind", ["folder", "table"])
def test_a_day_whose_result_is_now_empty_goes_away(spark, kind):
    root, target = shared_folder(spark, "export"), place(spark, kind)
    land(spark, root, visits(1, 2, 3))
    initial_pull(spark, root, target, 2, as_of=D(3))
    report = landing_page_report(scan_export(spark, root, D(3), 2))
    replace_days(report.filter(F.col("date") != F.lit(D(2))), target, [D(2), D(3)])
    assert per_day(spark, target) == {1: 1, 3: 1}
    replace_days(report.limit(0), target, [D(3)])
    assert per_day(spark, target) == {1: 1}


def test_rows_outside_the_window_are_not_written(spark):
    root, target = shared_folder(spark, "export"), place(spark, "folder")
    land(spark, root, visits(1, 2, 3))
    initial_pull(spark, root, target, 0, as_of=D(1))
    report = landing_page_report(scan_export(spark, root, D(3), 2))
    replace_days(report, target, [D(3)])
    assert per_day(spark, target) == {1: 1, 3: 1}


def test_days_the_export_does_not_hold_stay(spark, started):
    """History before the export, and days it has expired, lie inside the window."""
    target = started(day=3)
    pages = land_pages(spark, legacy_month("2024-01-01"), legacy_page(legacy_row(changed(DIMENSIONS, p0="20240102")), window="2024-01-01", token="1"))
    backfill(spark, target, pages, "2024-01-01", one_page_per_file=False)
    before = per_day(spark, target)
    assert sorted(before) == [1, 2, 3, 4]
    root = shared_folder(spark, "export")
    land(spark, root, visits(4, 5, pages=2))  # the third has expired
    daily_pull(spark, root, target, 7, as_of=D(5))
    assert per_day(spark, target) == before | {4: 2, 5: 2}


@pytest.mark.parametrize("wrong", [{"table_prefix": "evnts_"}, {"as_of": D(25)}, {"export_root": "/nowhere/at/all"}])
def test_a_pull_that_finds_nothing_changes_nothing(spark, wrong):
    root, target = shared_folder(spark, "export"), place(spark, "folder")
    land(spark, root, visits(1, 2))
    initial_pull(spark, root, target, 1, as_of=D(2))
    with pytest.raises(ValueError):
        daily_pull(spark, **{"export_root": root, "target": target, "prior_days": 3, "as_of": D(2)} | wrong)
    assert per_day(spark, target) == {1: 1, 2: 1}


def test_bad_suffix_and_label_reach_the_jobs(spark):
    root, target = shared_folder(spark, "shards"), place(spark, "folder")
    bare = event(params=session_params(7), at=9, day="20240102")
    export(spark, bare).write.parquet(f"{root}/events_20240102")
    export(spark, *visits(2)).write.parquet(f"{root}/events_intraday_20240102")
    options = {"as_of": D(2), "table_prefix": "events_", "build": partial(landing_page_report, landing_page_unset="(none)")}
    with pytest.raises(ValueError, match="intraday"):
        initial_pull(spark, root, target, 0, **options)
    initial_pull(spark, root, target, 0, on_bad_suffix="skip", **options)
    daily_pull(spark, root, target, 0, on_bad_suffix="skip", **options)
    assert [r["landing_page"] for r in read_target(spark, target).collect()] == ["(none)"]


def test_a_session_keeps_its_settings_and_staging_goes_away(spark):
    root, target = shared_folder(spark, "export"), place(spark, "table")
    land(spark, root, visits(1, 2))
    initial_pull(spark, root, target, 1, as_of=D(2))
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    daily_pull(spark, root, target, 1, as_of=D(2))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    broken = landing_page_report(scan_export(spark, root, D(2), 1)).withColumn("users", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        replace_days(broken, target, [D(2)])
    assert per_day(spark, target) == {1: 1, 2: 1}
    folder = spark.conf.get("spark.checkpoint.dir") + "/trafficloom"
    assert [n for n in child_names(spark, folder) if n.startswith(("staging", "legacy"))] == []


def test_daily_steps_equal_one_pull(spark):
    root = shared_folder(spark, "export")
    land(spark, root, visits(1, 2, 3, 4, pages=3) + visits(2, 4, user=None))
    at_once, stepped = place(spark, "folder"), place(spark, "folder")
    initial_pull(spark, root, at_once, 3, as_of=D(4))
    initial_pull(spark, root, stepped, 0, as_of=D(1))
    for day in (2, 3, 4):
        daily_pull(spark, root, stepped, 1, as_of=D(day))
    left, right = read_target(spark, at_once), read_target(spark, stepped)
    assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0


def test_initial_pull_in_several_commits(spark):
    root = shared_folder(spark, "export")
    land(spark, root, visits(1, 2, 3, 5, pages=2) + visits(2, 3, user=None))
    at_once, stepped = place(spark, "folder"), place(spark, "table")
    initial_pull(spark, root, at_once, 6, as_of=D(6))
    initial_pull(spark, root, stepped, 6, as_of=D(6), days_per_commit=2)
    left, right = read_target(spark, at_once), read_target(spark, stepped)
    assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0


def test_split_days():
    assert split_days(D(1), D(5), 2) == [(D(4), D(5)), (D(2), D(3)), (D(1), D(1))]
    assert split_days(D(1), D(5), 9) == [(D(1), D(5))]
    with pytest.raises(ValueError):
        split_days(D(1), D(5), 0)


def test_source_medium_target(spark):
    root, target = shared_folder(spark, "export"), place(spark, "folder")
    land(spark, root, visits(1, 2))
    options = {"build": acquisition_report, "schema": SOURCE_MEDIUM}
    initial_pull(spark, root, target, 0, as_of=D(1), **options)
    daily_pull(spark, root, target, 0, as_of=D(2), **options)
    assert per_day(spark, target, SOURCE_MEDIUM) == {1: 1, 2: 1}


def test_review(spark):
    root = shared_folder(spark, "export")
    land(spark, root, visits(1, 2, 3))
    report = landing_page_report(scan_export(spark, root, D(3), 2))
    assert [r["date"] for r in review(report, 2).collect()] == [D(3), D(2)]
    (month,) = review_months(report).collect()
    assert (month["report_rows"], month["first_day"], month["last_day"], month["sessions"]) == (3, D(1), D(3), 3)


# backfill

def legacy_month(day, rows=1, **options):
    dimensions = changed(DIMENSIONS, p0=day.replace("-", ""))
    window = options.pop("window", day[:8] + "01")
    return legacy_page(*(legacy_row(dimensions, METRICS) for _ in range(rows)), window=window, **options)


def land_pages(spark, *pages):
    root = shared_folder(spark, "pages")
    landed(spark, *pages).write.partitionBy("window_start").json(root)
    return root


def months(spark, target):
    grouped = read_target(spark, target).groupBy(F.date_format("date", "yyyy-MM")).count()
    return {r[0]: r[1] for r in grouped.collect()}


@pytest.fixture
def started(spark):
    def start(kind="folder", day=10):
        root, target = shared_folder(spark, "export"), place(spark, kind)
        land(spark, root, visits(day, day + 1))
        initial_pull(spark, root, target, 1, as_of=D(day + 1))
        return target

    return start


@pytest.mark.parametrize("kind", ["folder", "table"])
def test_backfill_stops_the_day_before_the_target(spark, started, kind):
    target = started(kind)
    pages = land_pages(
        spark,
        legacy_month("2024-01-09"), legacy_month("2024-01-10", token="1"),
        legacy_month("2023-12-31", rows=3), legacy_month("2023-11-14", token="1"), legacy_month("2023-11-15"),
    )
    log = {"log_folder": shared_folder(spark, "log")} if kind == "table" else {}
    load = lambda: backfill(spark, target, pages, "2023-11-15", one_page_per_file=False, **log)
    assert load() == [(D(1), D(9)), (D(1, 12, 2023), D(31, 12, 2023)), (D(15, 11, 2023), D(30, 11, 2023))]
    assert months(spark, target) == {"2024-01": 3, "2023-12": 3, "2023-11": 1}
    assert backfill_bound(read_target(spark, target)).first()["bound"] == D(14, 11, 2023)
    assert load() == []
    assert months(spark, target) == {"2024-01": 3, "2023-12": 3, "2023-11": 1}


def test_backfill_in_two_parts_equals_one(spark, started):
    pages = land_pages(spark, *(legacy_month(f"2023-{m}-01", rows=2) for m in (10, 11, 12)), legacy_month("2024-01-02"))
    whole, parts = started(), started()
    backfill(spark, whole, pages, "2023-10-01", one_page_per_file=False)
    backfill(spark, parts, pages, "2023-12-01", one_page_per_file=False)
    backfill(spark, parts, pages, "2023-10-01", one_page_per_file=False)
    left, right = read_target(spark, whole), read_target(spark, parts)
    assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0
    assert left.count() == 9


def test_backfill_resumes_after_a_failed_month(spark, started):
    bad = changed(METRICS, p0="1,234")
    pages = [legacy_month("2024-01-02"), legacy_month("2023-12-05")]
    broken = legacy_page(legacy_row(changed(DIMENSIONS, p0="20231105"), bad), window="2023-11-01")
    target = started()
    with pytest.raises(Exception, match="not a bigint"):
        backfill(spark, target, land_pages(spark, *pages, broken), "2023-11-01", one_page_per_file=False)
    assert months(spark, target) == {"2024-01": 3, "2023-12": 1}
    fixed = land_pages(spark, *pages, legacy_month("2023-11-05"))
    resumed = backfill(spark, target, fixed, "2023-11-01", one_page_per_file=False)
    assert resumed == [(D(1, 11, 2023), D(30, 11, 2023))]
    assert months(spark, target) == {"2024-01": 3, "2023-12": 1, "2023-11": 1}


def test_a_month_committed_by_half_is_done_again(spark, started):
    """The driver died while December's files were moved: some of its days are in place."""
    pages = land_pages(spark, *(legacy_month(f"2023-12-{d:02d}", token=None if d == 1 else "1") for d in (1, 9, 20)), legacy_month("2024-01-02"))
    whole, halfway = started(), started()
    backfill(spark, whole, pages, "2023-12-01", one_page_per_file=False)
    backfill(spark, halfway, pages, "2024-01-01", one_page_per_file=False)
    append_days(read_target(spark, whole).filter("date IN (DATE '2023-12-09', DATE '2023-12-20')"), halfway)
    resumed = backfill(spark, halfway, pages, "2023-12-01", one_page_per_file=False)
    assert resumed == [(D(1, 12, 2023), D(31, 12, 2023))]
    left, right = read_target(spark, whole), read_target(spark, halfway)
    assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0


def test_unreadable_metrics_and_time_on_page(spark, started):
    bad = legacy_row(changed(DIMENSIONS, p0="20231105"), changed(METRICS, p0="1,234"))
    pages = land_pages(spark, legacy_page(bad, legacy_row(changed(DIMENSIONS, p0="20231106"), METRICS), window="2023-11-01"))
    load = lambda target, **options: backfill(
        spark, target, pages, "2023-11-01", one_page_per_file=False, missing_months="skip", **options
    )
    set_aside, lenient = started(), started()
    quarantine = shared_folder(spark, "quarantine")
    load(set_aside, quarantine=quarantine, time_on_page="per_session")
    assert months(spark, set_aside) == {"2024-01": 2, "2023-11": 1}
    kept = spark.read.json(quarantine).collect()
    assert [(r["ga:date"], r["window_start"]) for r in kept] == [("20231105", D(1, 11, 2023))]
    load(lenient, lenient=True)
    assert months(spark, lenient) == {"2024-01": 2, "2023-11": 2}
    ratio = lambda t: read_target(spark, t).filter("date = DATE '2023-11-06'").first()[RATIO_METRIC]
    assert ratio(lenient) != ratio(set_aside)


def test_a_table_needs_a_folder_for_the_log(spark, started):
    with pytest.raises(ValueError, match="log"):
        backfill(spark, started("table"), "/nowhere", "2023-12-01")


def test_backfill_needs_every_window_complete(spark, started):
    target = started()
    cut = land_pages(spark, legacy_month("2024-01-02", token="1"))
    with pytest.raises(ValueError, match="last page"):
        backfill(spark, target, cut, "2024-01-01", one_page_per_file=False)
    gap = land_pages(spark, legacy_month("2024-01-02"))
    with pytest.raises(ValueError, match="2023-12-01"):
        backfill(spark, target, gap, "2023-12-01", one_page_per_file=False)
    empty = land_pages(spark, legacy_month("2024-01-02"), legacy_page(window="2023-12-01"))
    assert len(backfill(spark, target, empty, "2023-12-01", one_page_per_file=False)) == 2
    assert months(spark, target) == {"2024-01": 3}


def page_files(spark, root):
    names = [row[0] for row in spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(root).select("path").collect()]
    return [Path(n.removeprefix("file:")) for n in names]


def land_files(spark, *pages):
    """A file per page."""
    root = shared_folder(spark, "pages")
    landed(spark, *pages).repartition(len(pages), "window_start").write.partitionBy("window_start").json(root)
    return root


@pytest.mark.parametrize("harm", ["cut", "error", "emptied"])
def test_a_month_with_an_unreadable_page_is_not_loaded(spark, started, harm):
    target = started()
    root = land_files(spark, legacy_month("2024-01-02", rows=2), legacy_month("2023-12-05", rows=3), legacy_month("2023-11-05"))
    (december,) = [f for f in page_files(spark, root) if "2023-12-01" in str(f)]
    whole = december.read_text()
    harmed = {"cut": whole[: len(whole) // 2], "error": '{"error": {"code": 503}}', "emptied": ""}[harm]
    december.with_name(f".{december.name}.crc").unlink(missing_ok=True)
    december.write_text(harmed)
    aside = shared_folder(spark, "aside")
    load = partial(backfill, spark, target, root, "2023-11-01", quarantine=aside)
    with pytest.raises(ValueError, match="unreadable pages for .'2023-12-01'.$"):
        load()
    assert months(spark, target) == {"2024-01": 2}
    assert [w[0] for w in load(broken_months="skip")] == [D(1), D(1, 11, 2023)]
    assert months(spark, target) == {"2024-01": 4, "2023-11": 1}
    kept = spark.read.json(f"{aside}/unreadable").collect()
    assert [str(r["window_start"]) for r in kept] == ["2023-12-01"]
    assert kept[0]["unreadable"].strip() == harmed if harm == "cut" else kept[0]["unreadable"]
    december.write_text(whole)
    assert [w[0] for w in load()] == [D(1, 12, 2023)]
    assert months(spark, target) == {"2024-01": 4, "2023-12": 3, "2023-11": 1}
    assert load() == []


def test_a_month_that_was_skipped_is_loaded_once_it_lands(spark, started):
    target = started()
    first = land_pages(spark, legacy_month("2024-01-02"))
    load = lambda root, **options: backfill(spark, target, root, "2023-12-01", one_page_per_file=False, **options)
    assert [w[0] for w in load(first, missing_months="skip")] == [D(1)]
    both = land_pages(spark, legacy_month("2024-01-02"), legacy_month("2023-12-05", rows=3))
    assert [w[0] for w in load(both)] == [D(1, 12, 2023)]
    assert months(spark, target) == {"2024-01": 3, "2023-12": 3}


def test_one_backfill_at_a_time(spark, started):
    target = started()
    pages = land_pages(spark, legacy_month("2024-01-02"))
    load = partial(backfill, spark, target, pages, "2024-01-01", one_page_per_file=False)
    log = BackfillLog(spark, target)
    with log.lease():
        with pytest.raises(RuntimeError, match="another backfill"):
            load()
        with pytest.raises(RuntimeError), log.lease():
            pass
        assert months(spark, target) == {"2024-01": 2}
    assert len(load()) == 1 and load() == []
    assert create_file(spark, f"{target}/_backfill/lease")  # as a killed run leaves it
    with pytest.raises(RuntimeError, match="break_lease"):
        load()
    assert load(break_lease=True) == []
    assert months(spark, target) == {"2024-01": 3}


def test_a_failed_backfill_gives_the_lease_back(spark, started):
    target = started()
    with pytest.raises(ValueError, match="last page"):
        backfill(spark, target, land_pages(spark, legacy_month("2024-01-02", token="1")), "2024-01-01", one_page_per_file=False)
    assert len(backfill(spark, target, land_pages(spark, legacy_month("2024-01-02")), "2024-01-01", one_page_per_file=False)) == 1


def test_two_logged_bounds_are_an_error(spark, started):
    target = started()
    for day in ("2024-01-09", "2024-01-08"):
        make_folder(spark, f"{target}/_backfill/until={day}")
    with pytest.raises(ValueError, match="several last days"):
        backfill(spark, target, land_pages(spark, legacy_month("2024-01-02")), "2024-01-01", one_page_per_file=False)


def test_backfill_of_an_empty_target_fails(spark):
    target = place(spark, "folder")
    create_target(spark.createDataFrame([], TARGET), target)
    with pytest.raises(ValueError, match="no rows"):
        backfill(spark, target, land_pages(spark, legacy_page()), "2023-10-01", one_page_per_file=False)


# files that land over time

def test_consecutive_days():
    assert consecutive([D(3), D(1), D(2), D(7)]) == [(D(1), D(3)), (D(7), D(7))]
    assert consecutive([]) == []


def test_new_days_are_pulled_once_and_late_files_again(spark):
    root, target, state = (shared_folder(spark, kind) for kind in ("export", "target", "state"))
    pull = lambda: pull_new_days(spark, root, target, state)
    land(spark, root, visits(1, 2, 5))
    pull()
    assert per_day(spark, target) == {1: 1, 2: 1, 5: 1}
    land(spark, root, visits(2, pages=4, user="late") + visits(6))
    pull()
    assert per_day(spark, target) == {1: 1, 2: 5, 5: 1, 6: 1}
    pull()
    batch = landing_page_report(scan_export(spark, root, D(6), 10))
    left = read_target(spark, target)
    assert left.exceptAll(batch).count() == batch.exceptAll(left).count() == 0


def test_a_first_batch_that_died_is_retried(spark):
    root, target, state = (shared_folder(spark, kind) for kind in ("export", "target", "state"))
    land(spark, root, visits(1, 2, 3, 4))
    make_folder(spark, f"{target}/_temporary/0")  # what a dead first write leaves
    pull_new_days(spark, root, target, state, days_per_commit=2)
    assert per_day(spark, target) == {1: 1, 2: 1, 3: 1, 4: 1}


# commands

def test_commands(spark, capsys):
    root, target = shared_folder(spark, "export"), place(spark, "folder")
    land(spark, root, visits(1, 2, 3))
    few = ["--shuffle-partitions", "2"]
    main(["create", *few, "--export", root, "--target", target, "--prior-days", "1", "--as-of", "2024-01-02"])
    main(["daily", *few, "--export", root, "--target", target, "--as-of", "2024-01-03"])
    assert per_day(spark, target) == {1: 1, 2: 1, 3: 1}
    pages = land_pages(spark, legacy_month("2023-12-05"))
    main(["backfill", *few, "--landed", pages, "--target", target, "--start", "2023-12-01", "--json-lines"])
    main(["review", *few, "--target", target])
    printed = capsys.readouterr().out
    assert "1 months loaded" in printed and "2023-12-05" in printed and "2024-01-03" in printed
    other, state = place(spark, "folder"), shared_folder(spark, "state")
    main(["follow", *few, "--export", root, "--target", other, "--state", state, "--report", "source-medium"])
    assert per_day(spark, other, SOURCE_MEDIUM) == {1: 1, 2: 1, 3: 1}
    with pytest.raises(SystemExit):
        main(["daily", *few, "--target", target])
