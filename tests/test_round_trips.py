"""Shards without a day column, reports as SQL text, totals of a write, and page sketches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.builders import event, export, param, session_params
from tests.test_jobs import D, land, place, visits
from tests.test_report_query import ALL_DAYS
from trafficloom.operators.report_query import DISTINCT_PAGES, ReportQuery
from trafficloom.operators.reports import landing_report
from trafficloom.plans.jobs import daily_pull, initial_pull
from trafficloom.plans.reports import acquisition_report, landing_flat, landing_page_report, landing_sessions
from trafficloom.plans.sql_reports import LANDING_SQL, SOURCE_MEDIUM_SQL, report_by_sql
from trafficloom.schemas import TARGET, TARGET_WITH_PAGES
from trafficloom.session import shared_folder
from trafficloom.sinks.target import DayTotals, create_target, read_target
from trafficloom.sources.export import scan_export


def same(left, right):
    assert left.columns == right.columns
    assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0


# shards

@pytest.mark.parametrize("folder", ["shards", "20240109"])
def test_the_day_of_a_shard_comes_from_its_name(spark, folder):
    root = f"{shared_folder(spark, 'export')}/{folder}"
    for day in (1, 2, 3):
        shard = export(spark, *visits(day, pages=day)).drop("event_date").coalesce(1)
        shard.write.parquet(f"{root}/events_2024010{day}")
    scan = scan_export(spark, root, D(3), 1, table_prefix="events_", day_from_name=True)
    assert {r["event_date"]: r["count"] for r in scan.groupBy("event_date").count().collect()} == {"20240102": 2, "20240103": 3}
    bare = scan_export(spark, root, D(3), 1, table_prefix="events_")
    assert bare.filter("event_date IS NOT NULL").count() == 0


def test_pulls_from_shards_without_a_day_column(spark):
    root, target = shared_folder(spark, "shards"), place(spark, "folder")
    for day in (1, 2, 3):
        export(spark, *visits(day, pages=day)).drop("event_date").write.parquet(f"{root}/events_2024010{day}")
    options = {"table_prefix": "events_", "day_from_name": True}
    initial_pull(spark, root, target, 1, as_of=D(2), **options)
    daily_pull(spark, root, target, 1, as_of=D(3), **options)
    rows = read_target(spark, target).groupBy("date").agg(F.sum("page_views")).collect()
    assert {r[0].day: r[1] for r in rows} == {1: 1, 2: 2, 3: 3}


# SQL text

def odd_events():
    page = session_params(1, "https://x/a")
    return [
        event("session_start", page, user=None),
        event("page_view", [*page, param("page_location", "https://x/b"), param("source", "s"), param("medium", None)]),
        event("page_view", page, transaction="t1", revenue=1.25),
        event("purchase", page, transaction="t1", revenue=2.5, source="a", medium=""),
        event("purchase", page, transaction="t1", revenue=2.5, source="a", medium=""),
        event("purchase", page, at=5, transaction="t1", revenue=2.5),
        event("refund", session_params(2, None), at=6, transaction="t2", country="", region=None, city=None),
        event("first_visit", [param("engagement_time_msec", number=1500), param("engagement_time_msec", number=700)], at=7),
        event("page_view", [], at=8),
        event("page_view", None, at=9),
        event("page_view", session_params(None, "https://x/c"), at=10, day="20240102"),
        event("page_view", session_params(3, ""), at=11, day="20231231"),
        event("page_view", page, at=12, day="20240105"),
    ]


@pytest.mark.parametrize("conversion", ["purchase", None, "o'brien"])
def test_sql_reports_equal_the_dataframe_form(spark, conversion):
    events = export(spark, *odd_events())
    events.createOrReplaceTempView("odd_events")
    window = events.filter(F.col("event_date").between("20231231", "20240102"))
    for text, build in ((LANDING_SQL, landing_page_report), (SOURCE_MEDIUM_SQL, acquisition_report)):
        found = report_by_sql(spark, text, "odd_events", 2, conversion, D(2))
        assert found.count() > 1
        same(found, build(window, conversion))
    label = report_by_sql(spark, LANDING_SQL, "odd_events", 2, conversion, D(2), landing_page_unset="zzz")
    same(label, landing_page_report(window, conversion, landing_page_unset="zzz"))


def test_sql_over_a_partitioned_table_prunes(spark):
    root = shared_folder(spark, "export")
    land(spark, root, visits(1, 2, 3))
    spark.read.option("basePath", root).schema(export(spark).schema).parquet(root).createOrReplaceTempView("landed_events")
    found = report_by_sql(spark, SOURCE_MEDIUM_SQL, "landed_events", 0, None, D(2))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert not any(node in plan for node in ("Expand", "Cartesian", "NestedLoop"))
    assert found.select("date").distinct().collect() == [(D(2),)]


# totals

@pytest.mark.parametrize("kind", ["folder", "table"])
def test_a_pull_tells_what_it_wrote(spark, kind):
    root, target = shared_folder(spark, "export"), place(spark, kind)
    land(spark, root, visits(1, 2, 4, pages=2) + visits(2, user="u2"))
    first = initial_pull(spark, root, target, 3, as_of=D(3))
    assert [(t.date, t.report_rows, t.users, t.page_views) for t in first] == [(D(1), 1, 1, 2), (D(2), 1, 2, 3)]
    land(spark, root, visits(2, 4, pages=3), mode="overwrite")
    again = daily_pull(spark, root, target, 3, as_of=D(4), days_per_commit=2)
    assert [(t.date, t.page_views) for t in again] == [(D(1), 2), (D(2), 3), (D(4), 3)]
    assert sum(t.page_views for t in again) == read_target(spark, target).agg(F.sum("page_views")).first()[0]


def test_totals_of_many_days_and_of_days_without_rows(spark, monkeypatch):
    monkeypatch.setattr(DayTotals, "AT_ONCE", 3)
    events = export(spark, *visits(*range(1, 9)))
    totals = DayTotals(dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(11))
    create_target(landing_page_report(events), place(spark, "folder"), TARGET, totals)
    assert len(totals.observed) == 4
    found = totals.totals()
    assert [t.report_rows for t in found] == [1] * 8 + [0] * 3 and found[-1].ecommerce_revenue == 0.0


# page sketches

def test_distinct_pages_over_days(spark):
    events = export(spark, *visits(1, 2, 3, pages=5), *visits(4, pages=9, user="u2"), event("session_start", session_params(9), at=7, day="20240105"))
    target = place(spark, "folder")
    report = landing_page_report(events, sketch_pages=True)
    same(report.drop("page_sketch"), landing_page_report(events))
    create_target(report, target, TARGET_WITH_PAGES)
    stored = read_target(spark, target, TARGET_WITH_PAGES)
    query = ReportQuery(stored).date_range(ALL_DAYS).metrics(["ga:uniquePageviews", DISTINCT_PAGES])
    assert [tuple(r) for r in query.get().rows.collect()] == [(24, 9)]
    daily = query.dimensions(["date"]).get().rows.orderBy("date").collect()
    assert [r[DISTINCT_PAGES] for r in daily] == [5, 5, 5, 9, 0]
    with pytest.raises(ValueError, match="unknown"):
        ReportQuery(stored.drop("page_sketch")).metrics([DISTINCT_PAGES]).get()


def test_error_of_many_distinct_pages(spark):
    """Measured: sketches of four thousand cells are within some percent."""
    pages = [(D(1 + d), f"u{d}", f"https://x/{(p * 7 + d * 1000) % 9000}") for d in range(4) for p in range(4000)]
    flat = landing_flat(export(spark, event("page_view", session_params(1, "https://x/y")))).limit(0)
    frame = spark.createDataFrame(pages, "event_date date, user_pseudo_id string, pageview_location string")
    flat = flat.unionByName(frame.withColumn("ga_session_id", F.lit(1).cast("long")), allowMissingColumns=True)
    report = landing_report(landing_sessions(flat, sketch_pages=True))
    found = ReportQuery(report).date_range(ALL_DAYS).metrics([DISTINCT_PAGES]).get().rows.first()[0]
    exact = len({p for _, _, p in pages})
    assert abs(found - exact) < 0.05 * exact
