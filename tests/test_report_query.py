import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.builders import event, export, session_params
from trafficloom.operators.report_query import ReportQuery, default_metrics, legacy_report
from trafficloom.schemas import LANDING_DIMENSIONS, LEGACY_METRICS, METRICS, RATIO_METRIC, TARGET

AS_OF = dt.date(2024, 1, 31)
ALL_DAYS = [("2023-01-01", "2024-12-31")]


def row(day="2024-01-10", page="/a", country="FR", source="google", medium="cpc", users=1, sessions=1, ratio=1.0, revenue=0.0):
    return (
        dt.date.fromisoformat(day), page, country, "R", "C", source, medium, "x",
        users, 0, 0, sessions, 0, 0, ratio, 0, revenue, 0,
    )


def table(spark, *rows):
    return spark.createDataFrame(list(rows), TARGET)


def values(report, *columns):
    return [tuple(r) for r in report.rows.select(*columns).collect()]


@pytest.fixture
def many(spark):
    pages = [None, "", "/a", "/b", "é", '"quoted"', "/c", "/d"]
    return table(spark, *(row(day=f"2024-01-{d:02d}", page=p, users=d) for d in range(1, 11) for p in pages))


def test_defaults(spark):
    days = ["2023-10-31", "2023-11-01", "2024-01-30", "2024-01-31"]
    report = ReportQuery(table(spark, *(row(day=d) for d in days)), as_of=AS_OF).get()
    assert report.rows.columns == ["users"] and values(report, "users") == [(2,)]


def test_every_method_returns_a_copy(spark):
    base = ReportQuery(table(spark, row()), as_of=AS_OF)
    changed = base.dimensions(["ga:country"]).metrics(["sessions"]).page_size(5).page_token("3")
    assert (base.chosen_dimensions, base.size, base.token) == ((), None, "0")
    assert (changed.chosen_dimensions, changed.size, changed.token) == (("ga:country",), 5, "3")
    assert changed.dimensions(["date"]).chosen_dimensions == ("date",)


def test_both_spellings_of_names(spark):
    query = ReportQuery(table(spark, row()), as_of=AS_OF)
    legacy = query.dimensions(["ga:landingPagePath", "ga:hostname", "ga:source"]).metrics(list(LEGACY_METRICS))
    assert legacy.get().rows.columns == ["landing_page", "utm_source", *METRICS]
    for bad in (query.dimensions(["ga:browser"]), query.metrics(["ga:bounces"])):
        with pytest.raises(ValueError, match="unknown"):
            bad.get()


def test_goal_metric_names_the_conversions(spark):
    query = ReportQuery(table(spark, row()), as_of=AS_OF, goal_metric="ga:goal1Completions")
    assert query.metrics(["ga:goal1Completions"]).get().rows.columns == ["conversions"]


def test_date_ranges_are_inclusive_and_may_overlap(spark):
    frame = table(spark, *(row(day=f"2024-01-{d:02d}", users=d) for d in (1, 2, 3, 4)))
    query = ReportQuery(frame, as_of=AS_OF)
    one = query.date_range([("2024-01-02", dt.date(2024, 1, 3))]).get()
    assert values(one, "users") == [(5,)] and "range_index" not in one.rows.columns
    two = query.date_range([("2024-01-01", "2024-01-03"), ("2024-01-03", "2024-01-04")]).get()
    assert sorted(values(two, "range_index", "users")) == [(0, 6), (1, 7)]
    for bad in ([("2024-1-1", "2024-01-02")], [("2024-02-31", "2024-03-01")], []):
        with pytest.raises(ValueError):
            query.date_range(bad)


def test_date_ranges_reach_the_scan(spark, tmp_path):
    folder = str(tmp_path / "target")
    table(spark, row(), row(day="2024-01-11")).write.partitionBy("date").parquet(folder)
    ranges = [("2024-01-11", "2024-01-11"), ("2024-01-20", "2024-01-21")]
    report = ReportQuery(spark.read.schema(TARGET).parquet(folder)).date_range(ranges).dimensions(["ga:country"]).get()
    scan = next(l for l in report.rows._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in l)
    assert "PartitionFilters: [((" in scan and "date" in scan.split("PartitionFilters")[1]
    assert "landing_page" not in scan.split("ReadSchema")[1]
    assert report.rows.count() == 1


def test_the_ratio_is_weighted_by_sessions(spark):
    frame = table(spark, row(sessions=1, ratio=10.0), row(sessions=3, ratio=2.0), row(sessions=0, ratio=None))
    query = ReportQuery(frame, as_of=AS_OF).metrics(["ga:timeOnPage"])
    assert values(query.get(), RATIO_METRIC) == [(4.0,)]
    empty = ReportQuery(table(spark, row(sessions=0, ratio=None)), as_of=AS_OF).metrics([RATIO_METRIC])
    assert values(empty.get(), RATIO_METRIC) == [(None,)]


def test_segments(spark):
    frame = table(spark, row(medium="cpc", users=1), row(medium="organic", users=2), row(medium="mail", users=4))
    filters = {"gaid::1": F.col("utm_medium") != "mail", "gaid::2": F.col("utm_medium") == "cpc"}
    query = ReportQuery(frame, as_of=AS_OF, segment_filters=filters)
    assert sorted(values(query.segment(["gaid::1", "gaid::2"]).get(), "segment", "users")) == [("gaid::1", 3), ("gaid::2", 1)]
    with pytest.raises(ValueError, match="gaid::3"):
        query.segment(["gaid::3"]).get()


def everything(many):
    query = ReportQuery(many).date_range(ALL_DAYS).dimensions(["ga:date", "landing_page"])
    ordered = query.get().rows.orderBy("date", "landing_page").collect()
    return query, [tuple(r) for r in ordered]


def test_pages_by_offset(many):
    query, rows = everything(many)
    page = query.page_size(7)
    for offset in (0, 7, 35, 77, 80, 500):
        assert values(page.page_token(str(offset)).get(), "*") == rows[offset : offset + 7]
    assert values(query.page_token("70").get(), "*") == rows[70:]


def test_an_offset_gathers_no_rows_before_it(many):
    query, _ = everything(many)
    plan = query.page_size(7).page_token("35").get().rows._jdf.queryExecution().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan


def test_rows_and_token_compute_the_report_once(many, spark):
    query, rows = everything(many)
    evaluated = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            evaluated.add(len(batch))
            yield batch

    counted = many.mapInPandas(seen, many.schema)
    report = ReportQuery(counted).date_range(ALL_DAYS).dimensions(["ga:date", "landing_page"]).page_size(10).get()
    assert values(report, "*") == rows[:10] and report.next_page_token() is not None
    assert evaluated.value == many.count()


def test_following_tokens_reads_everything_once(many):
    query, rows = everything(many)
    query, token, found, pages = query.page_size(33), "0", [], 0
    while token is not None:
        report = query.page_token(token).get()
        found += values(report, "*")
        token = report.next_page_token()
        pages += 1
    assert found == rows and pages == 3


def test_all_pages_from_one_copy(many):
    query, rows = everything(many)
    pages = [[tuple(r) for r in page.collect()] for page in query.page_size(33).get().pages()]
    assert [len(p) for p in pages] == [33, 33, 14] and sum(pages, []) == rows
    assert [p.count() for p in query.get().pages()] == [80]


def test_no_token_after_a_last_full_page(many):
    query, rows = everything(many)
    assert query.page_size(len(rows)).get().next_page_token() is None
    assert query.get().next_page_token() is None
    assert query.page_size(10).page_token("9999").get().next_page_token() is None


def test_tokens_belong_to_their_dimensions(many):
    query, _ = everything(many)
    token = query.page_size(5).get().next_page_token()
    with pytest.raises(ValueError, match="other dimensions"):
        query.dimensions(["ga:country"]).page_token(token).get().rows


def test_a_page_has_the_size_asked_for(spark):
    query = ReportQuery(table(spark, row()))
    assert query.page_size(10**9).size == 10**9
    with pytest.raises(ValueError):
        query.page_size(0)


def test_pages_larger_than_any_service_limit(spark):
    frame = spark.range(150_000).selectExpr("DATE '2024-01-05' AS date", "id AS kind", "id AS n")
    query = ReportQuery(frame, dimension_names=["date", "kind"], metric_exprs={"n": F.sum("n")}).date_range(ALL_DAYS)
    report = query.dimensions(["kind"]).metrics(["n"]).page_size(150_000).get()
    assert report.rows.count() == 150_000 and report.next_page_token() is None


def test_a_small_fraction_is_not_rounded_to_nothing(spark):
    frame = spark.range(200_000).selectExpr("DATE '2024-01-05' AS date", "id AS kind", "id AS n")
    query = ReportQuery(frame, dimension_names=["date", "kind"], metric_exprs={"n": F.count("n")}).date_range(ALL_DAYS)
    for fraction, least, most in ((1e-4, 5, 45), (4e-7, 0, 3)):
        found = query.metrics(["n"]).sampling_level("SMALL", fraction).get().rows.first()["n"]
        assert least <= found <= most
    plan = query.metrics(["n"]).sampling_level("SMALL", 4e-7).get().rows._jdf.queryExecution().toString()
    assert "4.0E-7" in plan


def test_all_pages_as_one_frame(many):
    query, rows = everything(many)
    found = query.page_size(33).get().paged().orderBy("page", "date", "landing_page").collect()
    assert [tuple(r)[:-1] for r in found] == rows
    assert [r["page"] for r in found] == [0] * 33 + [1] * 33 + [2] * 14
    later = [p.count() for p in query.page_size(33).page_token("33").get().pages()]
    assert later == [33, 14]


def test_sampling(many):
    query, rows = everything(many)
    assert sorted(values(query.sampling_level("LARGE", fraction=0.1).get(), "*"), key=str) == sorted(rows, key=str)
    sampled = query.sampling_level("SMALL", fraction=0.5, seed=3)
    once = sorted(values(sampled.get(), "*"), key=str)
    again = ReportQuery(many.repartition(5)).date_range(ALL_DAYS).dimensions(["ga:date", "landing_page"])
    assert sorted(values(again.sampling_level("SMALL", 0.5, 3).get(), "*"), key=str) == once
    assert 15 < len(once) < 65 and set(once) <= set(rows)
    for bad in (("HUGE", 1.0), ("SMALL", 0.0), ("SMALL", 2.0)):
        with pytest.raises(ValueError):
            query.sampling_level(*bad)


def test_legacy_preset(many):
    query = legacy_report(many, "2024-01-01", "2024-01-31")
    report = query.get()
    assert report.rows.columns == [*LANDING_DIMENSIONS, *METRICS] and report.rows.count() == 80
    assert query.size == 10_000 and report.next_page_token() is None


def test_other_tables(spark):
    frame = spark.createDataFrame([(dt.date(2024, 1, 1), "x", 2), (dt.date(2024, 1, 2), "x", 5)], "date date, kind string, n long")
    query = ReportQuery(frame, as_of=AS_OF, dimension_names=["date", "kind"], metric_exprs={"biggest": F.max("n")})
    report = query.dimensions(["kind"]).metrics(["biggest"]).get()
    assert values(report, "kind", "biggest") == [("x", 5)]


def test_metric_registry_covers_the_unified_table(spark):
    assert list(default_metrics()) == METRICS


def test_on_a_report_of_events(spark):
    from trafficloom.plans.reports import landing_page_report

    report = landing_page_report(export(spark, event(params=session_params(1, "p"))))
    assert values(ReportQuery(report).date_range(ALL_DAYS).get(), "users") == [(1,)]
