import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.builders import DIMENSIONS, METRICS, changed, landed, legacy_page, legacy_row
from trafficloom.functions.dates import days_ago, iso_date, iso_day_or_null
from trafficloom.operators.legacy import (
    backfill_bound,
    flatten_report_pages,
    month_windows,
    normalize_legacy,
    split_bad_metrics,
)
from trafficloom.schemas import TARGET, legacy_metric_names
from trafficloom.session import shared_folder
from trafficloom.sources.report_pages import last_pages, read_report_pages, stage_report_pages

day = dt.date.fromisoformat


def flatten(spark, *rows, goal="ga:goalCompletionsAll", **options):
    return flatten_report_pages(landed(spark, legacy_page(*rows, goal=goal, **options)), goal)


def test_values_pair_with_headers(spark):
    row = flatten(spark, legacy_row()).first().asDict()
    assert row["ga:landingPagePath"] == "/a" and row["ga:pageviews"] == "9" and row["ga:transactions"] == "1"


def test_header_order_comes_from_the_page(spark):
    page = legacy_page(legacy_row(DIMENSIONS, METRICS[::-1]), metrics=legacy_metric_names()[::-1])
    row = flatten_report_pages(landed(spark, page)).first().asDict()
    assert row["ga:users"] == "3" and row["ga:transactions"] == "1" and row["ga:timeOnPage"] == "12.5"


def test_short_value_lists_leave_nulls(spark):
    row = flatten(spark, legacy_row(DIMENSIONS[:7], METRICS[:3])).first().asDict()
    assert row["ga:source"] == "google" and row["ga:medium"] is None
    assert row["ga:entrances"] == "2" and row["ga:sessions"] is None


def test_last_date_range_wins(spark):
    second = changed(METRICS, p0="30", p3="40")
    row = flatten(spark, legacy_row(DIMENSIONS, METRICS, second)).first().asDict()
    assert (row["ga:users"], row["ga:sessions"], row["ga:transactions"]) == ("30", "40", "1")
    short = flatten(spark, legacy_row(DIMENSIONS, METRICS, second[:1])).first().asDict()
    assert (short["ga:users"], short["ga:sessions"]) == ("30", "4")


def test_missing_header_fails(spark):
    page = legacy_page(legacy_row(), metrics=legacy_metric_names()[:-1])
    with pytest.raises(PySparkException, match="ga:transactions"):
        flatten_report_pages(landed(spark, page)).collect()
    lenient = flatten_report_pages(landed(spark, page), strict=False)
    assert lenient.first()["ga:transactions"] is None


def test_responses_without_reports_or_rows(spark):
    nothing = (None, day("2023-10-01"))
    no_rows = ([((["ga:date"], ([("ga:users",)],)), None, None)], day("2023-10-01"))
    assert flatten_report_pages(landed(spark, nothing, no_rows, legacy_page())).count() == 0


def test_empty_month_is_an_empty_append(spark):
    empty = normalize_legacy(flatten(spark))
    assert empty.count() == 0 and empty.columns == TARGET.fieldNames()


def test_metrics_get_their_declared_types(spark):
    row = normalize_legacy(flatten(spark, legacy_row(DIMENSIONS, changed(METRICS, p0="3.0", p8="7")))).first()
    assert (row["users"], row["ecommerce_revenue"], row["engagment_time_sec_per_session"]) == (3, 7.0, 12.5)
    assert row["date"] == day("2023-10-05")


@pytest.mark.parametrize("position, bad", [(0, "1,234"), (0, "3.5"), (8, "1,234"), (8, "x"), (3, "")])
def test_unreadable_metrics_fail_or_are_set_aside(spark, position, bad):
    rows = flatten(spark, legacy_row(DIMENSIONS, changed(METRICS, **{f"p{position}": bad})), legacy_row())
    with pytest.raises(PySparkException):
        normalize_legacy(rows).collect()
    good, aside = split_bad_metrics(rows)
    assert normalize_legacy(good).count() == 1 and aside.count() == 1
    assert bad in tuple(aside.first())


@pytest.mark.parametrize(
    "host, path, expected",
    [
        ("h", "/a", "https://h/a"),
        ("h", "(not set)", "(not set)"),
        ("h", "(not set", "https://h(not set"),
        (None, "/a", None),
        (None, "(not set)", "(not set)"),
    ],
)
def test_landing_page(spark, host, path, expected):
    rows = flatten(spark, legacy_row(changed(DIMENSIONS, p1=host, p2=path)))
    assert normalize_legacy(rows).first()["landing_page"] == expected


@pytest.mark.parametrize("goal, value", [("ga:users", 3), ("ga:transactions", 1), ("ga:goal1Completions", 1)])
def test_goal_may_be_any_metric(spark, goal, value):
    row = normalize_legacy(flatten(spark, legacy_row(), goal=goal), goal).first()
    assert row["conversions"] == value
    assert (row["users"], row["ecommerce_transactions"]) == (3, 1)


def test_goal_equal_to_a_pulled_metric_reads_that_metric(spark):
    # a pull lists the goal twice then; both positions carry the same value
    metrics = changed(METRICS, p7="3")
    row = normalize_legacy(flatten(spark, legacy_row(DIMENSIONS, metrics), goal="ga:users"), "ga:users").first()
    assert (row["users"], row["conversions"]) == (3, 3)


def test_time_on_page_is_a_total_unless_divided(spark):
    rows = flatten(spark, legacy_row(), legacy_row(DIMENSIONS, changed(METRICS, p3="0")))
    column = "engagment_time_sec_per_session"
    assert [r[column] for r in normalize_legacy(rows).collect()] == [12.5, 12.5]
    divided = normalize_legacy(rows, time_on_page="per_session").collect()
    assert sorted((r[column] for r in divided), key=str) == [3.13, None]


def windows(spark, begin, end):
    return [tuple(map(str, w)) for w in month_windows(spark, begin, day(end)).collect()]


def test_month_windows(spark):
    assert windows(spark, "2023-10-01", "2023-12-31") == [
        ("2023-12-01", "2023-12-31"), ("2023-11-01", "2023-11-30"), ("2023-10-01", "2023-10-31"),
    ]
    assert windows(spark, "2021-11-15", "2022-02-10") == [
        ("2022-02-01", "2022-02-10"), ("2022-01-01", "2022-01-31"),
        ("2021-12-01", "2021-12-31"), ("2021-11-15", "2021-11-30"),
    ]
    assert windows(spark, "2024-02-05", "2024-02-20") == [("2024-02-05", "2024-02-20")]
    assert windows(spark, "2024-02-05", "2024-02-05") == [("2024-02-05", "2024-02-05")]
    assert windows(spark, "2024-02-05", "2024-02-04") == []
    assert windows(spark, "2024-03-05", "2024-01-04") == []


def test_backfill_bound(spark):
    frame = spark.createDataFrame([(day("2024-01-05"),), (day("2024-01-01"),)], "date date")
    assert backfill_bound(frame).first()["bound"] == day("2023-12-31")
    assert backfill_bound(frame.limit(0)).first()["bound"] is None


def test_last_pages(spark):
    pages = landed(
        spark,
        legacy_page(token="1"), legacy_page(),
        legacy_page(window="2023-11-01"), legacy_page(window="2023-11-01"),
        legacy_page(window="2023-12-01", token="1"),
    )
    staged = stage_report_pages(pages, shared_folder(spark, "staged"))
    found = {str(r["window_start"]): (r["pages"], r["last_pages"], r["unreadable_pages"]) for r in last_pages(staged).collect()}
    assert found == {"2023-10-01": (2, 1, 0), "2023-11-01": (2, 2, 0), "2023-12-01": (1, 0, 0)}


def test_token_of_the_last_report_counts(spark):
    (first,), window = legacy_page(token="7")
    (last,), _ = legacy_page()
    pages = landed(spark, ([first, last], window))
    assert last_pages(stage_report_pages(pages, shared_folder(spark, "staged"))).first()["last_pages"] == 1


def test_landed_files(spark, tmp_path):
    response = {
        "reports": [
            {
                "columnHeader": {
                    "dimensions": list(flatten(spark).columns[:9]),
                    "metricHeader": {"metricHeaderEntries": [{"name": m, "type": "X"} for m in legacy_metric_names()]},
                },
                "data": {"rows": [{"dimensions": DIMENSIONS, "metrics": [{"values": METRICS}]}], "rowCount": 1},
            }
        ],
        "queryCost": 1,
    }
    for window, pages in {"2023-10-01": 2, "2023-11-01": 1}.items():
        folder = tmp_path / f"window_start={window}"
        folder.mkdir()
        for n in range(pages):
            (folder / f"{n}.json").write_text(json.dumps(response, indent=1))
    pages = read_report_pages(spark, str(tmp_path))
    assert normalize_legacy(flatten_report_pages(pages)).count() == 3
    october = pages.filter(F.col("window_start") == F.lit(day("2023-10-01")))
    assert flatten_report_pages(october).count() == 2
    plan = october._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_start" in plan


def test_iso_dates(spark):
    assert iso_date("2022-02-28") == iso_date(day("2022-02-28")) == day("2022-02-28")
    for bad in ("2022-2-28", "20220228", "2022-13-01", "2022-02-31", "2022-02-28 ", "x"):
        with pytest.raises(ValueError):
            iso_date(bad)
    assert days_ago(91, day("2024-01-31")) == days_ago(-91, day("2024-01-31")) == day("2023-11-01")
    texts = spark.createDataFrame([("2022-02-28",), ("2022-02-31",), ("2022-2-28",), (None,)], "t string")
    assert [r[0] for r in texts.select(iso_day_or_null(F.col("t"))).collect()] == [day("2022-02-28"), None, None, None]
