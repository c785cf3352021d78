"""Derive an event export and legacy report pages from the ``events`` and ``pages`` tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom.schemas import EXPORT, REPORT_PAGE, legacy_metric_names, LEGACY_DIMENSIONS

SAMPLE_START = dt.date(2023, 10, 1)  # first day of the mapping's legacy rows
HOUR = 3_600_000_000
PAGE_ROWS = 120


def _text(value: Column) -> Column:
    return value.cast("string")


def _prefixed(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), _text(value))


def _whole(value: Column | str, divisor: int) -> Column:
    return F.expr(f"({value}) div {divisor}")


def export_from_events(events: DataFrame) -> DataFrame:
    """One export row per event."""
    us = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"
    user, event, kind = F.col("user_id"), F.col("event_id"), F.col("event_type")
    null = F.lit(None).cast("string")
    k = F.get_json_object("props", "$.k").cast("bigint")

    def param(key, string_value=None, int_value=None, when=None):
        entry = F.struct(
            F.lit(key).alias("key"),
            F.struct(
                (null if string_value is None else string_value).alias("string_value"),
                (F.lit(None) if int_value is None else int_value).cast("bigint").alias("int_value"),
            ).alias("value"),
        )
        return entry if when is None else F.when(when, entry)

    fifth = event % 5 == 0
    entries = F.array(
        param("ga_session_id", int_value=_whole(us, 6 * HOUR), when=event % 17 != 0),
        param("ga_session_number", int_value=event % 9),
        param("session_engaged", _text(event % 2)),
        param("page_title", _prefixed("T", event % 6)),
        param("page_location", _prefixed("https://shop.example.com/p/", k % 7), when=event % 19 != 0),
        param("engagement_time_msec", int_value=(1 + event % 119) * 1000, when=event % 3 == 0),
        param(
            "source",
            F.when(event % 4 == 0, "google").when(event % 4 == 1, "bing").when(event % 4 == 2, "(direct)"),
            when=fifth,
        ),
        param("medium", F.when(event % 4 == 0, "cpc"), when=fifth),
        param("campaign", _prefixed("camp", event % 3), when=event % 10 == 0),
    )
    params = F.array_compact(entries)
    row = {
        "event_date": F.date_format("ts", "yyyyMMdd"),
        "event_timestamp": _whole(us, HOUR) * HOUR,
        "user_first_touch_timestamp": user * 1_000_000 + 1_700_000_000_000_000,
        "event_name": F.when(kind == "signup", "first_visit")
        .when(kind == "click", "session_start")
        .when(kind == "view", "page_view")
        .when(kind == "purchase", "purchase")
        .when(kind == "error", "user_engagement"),
        "user_pseudo_id": F.when(user % 29 != 0, _prefixed("u", user)),
        "device": F.struct(
            F.when(user % 3 == 0, "desktop").when(user % 3 == 1, "mobile").otherwise("tablet").alias("category"),
            F.lit("en-us").alias("language"),
            F.struct(F.lit("Chrome").alias("browser")).alias("web_info"),
        ),
        "geo": F.struct(
            F.when(user % 13 == 0, null).when(user % 13 == 1, "").otherwise(_prefixed("NATION_", user % 25)).alias("country"),
            F.when(user % 7 == 0, "").otherwise(_prefixed("R", user % 5)).alias("region"),
            F.when(user % 11 != 0, _prefixed("C", user % 40)).alias("city"),
        ),
        "traffic_source": F.struct(
            F.when(user % 4 != 0, _prefixed("s", user % 4)).alias("source"),
            F.when(user % 4 != 0, "organic").alias("medium"),
        ),
        "ecommerce": F.struct(
            F.when(kind.isin("purchase", "error"), _prefixed("t", event % 700)).alias("transaction_id"),
            F.when(kind == "purchase", F.col("value")).alias("purchase_revenue"),
        ),
        "event_params": F.when(event % 101 == 0, F.lit(None))
        .when(event % 97 == 0, F.slice(params, 1, 0))
        .otherwise(params),
    }
    return events.select(*(row[name].alias(name) for name in EXPORT.fieldNames()))


def legacy_rows_from_pages(pages: DataFrame, goal_metric: str, *keep: str) -> DataFrame:
    """The strings of one legacy report row per page, in header order, and columns to ``keep``."""
    i = F.col("page_id")
    third = i % 3
    day = F.date_add(F.lit(SAMPLE_START), (i % 92).cast("int"))
    not_set = F.lit("(not set)")
    dimensions = [
        F.date_format(day, "yyyyMMdd"),
        F.regexp_extract("url", r"^https?://([^/?#]+)", 1),
        F.when(i % 20 == 0, not_set).otherwise(F.regexp_extract("url", r"^https?://[^/?#]+([^?#]*)", 1)),
        _prefixed("NATION_", i % 25),
        _prefixed("R", i % 5),
        not_set,
        F.when(third == 0, "google").when(third == 1, "bing").otherwise("(direct)"),
        F.when(third == 0, "cpc").when(third == 1, "organic").otherwise("(none)"),
        not_set,
    ]
    metrics = {
        "ga:users": i % 9 + 1,
        "ga:newUsers": third,
        "ga:entrances": i % 5,
        "ga:sessions": i % 9 + 1 + i % 2,
        "ga:pageviews": i % 9 + 3,
        "ga:uniquePageviews": i % 9 + 2,
        "ga:timeOnPage": F.when(i % 4 == 0, "0.0").otherwise(F.concat(_text(i % 50), F.lit(".5"))),
        goal_metric: i % 4,
        "ga:transactionRevenue": F.when(i % 6 == 0, "12.25").otherwise("0.0"),
        "ga:transactions": F.when(i % 6 == 0, "1").otherwise("0"),
    }
    return pages.select(
        *keep,
        F.trunc(day, "MM").alias("window_start"),
        F.struct(
            F.array(*dimensions).alias("dimensions"),
            F.array(
                F.struct(F.array(*(_text(metrics[m]) for m in legacy_metric_names(goal_metric))).alias("values"))
            ).alias("metrics"),
        ).alias("row"),
    )


def report_from_rows(rows: Column, token: Column, goal_metric: str) -> Column:
    """The ``reports`` of a landed page with the given rows and continuation token."""
    names = F.array(*(F.struct(F.lit(m).alias("name")) for m in legacy_metric_names(goal_metric)))
    header = F.struct(
        F.array(*map(F.lit, LEGACY_DIMENSIONS)).alias("dimensions"),
        F.struct(names.alias("metricHeaderEntries")).alias("metricHeader"),
    )
    report = F.struct(header.alias("columnHeader"), F.struct(rows.alias("rows")).alias("data"), token.alias("nextPageToken"))
    return F.array(report).cast(REPORT_PAGE["reports"].dataType)


def report_pages_from_pages(pages: DataFrame, goal_metric: str) -> DataFrame:
    """Landed legacy pages: ``window_start`` and the nested ``reports`` of one page each.

    Rows are cut into pages by their position in the scan, so a page stays small
    whatever the ids look like.
    """
    numbered = legacy_rows_from_pages(pages, goal_metric).withColumn(
        "page_number", F.monotonically_increasing_id().alias("n")
    )
    cut = numbered.withColumn("page_number", F.expr(f"page_number div {PAGE_ROWS}"))
    landed = cut.groupBy("window_start", "page_number").agg(F.collect_list("row").alias("rows"))
    last = landed.groupBy("window_start").agg(F.max("page_number").alias("last_page"))
    more = F.when(F.col("page_number") < F.col("last_page"), _text(F.col("page_number") + 1))
    reports = report_from_rows(F.col("rows"), more, goal_metric).alias("reports")
    # at most one row per calendar month of the mapping
    return landed.join(F.broadcast(last), "window_start").select("window_start", reports)
