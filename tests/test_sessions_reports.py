import pytest
from pyspark.sql import functions as F

from tests.builders import event, export, param, session_params
from trafficloom.functions.labels import NOT_SET
from trafficloom.operators.reports import label_dimensions, landing_report, ranked, source_medium_report
from trafficloom.operators.sessions import sessionize
from trafficloom.plans import reports
from trafficloom.schemas import CHANNEL, GEO, RATIO_METRIC

HOUR = 3_600_000_000
ALL = ["landing_page", *GEO, *CHANNEL]


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def landing_sessions(spark, *events, **options):
    return reports.landing_sessions(reports.landing_flat(export(spark, *events), "purchase"), **options)


def test_session_key_and_missing_ids(spark):
    sessions = landing_sessions(
        spark,
        event(params=session_params(1, "a"), at=1),
        event(params=session_params(1, "b"), at=2),
        event(params=session_params(1, "a"), at=3, day="20240102"),
        event(params=[param("page_location", "c")], at=4),
        event(params=session_params(2, "d"), at=5, user=None),
    )
    assert rows_of(sessions, "event_date", "users", "sessions", "page_views") == [
        (d, *rest)
        for d, *rest in sorted(
            [(_day(1), 0, 1, 1), (_day(1), 1, 0, 1), (_day(1), 1, 1, 2), (_day(2), 1, 1, 1)], key=str
        )
    ]
    assert not {"ga_session_id", "user_pseudo_id"} & set(sessions.columns)


def _day(n):
    import datetime as dt

    return dt.date(2024, 1, n)


def test_landing_page_label_is_part_of_the_maximum(spark):
    start = lambda page, at, user: event("session_start", session_params(1, page), at=at, user=user)
    quiet = lambda at, user: event("scroll", session_params(1), at=at, user=user)
    events = [quiet(1, "a"), start("https://x", 2, "b"), quiet(3, "b"), start("", 4, "c"), start("!", 5, "d"), quiet(6, "d")]
    # "" and "!" sort below the label; only a session without any other event keeps them
    sessions = landing_sessions(spark, *events)
    assert [r[0] for r in rows_of(sessions, "landing_page")] == ["", "(not set", "(not set", "https://x"]
    relabelled = landing_sessions(spark, *events, landing_page_unset=NOT_SET)
    assert [r[0] for r in rows_of(relabelled, "landing_page")] == ["", NOT_SET, NOT_SET, "https://x"]


def test_page_views_and_distinct_pages(spark):
    sessions = landing_sessions(
        spark,
        *(event(params=session_params(1, page), at=i) for i, page in enumerate("aab")),
        event(params=session_params(1), at=9),
        event("scroll", session_params(1, "z"), at=10),
    )
    assert rows_of(sessions, "page_views", "unique_page_views") == [(3, 2)]


def test_a_page_view_with_a_transaction_counts_once_in_sums(spark):
    both = event(params=session_params(1, "a"), at=1, transaction="t1", revenue=2.0)
    again = event(params=session_params(1, "a"), at=2, transaction="t1", revenue=3.0)
    sessions = landing_sessions(spark, both, again)
    columns = ["page_views", "unique_page_views", "ecommerce_revenue", "ecommerce_transactions"]
    assert rows_of(sessions, *columns) == [(2, 1, 5.0, 1)]


def test_transaction_rules_differ(spark):
    events = [
        event(name, session_params(1), at=at, transaction=t)
        for at, (name, t) in enumerate([("purchase", "t1"), ("refund", "t1"), ("scroll", "t2"), ("purchase", None)])
    ]
    assert rows_of(landing_sessions(spark, *events), "ecommerce_transactions") == [(2,)]
    flat = reports.acquisition_flat(export(spark, *events), "purchase")
    assert rows_of(reports.acquisition_sessions(flat), "ecommerce_transactions") == [(2,)]
    without_scroll = reports.acquisition_flat(export(spark, events[2]), "purchase")
    assert rows_of(reports.acquisition_sessions(without_scroll), "ecommerce_transactions") == [(0,)]


def test_two_step_distinct_equals_plain_count_distinct(spark):
    from tests.conftest import SF_TEST
    from trafficloom.catalog import queries as catalog

    flat = catalog.flat(spark, SF_TEST)
    # a session that holds a third of all events
    flat = flat.withColumn("hot", F.col("ga_session_number") % 3 == 0)
    flat = flat.withColumn("user_pseudo_id", F.when(F.col("hot"), "hot").otherwise(F.col("user_pseudo_id")))
    flat = flat.withColumn("ga_session_id", F.when(F.col("hot"), 1).otherwise(F.col("ga_session_id")))
    plain = flat.groupBy("event_date", "ga_session_id", "user_pseudo_id").agg(
        F.count("pageview_location").alias("page_views"),
        F.count_distinct("pageview_location").alias("unique_page_views"),
        F.count_distinct("ecommerce_transaction_id").alias("ecommerce_transactions"),
        F.sum("entrance").alias("entrance"),
        F.sum("conversions").alias("conversions"),
    )
    columns = ["event_date", "page_views", "unique_page_views", "ecommerce_transactions", "entrance", "conversions"]
    assert rows_of(sessionize(flat, ALL), *columns) == rows_of(plain, *columns)


def test_labels_merge_before_grouping(spark):
    events = [
        event(params=session_params(i, "p"), at=i, country=country)
        for i, country in enumerate([None, "", NOT_SET, "US", "US"])
    ]
    report = landing_report(landing_sessions(spark, *events))
    assert rows_of(report, "country", "sessions") == [("(not set)", 3), ("US", 2)]


def test_channel_labels_merge_before_grouping(spark):
    pairs = [(None, None), ("(direct)", "(none)"), (None, "(none)"), ("", "")]
    events = [
        event(params=session_params(i, "p"), at=i, source=source, medium=medium)
        for i, (source, medium) in enumerate(pairs)
    ]
    report = reports.acquisition_report(export(spark, *events), "purchase")
    assert rows_of(report, "utm_source", "utm_medium", "sessions") == [("", "", 1), ("(direct)", "(none)", 3)]


def test_geography_and_channel_labels_treat_empty_text_differently(spark):
    frame = spark.createDataFrame([("", "", None, "", None, None)], "country string, region string, city string, "
                                  "utm_source string, utm_medium string, utm_campaign string")
    assert tuple(label_dimensions(frame).first()) == (NOT_SET, NOT_SET, NOT_SET, "", "(none)", NOT_SET)


def test_ratio_is_null_without_sessions(spark):
    seconds = param("engagement_time_msec", number=1005)
    report = reports.acquisition_report(
        export(
            spark,
            event(params=[seconds], source="a", at=1),
            event(params=session_params(1, None, seconds), source="b", at=2),
            event(params=session_params(2, None, seconds), source="b", at=3),
        )
    )
    assert rows_of(report, "utm_source", "sessions", RATIO_METRIC) == [("a", 0, None), ("b", 2, 1.01)]


def test_users_count_user_sessions(spark):
    events = [event(params=session_params(s, "p"), at=s * HOUR) for s in (1, 2, 3)]
    assert rows_of(reports.acquisition_report(export(spark, *events)), "users", "sessions") == [(3, 3)]


def test_ranked_order_is_total(spark):
    events = [
        event(params=session_params(s, "p"), at=s, source=source, medium="m", user=source)
        for s, source in enumerate(["b", "a", "c", "c"])
    ]
    report = reports.acquisition_report(export(spark, *events))
    assert [r["utm_source"] for r in ranked(report).collect()] == ["c", "a", "b"]
    assert [r["utm_source"] for r in ranked(report).limit(1).collect()] == ["c"]


def test_unknown_options_are_rejected(spark):
    flat = reports.landing_flat(export(spark))
    with pytest.raises(ValueError):
        sessionize(flat, ALL, transactions="approximate")
    with pytest.raises(ValueError):
        reports.flatten_events(export(spark), channel="cookies")


def test_source_medium_report_columns(spark):
    sessions = reports.acquisition_sessions(reports.acquisition_flat(export(spark)))
    assert len(sessions.columns) == 13 and len(source_medium_report(sessions).columns) == 13
    landing = reports.landing_sessions(reports.landing_flat(export(spark)))
    assert len(landing.columns) == 18 and len(landing_report(landing).columns) == 18
