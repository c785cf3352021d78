import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.builders import event, export, param, session_params
from trafficloom.functions.dates import micros_text
from trafficloom.operators.events import IDENTITY, Param, flatten_events

METHODS = ["in_row", "explode"]


def flat_rows(frame, *columns):
    return [tuple(r) for r in frame.select(*columns).collect()]


@pytest.mark.parametrize("method", METHODS)
def test_events_without_parameters_disappear(spark, method):
    rows = export(spark, event(params=None, user="a"), event(params=[], user="b"), event(params=[param("x")], user="c"))
    assert flat_rows(flatten_events(rows, method=method), "user_pseudo_id") == [("c",)]


@pytest.mark.parametrize("method", METHODS)
def test_equal_identities_collapse_to_greatest_values(spark, method):
    rows = export(
        spark,
        event(params=session_params(7, "https://x/a"), country="FR", city=None, revenue=5.0),
        event(params=session_params(9, "https://x/b"), country="DE", city="C", revenue=None),
    )
    flat = flatten_events(rows, method=method)
    found = flat_rows(flat, "geo_country", "geo_city", "ga_session_id", "pageview_location", "ecommerce_purchase_revenue")
    assert found == [("FR", "C", 9, "https://x/b", 5.0)]


@pytest.mark.parametrize("method", METHODS)
def test_missing_identity_parts_group_together(spark, method):
    rows = export(spark, event(user=None, params=[param("a")]), event(user=None, params=[param("b")]))
    assert flatten_events(rows, method=method).count() == 1


@pytest.mark.parametrize("method", METHODS)
def test_conversions_count_page_parameters_of_copies(spark, method):
    page = param("page_location", "https://x/a")
    rows = export(
        spark,
        event("buy", [page], user="a"),
        event("buy", [page, page], user="a"),
        event("buy", [param("other")], user="b"),
        event("look", [page], user="c"),
    )
    flat = flatten_events(rows, "buy", method=method)
    assert sorted(flat_rows(flat, "user_pseudo_id", "conversions")) == [("a", 3), ("b", 0), ("c", 0)]


@pytest.mark.parametrize("blank", [None, ""])
@pytest.mark.parametrize("method", METHODS)
def test_blank_conversion_event(spark, method, blank):
    rows = export(spark, event("buy", [param("page_location", "p")]))
    assert flat_rows(flatten_events(rows, blank, method=method), "conversions") == [(0,)]


def test_conversion_event_is_a_value_not_text_in_a_query(spark):
    name = "it's \"quoted\" {x}"
    rows = export(spark, event(name, [param("page_location", "p")]))
    assert flat_rows(flatten_events(rows, name), "conversions") == [(1,)]


ENGAGEMENT = {
    "absent": ([param("x")], 0.0),
    "present": ([param("engagement_time_msec", number=1500)], 1.5),
    "empty alone": ([param("engagement_time_msec")], None),
    "empty with others": ([param("engagement_time_msec"), param("x")], 0.0),
    "negative alone": ([param("engagement_time_msec", number=-2000)], -2.0),
    "negative with others": ([param("engagement_time_msec", number=-2000), param("x")], 0.0),
    "repeated": ([param("engagement_time_msec", number=n) for n in (1000, 3000, None)], 3.0),
    "repeated and negative": ([param("engagement_time_msec", number=n) for n in (-1000, -3000)], -1.0),
}


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("case", ENGAGEMENT)
def test_engagement_seconds(spark, case, method):
    params, expected = ENGAGEMENT[case]
    flat = flatten_events(export(spark, event(params=params)), method=method)
    assert flat_rows(flat, "engagment_time_sec") == [(expected,)]


@pytest.mark.parametrize("method", METHODS)
def test_pages_belong_to_their_kind_of_event(spark, method):
    page = [param("page_location", "p")]
    rows = export(spark, event("page_view", page), event("session_start", page), event("scroll", page))
    flat = flatten_events(rows, method=method)
    assert sorted(flat_rows(flat, "event_name", F.col("pageview_location"), "landing_page"), key=str) == [
        ("page_view", "p", None),
        ("scroll", None, None),
        ("session_start", None, "p"),
    ]


def test_channel_and_transactions_follow_the_report(spark):
    params = [param("source", "google"), param("medium", "cpc"), param("campaign", "sale")]
    rows = export(
        spark,
        event("purchase", params, source="news", medium="mail", transaction="t1"),
        event("scroll", params, source="news", medium="mail", transaction="t2"),
    )
    by_event = flatten_events(rows)
    assert sorted(flat_rows(by_event, "utm_source", "utm_medium", "utm_campaign", "ecommerce_transaction_id")) == [
        ("google", "cpc", "sale", "t1"),
        ("google", "cpc", "sale", "t2"),
    ]
    by_user = flatten_events(rows, channel="traffic_source", transactions="purchase_events")
    assert "utm_campaign" not in by_user.columns and len(by_user.columns) == 25 and len(by_event.columns) == 26
    assert sorted(flat_rows(by_user, "event_name", "utm_source", "utm_medium", "ecommerce_transaction_id")) == [
        ("purchase", "news", "mail", "t1"),
        ("scroll", "news", "mail", None),
    ]


def test_engaged_flag_is_strict_but_only_where_used(spark):
    rows = export(spark, event(params=[param("session_engaged", "yes")]))
    flat = flatten_events(rows)
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        flat.select("session_engaged").collect()
    assert flat.select("event_name").count() == 1


def test_extra_parameters(spark):
    rows = export(spark, event(params=[param("plan", "pro"), param("seats", number=4)]))
    flat = flatten_events(rows, extra_params={"plan": Param("plan"), "seats": Param("seats", "int_value")})
    assert flat_rows(flat, "plan", "seats") == [("pro", 4)]


def test_malformed_day_fails(spark):
    with pytest.raises(PySparkException):
        flatten_events(export(spark, event(params=[param("x")], day="intraday"))).collect()


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_clock_text_ignores_the_session_zone(spark, zone):
    # 02:30 on this day does not exist in Los Angeles
    moment = dt.datetime(2024, 3, 10, 2, 30, 15, 999_999, tzinfo=dt.timezone.utc)
    micros = int(moment.timestamp()) * 1_000_000 + 999_999
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.range(1).select(micros_text(F.lit(micros)), micros_text(F.lit(-1))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == ("2024-03-10 02:30:15", "1969-12-31 23:59:59")


values = st.tuples(
    st.sampled_from([None, "", "(", "a", "b", "1"]), st.sampled_from([None, -3000, 0, 1, 2500])
)
keys = st.sampled_from(
    ["ga_session_id", "page_location", "page_title", "engagement_time_msec", "source", "medium", "other", None]
)
params = st.none() | st.lists(st.none() | st.tuples(keys, st.none() | values), max_size=6)
events = st.builds(
    event,
    name=st.sampled_from(["page_view", "session_start", "purchase", None]),
    params=params,
    user=st.sampled_from([None, "u1", "u2"]),
    at=st.sampled_from([1, 2]),
    transaction=st.sampled_from([None, "t1", "t2"]),
    revenue=st.sampled_from([None, 1.5, -2.0]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(events, min_size=20, max_size=60))
def test_both_methods_agree(spark, rows):
    frame = export(spark, *rows).coalesce(1)
    plain = [flatten_events(frame, "purchase", method=m) for m in METHODS]
    in_row, exploded = (sorted(map(str, f.collect())) for f in plain)
    assert in_row == exploded


def test_identity_covers_the_five_keys():
    assert set(IDENTITY) == {
        "event_date", "event_name", "event_timestamp", "user_pseudo_id", "user_first_touch_timestamp",
    }
