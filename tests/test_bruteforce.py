"""Both reports against a plain-Python computation on random events."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.builders import event, export
from trafficloom.operators.events import PURCHASE_EVENTS
from trafficloom.plans.reports import acquisition_report, landing_page_report
from trafficloom.schemas import LANDING_DIMENSIONS, METRICS, SOURCE_MEDIUM_DIMENSIONS

keys = st.sampled_from(["page_location", "ga_session_id", "engagement_time_msec", "source", "medium", "campaign", "x"])
texts = st.sampled_from([None, "", "!", "a", "b"])
numbers = st.sampled_from([None, -1500, 0, 250, 1000])
params = st.none() | st.lists(st.tuples(keys, st.tuples(texts, numbers)), max_size=7)
events = st.builds(
    event,
    name=st.sampled_from(["page_view", "session_start", "first_visit", "purchase", "refund", None]),
    params=params,
    user=st.sampled_from([None, "u1", "u2"]),
    at=st.sampled_from([1, 2, 3]),
    day=st.sampled_from(["20240101", "20240102"]),
    country=st.sampled_from([None, "", "FR", "(not set)"]),
    city=st.sampled_from([None, "C"]),
    source=st.sampled_from([None, "", "news", "(direct)"]),
    medium=st.sampled_from([None, "mail"]),
    transaction=st.sampled_from([None, "t1", "t2"]),
    revenue=st.sampled_from([None, 1.25, -2.0, 10.5]),
)


def top(values):
    return max((v for v in values if v is not None), default=None)


def known(values):
    return [v for v in values if v is not None]


def cents(value):
    return float(Decimal(repr(float(value))).quantize(Decimal("0.01"), ROUND_HALF_UP))


def grouped(rows, key):
    groups = defaultdict(list)
    for row in rows:
        groups[key(row)].append(row)
    return groups


def flat_rows(rows, acquisition):
    with_params = [r for r in rows if r[9]]
    for (day, name, _at, user, _touch), copies in grouped(with_params, lambda r: (r[0], r[3], r[1], r[4], r[2])).items():
        found = [p for r in copies for p in r[9]]

        def text(key, on=None):
            return top(v[0] for k, v in found if k == key) if on in (None, name) else None

        seconds = [(v[1] / 1000 if v[1] is not None else None) if k == "engagement_time_msec" else 0.0 for k, v in found]
        counted = not acquisition or name in PURCHASE_EVENTS
        yield {
            "day": day,
            "user": user,
            "session": top(v[1] for k, v in found if k == "ga_session_id"),
            "geo": [top(r[6][i] for r in copies) for i in range(3)],
            "channel": [top(r[7][i] for r in copies) for i in range(2)]
            if acquisition
            else [text("source"), text("medium"), text("campaign")],
            "page": text("page_location", "page_view"),
            "landing": text("page_location", "session_start"),
            "seconds": top(seconds),
            "transaction": top(r[8][0] for r in copies) if counted else None,
            "revenue": max(r[8][1] or 0.0 for r in copies),
            "entrance": int(name == "session_start"),
            "new": int(name == "first_visit"),
            "conversions": sum(k == "page_location" for k, _ in found) if name == "purchase" else 0,
        }


def expected(rows, acquisition):
    sessions = []
    for (day, session, user), hits in grouped(
        flat_rows(rows, acquisition), lambda r: (r["day"], r["session"], r["user"])
    ).items():
        channel = [top(column) for column in zip(*(h["channel"] for h in hits))]
        labels = ["(direct)", "(none)", "(not set)"]
        channel = [label if value is None else value for value, label in zip(channel, labels)]
        geo = [top(column) or "(not set)" for column in zip(*(h["geo"] for h in hits))]
        landing = max("(not set" if h["landing"] is None else h["landing"] for h in hits)
        transactions = known(h["transaction"] for h in hits)
        pages = known(h["page"] for h in hits)
        seconds = known(h["seconds"] for h in hits)
        sessions.append(
            {
                "key": (day, *channel) if acquisition else (day, landing, *geo, *channel),
                "users": int(user is not None),
                "new_users": sum(h["new"] for h in hits),
                "entrances": sum(h["entrance"] for h in hits),
                "sessions": int(session is not None),
                "page_views": len(pages),
                "unique_page_views": len(set(pages)),
                "seconds": sum(seconds) if seconds else None,
                "conversions": sum(h["conversions"] for h in hits),
                "ecommerce_revenue": sum(h["revenue"] for h in hits),
                "ecommerce_transactions": len(transactions) if acquisition else len(set(transactions)),
            }
        )
    result = []
    for key, members in grouped(sessions, lambda s: s["key"]).items():
        seconds, count = known(s["seconds"] for s in members), sum(s["sessions"] for s in members)
        row = {m: sum(s[m] for s in members) for m in METRICS if m in members[0]}
        row["ecommerce_revenue"] = cents(row["ecommerce_revenue"])
        row["engagment_time_sec_per_session"] = cents(sum(seconds) / count) if seconds and count else None
        result.append((*key, *(row[m] for m in METRICS)))
    return sorted(result, key=repr)


def actual(report, dimensions):
    rows = report.select(*dimensions, *METRICS).collect()
    return sorted(((f"{r[0]:%Y%m%d}", *r[1:]) for r in rows), key=repr)


def positive_zero(rows):
    return [tuple(0.0 if v == 0 and isinstance(v, float) else v for v in row) for row in rows]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(events, min_size=10, max_size=80))
def test_reports(spark, rows):
    frame = export(spark, *rows).coalesce(2)
    landing = actual(landing_page_report(frame, "purchase"), LANDING_DIMENSIONS)
    assert positive_zero(landing) == positive_zero(expected(rows, acquisition=False))
    acquisition = actual(acquisition_report(frame, "purchase"), SOURCE_MEDIUM_DIMENSIONS)
    assert positive_zero(acquisition) == positive_zero(expected(rows, acquisition=True))
