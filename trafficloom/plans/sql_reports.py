"""Both daily reports as parameterised SQL text, for users who schedule queries.

The texts take the table by ``IDENTIFIER`` and all values as markers, so nothing is pasted
into them: ``:events`` names the export, ``:as_of`` and ``:prior_days`` give its window,
``:conversion_event`` and ``:landing_page_unset`` are as for the DataFrame form. They give the
same rows as :mod:`trafficloom.plans.reports`, by the same steps: parameters are picked inside
the array, equal events collapse, distinct pages and transactions are counted in two grouped
steps, and labels are set before the rows are grouped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from trafficloom.functions.dates import utc_today
from trafficloom.functions.labels import DIRECT, LANDING_PAGE_UNSET, NONE, NOT_SET
from trafficloom.operators.events import (
    CHANNEL_PARAMS,
    ENGAGEMENT_KEY,
    FIRST_VISIT,
    IDENTITY,
    PAGE_KEY,
    PAGE_VIEW,
    PURCHASE_EVENTS,
    SESSION_START,
)
from trafficloom.operators.sessions import SESSION
from trafficloom.schemas import GEO, LANDING_DIMENSIONS, SOURCE_MEDIUM_DIMENSIONS


def _greatest(key: str, field: str = "string_value") -> str:
    return f"array_max(transform(filter(event_params, p -> p.key = '{key}'), p -> p.value.{field}))"


def _lines(columns: dict[str, str], pattern: str = "{} AS {}") -> str:
    return ",\n    ".join(pattern.format(value, name) for name, value in columns.items())


_EVENT_SUMS = {
    "entrance": f"CAST(event_name = '{SESSION_START}' AS INT)",
    "new_user": f"CAST(event_name = '{FIRST_VISIT}' AS INT)",
    "seconds": "seconds",
    "conversions": "conversions",
    "revenue": "revenue",
}


def _events(channel: dict[str, str], transaction: str) -> str:
    """The window's events, one row per identity."""
    page = _greatest(PAGE_KEY)
    picked = {
        "ga_session_id": _greatest("ga_session_id", "int_value"),
        "page": f"CASE WHEN event_name = '{PAGE_VIEW}' THEN {page} END",
        "landing_page": f"CASE WHEN event_name = '{SESSION_START}' THEN {page} END",
        **{name: f"geo.{name}" for name in GEO},
        **channel,
        "seconds": f"array_max(transform(event_params, p -> if(p.key = '{ENGAGEMENT_KEY}', p.value.int_value / 1000, 0.0D)))",
        "transaction": transaction,
        "revenue": "coalesce(ecommerce.purchase_revenue, 0.0D)",
    }
    identity = ", ".join(IDENTITY)
    return f"""picked AS (
  SELECT to_date(event_date, 'yyyyMMdd') AS event_date, {', '.join(k for k in IDENTITY if k != 'event_date')},
    {_lines(picked)},
    if(event_name = :conversion_event, size(filter(event_params, p -> p.key = '{PAGE_KEY}')), 0) AS conversions
  FROM IDENTIFIER(:events)
  WHERE size(event_params) > 0
    AND event_date BETWEEN date_format(date_sub(CAST(:as_of AS DATE), :prior_days), 'yyyyMMdd')
      AND date_format(CAST(:as_of AS DATE), 'yyyyMMdd')
),
event AS (
  SELECT {identity},
    {_lines({name: f'max({name})' for name in picked})},
    sum(conversions) AS conversions
  FROM picked GROUP BY {identity}
)"""


def _sessions(dimensions: list[str], distinct_transactions: bool) -> str:
    """One row per day, session id and user. Each event is laid out as its page and its
    transaction, if it has them, and feeds the sums once."""
    keys = ", ".join(SESSION)
    transactions = "count_if(kind = 'transaction')"
    if not distinct_transactions:
        transactions = "coalesce(sum(if(kind = 'transaction', hits, NULL)), 0)"
    picks = {d: f"max({d})" for d in dimensions}
    return f"""laid_out AS (
  SELECT *, coalesce(place, 0) = 0 AS first, counted.kind AS kind, counted.value AS value
  FROM event LATERAL VIEW OUTER posexplode(filter(array(
    if(page IS NOT NULL, named_struct('kind', 'page', 'value', page), NULL),
    if(transaction IS NOT NULL, named_struct('kind', 'transaction', 'value', transaction), NULL)
  ), x -> x IS NOT NULL)) entries AS place, counted
),
per_value AS (
  SELECT {keys}, kind, value,
    {_lines(picks)},
    {_lines({name: f'sum(if(first, {e}, NULL))' for name, e in _EVENT_SUMS.items()})},
    count(value) AS hits
  FROM laid_out GROUP BY {keys}, kind, value
),
session AS (
  SELECT {keys},
    {_lines(picks)},
    {_lines({name: f'sum({name})' for name in _EVENT_SUMS})},
    coalesce(sum(if(kind = 'page', hits, NULL)), 0) AS page_views,
    count_if(kind = 'page') AS unique_page_views,
    {transactions} AS transactions
  FROM per_value GROUP BY {keys}
)"""


def _report(dimensions: list[str], labels: dict[str, str]) -> str:
    by = ", ".join(dimensions)
    return f"""labelled AS (
  SELECT event_date AS date,
    {_lines(labels)},
    if(user_pseudo_id IS NULL, 0, 1) AS users, if(ga_session_id IS NULL, 0, 1) AS sessions,
    entrance, new_user, page_views, unique_page_views, seconds, conversions, revenue, transactions
  FROM session
)
SELECT {by},
  sum(users) AS users, sum(new_user) AS new_users, sum(entrance) AS entrances, sum(sessions) AS sessions,
  sum(page_views) AS page_views, sum(unique_page_views) AS unique_page_views,
  round(try_divide(sum(seconds), sum(sessions)), 2) AS engagment_time_sec_per_session,
  sum(conversions) AS conversions, round(sum(revenue), 2) AS ecommerce_revenue, sum(transactions) AS ecommerce_transactions
FROM labelled GROUP BY {by}"""


_CHANNEL = {"utm_source": f"coalesce(utm_source, '{DIRECT}')", "utm_medium": f"coalesce(utm_medium, '{NONE}')"}
_LANDING_LABELS = {
    "landing_page": "landing_page",
    **{name: f"if({name} <> '', {name}, '{NOT_SET}')" for name in GEO},
    **_CHANNEL,
    "utm_campaign": f"coalesce(utm_campaign, '{NOT_SET}')",
}
_PURCHASES = ", ".join(f"'{name}'" for name in PURCHASE_EVENTS)

LANDING_SQL = ",\n".join(
    [
        "WITH " + _events({n: _greatest(p.key) for n, p in CHANNEL_PARAMS.items()}, "ecommerce.transaction_id"),
        # the label of a missing landing page takes part in the choice of a session's greatest
        _sessions(LANDING_DIMENSIONS[1:], True).replace(
            "max(landing_page) AS landing_page", "max(coalesce(landing_page, :landing_page_unset)) AS landing_page", 1
        ),
        _report(LANDING_DIMENSIONS, _LANDING_LABELS),
    ]
)
SOURCE_MEDIUM_SQL = ",\n".join(
    [
        "WITH "
        + _events(
            {"utm_source": "traffic_source.source", "utm_medium": "traffic_source.medium"},
            f"CASE WHEN event_name IN ({_PURCHASES}) THEN ecommerce.transaction_id END",
        ),
        _sessions(SOURCE_MEDIUM_DIMENSIONS[1:], False),
        _report(SOURCE_MEDIUM_DIMENSIONS, _CHANNEL),
    ]
)


def report_by_sql(
    spark: SparkSession,
    text: str,
    events: str,
    prior_days: int,
    conversion_event: str | None = None,
    as_of: dt.date | None = None,
    landing_page_unset: str = LANDING_PAGE_UNSET,
) -> DataFrame:
    """``LANDING_SQL`` or ``SOURCE_MEDIUM_SQL`` over a table or view of the export, whose days
    are ``yyyyMMdd`` text."""
    values = {
        "events": events,
        "as_of": as_of or utc_today(),
        "prior_days": prior_days,
        "conversion_event": conversion_event or "",
    }
    if ":landing_page_unset" in text:
        values["landing_page_unset"] = landing_page_unset
    return spark.sql(text, args=values)
