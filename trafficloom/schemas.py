"""Schemas of the event export, the landed legacy pages and the unified reports.

The readers always get one of these schemas, never an inferred one: a narrow
schema is also what keeps unused leaves of ``event_params.value`` from being
read, since nested pruning stops at an exploded array of structs.
"""

from __future__ import annotations

from pyspark.sql import types as T

_s, _l, _d = T.StringType(), T.LongType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


EXPORT = _struct(
    event_date=_s,
    event_timestamp=_l,
    user_first_touch_timestamp=_l,
    event_name=_s,
    user_pseudo_id=_s,
    device=_struct(category=_s, language=_s, web_info=_struct(browser=_s)),
    geo=_struct(country=_s, region=_s, city=_s),
    traffic_source=_struct(source=_s, medium=_s),
    ecommerce=_struct(transaction_id=_s, purchase_revenue=_d),
    event_params=T.ArrayType(
        _struct(key=_s, value=_struct(string_value=_s, int_value=_l))
    ),
)

REPORT_PAGE = _struct(
    reports=T.ArrayType(
        _struct(
            columnHeader=_struct(
                dimensions=T.ArrayType(_s),
                metricHeader=_struct(metricHeaderEntries=T.ArrayType(_struct(name=_s))),
            ),
            data=_struct(
                rows=T.ArrayType(
                    _struct(
                        dimensions=T.ArrayType(_s),
                        metrics=T.ArrayType(_struct(values=T.ArrayType(_s))),
                    )
                )
            ),
            nextPageToken=_s,
        )
    )
)

# Public column names, in report order. "engagment" is spelled
# the way existing consumers of the table expect it.
GEO = ["country", "region", "city"]
CHANNEL = ["utm_source", "utm_medium", "utm_campaign"]
LANDING_DIMENSIONS = ["date", "landing_page", *GEO, *CHANNEL]
SOURCE_MEDIUM_DIMENSIONS = ["date", "utm_source", "utm_medium"]
METRIC_TYPES = {
    "users": _l,
    "new_users": _l,
    "entrances": _l,
    "sessions": _l,
    "page_views": _l,
    "unique_page_views": _l,
    "engagment_time_sec_per_session": _d,
    "conversions": _l,
    "ecommerce_revenue": _d,
    "ecommerce_transactions": _l,
}
METRICS = list(METRIC_TYPES)
RATIO_METRIC = "engagment_time_sec_per_session"


def _report(dimensions: list[str]) -> T.StructType:
    kinds = {d: T.DateType() if d == "date" else _s for d in dimensions}
    return _struct(**kinds, **METRIC_TYPES)


TARGET = _report(LANDING_DIMENSIONS)
SOURCE_MEDIUM = _report(SOURCE_MEDIUM_DIMENSIONS)
TARGET_WITH_PAGES = T.StructType([*TARGET, T.StructField("page_sketch", T.BinaryType())])

# Legacy report names and the unified columns they feed.
DEFAULT_GOAL_METRIC = "ga:goalCompletionsAll"
LEGACY_DIMENSIONS = {
    "ga:date": "date",
    "ga:hostname": "landing_page",
    "ga:landingPagePath": "landing_page",
    "ga:country": "country",
    "ga:region": "region",
    "ga:city": "city",
    "ga:source": "utm_source",
    "ga:medium": "utm_medium",
    "ga:campaign": "utm_campaign",
}
LEGACY_METRICS = {
    "ga:users": "users",
    "ga:newUsers": "new_users",
    "ga:entrances": "entrances",
    "ga:sessions": "sessions",
    "ga:pageviews": "page_views",
    "ga:uniquePageviews": "unique_page_views",
    "ga:timeOnPage": "engagment_time_sec_per_session",
    DEFAULT_GOAL_METRIC: "conversions",
    "ga:transactionRevenue": "ecommerce_revenue",
    "ga:transactions": "ecommerce_transactions",
}


def legacy_metric_names(goal_metric: str = DEFAULT_GOAL_METRIC) -> list[str]:
    """The ten metrics of a legacy pull, with the goal in its place."""
    return [goal_metric if m == DEFAULT_GOAL_METRIC else m for m in LEGACY_METRICS]
