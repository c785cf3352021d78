"""From exported events with nested parameters to one flat row per event identity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficloom.functions.dates import micros_text, shard_day

# The finest key comes first: picking the greatest string needs a sorting
# aggregation, and its sort compares the leading column by prefix.
IDENTITY = [
    "event_timestamp",
    "user_pseudo_id",
    "event_date",
    "event_name",
    "user_first_touch_timestamp",
]

# Event names with a meaning to the reports.
SESSION_START = "session_start"
FIRST_VISIT = "first_visit"
PAGE_VIEW = "page_view"
PURCHASE_EVENTS = [
    "purchase",
    "ecommerce_purchase",
    "in_app_purchase",
    "app_store_subscription_convert",
    "app_store_subscription_renew",
    "refund",
]
ENGAGEMENT_KEY = "engagement_time_msec"
PAGE_KEY = "page_location"


@dataclass(frozen=True)
class Param:
    """A parameter to turn into a column, optionally only on one kind of event."""

    key: str
    field: str = "string_value"
    event_name: str | None = None


FLAT_PARAMS = {
    "ga_session_id": Param("ga_session_id", "int_value"),
    "ga_session_number": Param("ga_session_number", "int_value"),
    "session_engaged": Param("session_engaged"),
    "page_title": Param("page_title"),
    "pageview_location": Param(PAGE_KEY, event_name=PAGE_VIEW),
    "landing_page": Param(PAGE_KEY, event_name=SESSION_START),
}
CHANNEL_PARAMS = {
    "utm_source": Param("source"),
    "utm_medium": Param("medium"),
    "utm_campaign": Param("campaign"),
}


def dated(export: DataFrame) -> DataFrame:
    """``event_date`` as a date, once, so that every later step keys on the same column."""
    if isinstance(export.schema["event_date"].dataType, T.DateType):
        return export
    return export.withColumn("event_date", shard_day(F.col("event_date")))


def explode_params(export: DataFrame) -> DataFrame:
    """One row per parameter in ``param``; events without parameters disappear."""
    return export.withColumn("param", F.explode("event_params")).drop("event_params")


def _on_event(event_name: str | None, value: Column) -> Column:
    return value if event_name is None else F.when(F.col("event_name") == event_name, value)


def _exploded_param_columns(export, params, conversion_event):
    key = F.col("param.key")
    columns = {
        name: _on_event(p.event_name, F.when(key == p.key, F.col(f"param.value.{p.field}")))
        for name, p in params.items()
    }
    seconds = F.col("param.value.int_value") / 1000
    converted = (F.col("event_name") == conversion_event) & (key == PAGE_KEY)
    columns["engagment_time_sec"] = F.when(key == ENGAGEMENT_KEY, seconds).otherwise(0.0)
    columns["conversions"] = F.when(converted, 1).otherwise(0)
    return explode_params(export), columns


def _in_row_param_columns(export, params, conversion_event):
    """Look each key up by position, or by scanning the array where a key repeats.

    Position lookups compile to plain loops, array lambdas do not, and exporters
    hardly ever repeat a key within one event.
    """
    keyed = (
        export.filter(F.size("event_params") > 0)
        .withColumn("_keys", F.col("event_params.key"))
        .withColumn("_repeats", F.size(F.array_distinct("_keys")) < F.size("_keys"))
    )
    repeats = F.col("_repeats")

    def only(key: str) -> Column:
        return F.get("event_params", F.array_position("_keys", key).cast("int") - 1)["value"]

    def every(key: str) -> Column:
        return F.filter("event_params", lambda e: e["key"] == key)

    def greatest_value(p: Param) -> Column:
        values = F.transform(every(p.key), lambda e: e["value"][p.field])
        return F.when(repeats, F.array_max(values)).otherwise(only(p.key)[p.field])

    def seconds_or_zero(e: Column) -> Column:
        return F.when(e["key"] == ENGAGEMENT_KEY, e["value"]["int_value"] / 1000).otherwise(0.0)

    columns = {
        name: _on_event(p.event_name, greatest_value(p)) for name, p in params.items()
    }
    seconds = only(ENGAGEMENT_KEY)["int_value"] / 1000
    alone = (F.size("_keys") == 1) & F.array_contains("_keys", ENGAGEMENT_KEY)
    columns["engagment_time_sec"] = (
        F.when(repeats, F.array_max(F.transform("event_params", seconds_or_zero)))
        .when(alone, seconds)
        .otherwise(F.greatest(seconds, F.lit(0.0)))
    )
    pages = F.when(repeats, F.size(every(PAGE_KEY))).otherwise(
        F.array_contains("_keys", PAGE_KEY).cast("int")
    )
    columns["conversions"] = F.when(
        F.col("event_name") == conversion_event, F.coalesce(pages, F.lit(0))
    ).otherwise(0)
    return keyed, columns


def flatten_events(
    export: DataFrame,
    conversion_event: str | None = None,
    channel: str = "event_params",
    transactions: str = "any_event",
    method: str = "in_row",
    extra_params: dict[str, Param] | None = None,
) -> DataFrame:
    """One row per event identity, with parameters as columns.

    Events that agree on ``IDENTITY`` collapse into one row; each column takes
    its greatest value. ``conversions`` counts page-location parameters of the
    conversion event before the collapse, so copies count again.

    ``channel``: read ``utm_*`` from the event parameters, or from
    ``traffic_source`` (which has no campaign).
    ``transactions``: keep the transaction id of any event, or of purchase-like
    events only.
    ``method``: ``in_row`` picks parameters inside each event's array, so the
    aggregation sorts and shuffles one row per event; ``explode`` sends one row
    per parameter into it. Both give the same result.
    """
    params = dict(FLAT_PARAMS)
    if channel == "event_params":
        params |= CHANNEL_PARAMS
    elif channel != "traffic_source":
        raise ValueError(f"unknown channel: {channel!r}")
    params |= extra_params or {}
    if transactions not in ("any_event", "purchase_events"):
        raise ValueError(f"unknown transactions: {transactions!r}")

    build = {"in_row": _in_row_param_columns, "explode": _exploded_param_columns}[method]
    rows, columns = build(dated(export), params, conversion_event or "")

    transaction = F.col("ecommerce.transaction_id")
    if transactions == "purchase_events":
        transaction = F.when(F.col("event_name").isin(PURCHASE_EVENTS), transaction)
    picked = {
        "device_category": F.col("device.category"),
        "device_language": F.col("device.language"),
        "device_browser": F.col("device.web_info.browser"),
        "geo_country": F.col("geo.country"),
        "geo_region": F.col("geo.region"),
        "geo_city": F.col("geo.city"),
        "ecommerce_transaction_id": transaction,
        "ecommerce_purchase_revenue": F.coalesce("ecommerce.purchase_revenue", F.lit(0.0)),
        **columns,
    }
    if channel == "traffic_source":
        picked["utm_source"] = F.col("traffic_source.source")
        picked["utm_medium"] = F.col("traffic_source.medium")
    # Pick first, then group: the sort of the aggregation carries these columns
    # and not the whole parameter array.
    pivoted = rows.select(*IDENTITY, *(value.alias(name) for name, value in picked.items()))
    collapsed = pivoted.groupBy(*IDENTITY).agg(
        *(F.max(name).alias(name) for name in picked if name != "conversions"),
        F.sum("conversions").alias("conversions"),
    )
    return collapsed.select(
        "event_date",
        micros_text(F.col("event_timestamp")).alias("event_time"),
        micros_text(F.col("user_first_touch_timestamp")).alias("user_first_touch_time"),
        "event_name",
        "user_pseudo_id",
        "device_category",
        "device_language",
        "device_browser",
        "geo_country",
        "geo_region",
        "geo_city",
        event_flag(SESSION_START).alias("entrance"),
        event_flag(FIRST_VISIT).alias("new_user"),
        "ga_session_id",
        "ga_session_number",
        F.col("session_engaged").cast("bigint").alias("session_engaged"),
        "page_title",
        "pageview_location",
        "landing_page",
        "engagment_time_sec",
        *(c for c in CHANNEL_PARAMS if c in picked),
        *(extra_params or {}),
        "ecommerce_transaction_id",
        "ecommerce_purchase_revenue",
        "conversions",
    )


def event_flag(event_name: str) -> Column:
    """1 on that kind of event, else 0."""
    return F.when(F.col("event_name") == event_name, 1).otherwise(0)
