"""From flat events to one row per day, session id and user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom.functions.labels import LANDING_PAGE_UNSET, label_null

SESSION = ["ga_session_id", "user_pseudo_id", "event_date"]  # finest key first, as in IDENTITY

#: A sketch counts a few hundred values exactly, and any number within some percent.
PAGE_SKETCH = "page_sketch"
SKETCH_BITS = 12

_PICKS = {
    "country": "geo_country",
    "region": "geo_region",
    "city": "geo_city",
    "utm_source": "utm_source",
    "utm_medium": "utm_medium",
    "utm_campaign": "utm_campaign",
}
_SUMS = {
    "entrance": "entrance",
    "new_user": "new_user",
    "engagment_time_sec": "engagment_time_sec",
    "conversions": "conversions",
    "ecommerce_revenue": "ecommerce_purchase_revenue",
}


def present(key: str) -> Column:
    """Distinct count of a column that is itself a grouping key: 0 if NULL, else 1."""
    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.lit(1)).cast("bigint")


def _one_counted_value_per_row(flat: DataFrame) -> DataFrame:
    """Lay out both columns to be counted distinctly as (``counted``, ``value``) rows.

    Nearly every event carries a page or a transaction, not both, so this stays
    close to one row per event. Only the first row of an event (``first``) may
    feed the sums.
    """
    def entry(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("counted"), value.alias("value"))

    page, transaction = F.col("pageview_location"), F.col("ecommerce_transaction_id")
    entries = (
        F.when(
            page.isNotNull() & transaction.isNotNull(),
            F.array(entry("page", page), entry("transaction", transaction)),
        )
        .when(page.isNotNull(), F.array(entry("page", page)))
        .when(transaction.isNotNull(), F.array(entry("transaction", transaction)))
    )
    return flat.select("*", F.posexplode_outer(entries).alias("pos", "entry")).select(
        "*",
        (F.coalesce("pos", F.lit(0)) == 0).alias("first"),
        F.col("entry.counted").alias("counted"),
        F.col("entry.value").alias("value"),
    )


def sessionize(
    flat: DataFrame,
    dimensions: list[str],
    transactions: str = "distinct",
    landing_page_unset: str = LANDING_PAGE_UNSET,
    sketch_pages: bool = False,
) -> DataFrame:
    """One row per (day, session id, user); neither id is kept.

    ``dimensions`` names the session attributes to carry: any of ``landing_page``,
    the geography and the ``utm_*`` columns. Each takes its greatest value.
    Events without a session id or user form groups of their own and stay in.
    ``transactions``: count ``distinct`` ids of the session, or every ``row`` with one.

    ``sketch_pages`` adds ``page_sketch``, a mergeable sketch of the session's distinct pages.

    The distinct counts run in two steps, first per (session, counted value) and
    then per session. Both combine before their shuffle, so one session or the
    group without any id may hold any share of the rows.
    """
    if transactions not in ("distinct", "row"):
        raise ValueError(f"unknown transactions: {transactions!r}")
    flat = flat.withColumn(
        "landing_page", label_null(F.col("landing_page"), landing_page_unset)
    )
    picks = {d: _PICKS.get(d, d) for d in dimensions}
    page = F.col("pageview_location")
    sketch = lambda pages: [F.hll_sketch_agg(pages, F.lit(SKETCH_BITS)).alias(PAGE_SKETCH)] if sketch_pages else []

    if transactions == "distinct":
        rows = _one_counted_value_per_row(flat)
        per_value = rows.groupBy(*SESSION, "counted", "value").agg(
            *(F.max(source).alias(name) for name, source in picks.items()),
            *(F.sum(F.when(F.col("first"), F.col(source))).alias(name) for name, source in _SUMS.items()),
            F.count("value").alias("hits"),
        )
        is_page = F.col("counted") == "page"
        sessions = per_value.groupBy(*SESSION).agg(
            *(F.max(name).alias(name) for name in picks),
            F.coalesce(F.sum(F.when(is_page, F.col("hits"))), F.lit(0)).alias("page_views"),
            F.count_if(is_page).alias("unique_page_views"),
            *(F.sum(name).alias(name) for name in _SUMS),
            F.count_if(F.col("counted") == "transaction").alias("ecommerce_transactions"),
            *sketch(F.when(is_page, F.col("value"))),
        )
    else:
        sessions = flat.groupBy(*SESSION).agg(
            *(F.max(source).alias(name) for name, source in picks.items()),
            F.count(page).alias("page_views"),
            F.count_distinct(page).alias("unique_page_views"),
            *(F.sum(source).alias(name) for name, source in _SUMS.items()),
            F.count("ecommerce_transaction_id").alias("ecommerce_transactions"),
            *sketch(page),
        )

    return sessions.select(
        "event_date",
        *picks,
        present("user_pseudo_id").alias("users"),
        "page_views",
        "unique_page_views",
        "entrance",
        "new_user",
        present("ga_session_id").alias("sessions"),
        "engagment_time_sec",
        "conversions",
        "ecommerce_revenue",
        "ecommerce_transactions",
        *([PAGE_SKETCH] if sketch_pages else []),
    )
