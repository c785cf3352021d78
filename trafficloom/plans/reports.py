"""The two daily reports, from raw events to report rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trafficloom.functions.labels import LANDING_PAGE_UNSET
from trafficloom.operators.events import flatten_events
from trafficloom.operators.reports import landing_report, source_medium_report
from trafficloom.operators.sessions import sessionize
from trafficloom.schemas import CHANNEL, GEO


def landing_flat(export: DataFrame, conversion_event: str | None = None, **options) -> DataFrame:
    """Flat events with the channel of the event and any event's transaction id."""
    return flatten_events(export, conversion_event, "event_params", "any_event", **options)


def landing_sessions(flat: DataFrame, landing_page_unset: str = LANDING_PAGE_UNSET, sketch_pages: bool = False) -> DataFrame:
    return sessionize(flat, ["landing_page", *GEO, *CHANNEL], "distinct", landing_page_unset, sketch_pages)


def landing_page_report(
    export: DataFrame,
    conversion_event: str | None = None,
    landing_page_unset: str = LANDING_PAGE_UNSET,
    sketch_pages: bool = False,
) -> DataFrame:
    """Events to the daily report by landing page, geography and channel.

    ``sketch_pages`` adds a sketch of each row's distinct pages (schema ``TARGET_WITH_PAGES``), from
    which a report query tells the distinct pages of any days and dimensions together;
    ``unique_page_views`` adds up pages per session.
    """
    return landing_report(landing_sessions(landing_flat(export, conversion_event), landing_page_unset, sketch_pages))


def acquisition_flat(export: DataFrame, conversion_event: str | None = None, **options) -> DataFrame:
    """Flat events with the user's traffic source and purchase-like transactions only."""
    return flatten_events(export, conversion_event, "traffic_source", "purchase_events", **options)


def acquisition_sessions(flat: DataFrame) -> DataFrame:
    return sessionize(flat, ["utm_source", "utm_medium"], "row")


def acquisition_report(export: DataFrame, conversion_event: str | None = None) -> DataFrame:
    """Events to the daily report by source and medium."""
    return source_medium_report(acquisition_sessions(acquisition_flat(export, conversion_event)))
