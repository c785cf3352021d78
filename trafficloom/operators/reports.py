"""From sessions to the daily reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficloom.functions.labels import CHANNEL_LABELS, NOT_SET, label_empty, label_null
from trafficloom.functions.numbers import rounded_ratio
from trafficloom.operators.sessions import PAGE_SKETCH
from trafficloom.schemas import GEO, LANDING_DIMENSIONS, METRICS, RATIO_METRIC, SOURCE_MEDIUM_DIMENSIONS


def label_dimensions(frame: DataFrame) -> DataFrame:
    """Fill in the labels of missing geography and channel values.

    This is a step before the grouping, not an alias inside it: Spark would
    group an alias of the same name by the raw column and keep NULL, the empty
    string and the label itself as separate rows.
    """
    labels = {c: label_empty(F.col(c), NOT_SET) for c in GEO}
    labels |= {c: label_null(F.col(c), label) for c, label in CHANNEL_LABELS.items()}
    return frame.withColumns({c: v for c, v in labels.items() if c in frame.columns})


def _report(sessions: DataFrame, dimensions: list[str]) -> DataFrame:
    labelled = label_dimensions(sessions.withColumnRenamed("event_date", "date"))
    metrics = {
        "users": F.sum("users"),
        "new_users": F.sum("new_user"),
        "entrances": F.sum("entrance"),
        "sessions": F.sum("sessions"),
        "page_views": F.sum("page_views"),
        "unique_page_views": F.sum("unique_page_views"),
        RATIO_METRIC: rounded_ratio(F.sum("engagment_time_sec"), F.sum("sessions")),
        "conversions": F.sum("conversions"),
        "ecommerce_revenue": F.round(F.sum("ecommerce_revenue"), 2),
        "ecommerce_transactions": F.sum("ecommerce_transactions"),
    }
    sketches = [F.hll_union_agg(PAGE_SKETCH).alias(PAGE_SKETCH)] if PAGE_SKETCH in sessions.columns else []
    return labelled.groupBy(*dimensions).agg(*(metrics[m].alias(m) for m in METRICS), *sketches)


def landing_report(sessions: DataFrame) -> DataFrame:
    """Daily report by landing page, geography and channel: 8 dimensions, 10 metrics."""
    return _report(sessions, LANDING_DIMENSIONS)


def source_medium_report(sessions: DataFrame) -> DataFrame:
    """Daily report by source and medium: 3 dimensions, 10 metrics."""
    return _report(sessions, SOURCE_MEDIUM_DIMENSIONS)


def ranked(report: DataFrame) -> DataFrame:
    """Most sessions first, dimensions breaking ties. For presentation, never before a write."""
    dimensions = [c for c in report.columns if c not in METRICS]
    return report.orderBy(F.desc("sessions"), *dimensions)
