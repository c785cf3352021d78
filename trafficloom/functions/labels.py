"""Labels for missing dimension values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. The landing-page label has no closing parenthesis: dashboards
# built on the unified table already filter on it, so it stays the default.
NOT_SET = "(not set)"
DIRECT = "(direct)"
NONE = "(none)"
LANDING_PAGE_UNSET = "(not set"

CHANNEL_LABELS = {"utm_source": DIRECT, "utm_medium": NONE, "utm_campaign": NOT_SET}


def label_empty(column: Column, label: str) -> Column:
    """Replace NULL and the empty string."""
    return F.when(column != "", column).otherwise(F.lit(label))


def label_null(column: Column, label: str) -> Column:
    """Replace NULL only; an empty string is kept."""
    return F.coalesce(column, F.lit(label))
