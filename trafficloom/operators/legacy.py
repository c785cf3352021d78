"""From landed legacy report pages to rows of the unified table, and the backfill windows."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficloom.functions.dates import iso_date, shard_day
from trafficloom.functions.labels import NOT_SET
from trafficloom.functions.numbers import parse_number
from trafficloom.schemas import (
    DEFAULT_GOAL_METRIC,
    LEGACY_DIMENSIONS,
    LEGACY_METRICS,
    METRIC_TYPES,
    RATIO_METRIC,
    legacy_metric_names,
)


def _position(headers: Column, name: str, strict: bool) -> Column:
    """0-based position of a header; -1 where it is missing."""
    at = F.array_position(headers, name).cast("int") - 1
    if not strict:
        return at
    missing = F.raise_error(F.lit(f"report page without {name}")).cast("int")
    return F.when(F.coalesce(at, F.lit(-1)) < 0, missing).otherwise(at)


def _last_range_value(ranges: Column, at: Column) -> Column:
    """A metric's text from the last date range that has one at that position."""
    in_order = F.transform(ranges, lambda r: F.get(r["values"], at))
    latest = F.try_element_at(F.filter(in_order, lambda v: v.isNotNull()), F.lit(-1))
    return F.coalesce(F.get(F.try_element_at(ranges, F.lit(-1))["values"], at), latest)


def flatten_report_pages(
    pages: DataFrame, goal_metric: str = DEFAULT_GOAL_METRIC, strict: bool = True
) -> DataFrame:
    """One row of text columns per legacy report row, named by its headers.

    Values are paired with headers by position; a value list shorter than the
    headers leaves NULLs. Responses without reports or rows give no rows. With
    several date ranges in a row, the last one wins. ``strict`` fails on a page
    that lacks one of the expected headers.
    """
    report = pages.select(F.explode("reports").alias("report")).select(
        F.col("report.columnHeader.dimensions").alias("dimension_headers"),
        F.col("report.columnHeader.metricHeader.metricHeaderEntries.name").alias("metric_headers"),
        F.explode("report.data.rows").alias("row"),
    )
    columns = {
        name: F.get(F.col("row.dimensions"), _position(F.col("dimension_headers"), name, strict))
        for name in LEGACY_DIMENSIONS
    } | {
        name: _last_range_value(F.col("row.metrics"), _position(F.col("metric_headers"), name, strict))
        for name in legacy_metric_names(goal_metric)
    }
    return report.select(*(value.alias(name) for name, value in columns.items()))


def legacy_landing_page(host: Column, path: Column) -> Column:
    """The page as a full https URL, unless the path is the unset label."""
    return F.when(path != NOT_SET, F.concat(F.lit("https://"), host, path)).otherwise(path)


def _source_metric(unified: str, goal_metric: str) -> str:
    (legacy,) = (name for name, column in LEGACY_METRICS.items() if column == unified)
    return goal_metric if legacy == DEFAULT_GOAL_METRIC else legacy


def _raw(name: str) -> Column:
    return F.col(f"`{name}`")


def legacy_metrics(goal_metric: str = DEFAULT_GOAL_METRIC, lenient: bool = False) -> dict[str, Column]:
    """Each unified metric, cast from its legacy text to the declared type."""
    return {
        unified: parse_number(_raw(_source_metric(unified, goal_metric)), kind.simpleString(), lenient)
        for unified, kind in METRIC_TYPES.items()
    }


def normalize_legacy(
    rows: DataFrame,
    goal_metric: str = DEFAULT_GOAL_METRIC,
    time_on_page: str = "total",
    lenient: bool = False,
) -> DataFrame:
    """Legacy text rows in the columns and types of the unified table.

    One expression per output column: the goal may be a metric that is pulled
    anyway and both columns exist. The legacy time on page is a total, which by
    default lands unchanged in the per-session column; ``per_session`` divides it.
    """
    metrics = legacy_metrics(goal_metric, lenient)
    if time_on_page == "per_session":
        metrics[RATIO_METRIC] = F.round(F.try_divide(metrics[RATIO_METRIC], metrics["sessions"]), 2)
    elif time_on_page != "total":
        raise ValueError(f"unknown time_on_page: {time_on_page!r}")
    page = legacy_landing_page(_raw("ga:hostname"), _raw("ga:landingPagePath"))
    dimensions = {
        unified: _raw(legacy)
        for legacy, unified in LEGACY_DIMENSIONS.items()
        if unified not in ("date", "landing_page")
    }
    return rows.select(
        shard_day(_raw("ga:date")).alias("date"),
        page.alias("landing_page"),
        *(value.alias(name) for name, value in dimensions.items()),
        *(value.alias(name) for name, value in metrics.items()),
    )


def split_bad_metrics(
    rows: DataFrame, goal_metric: str = DEFAULT_GOAL_METRIC
) -> tuple[DataFrame, DataFrame]:
    """Rows whose metrics all parse, and the others, both as text."""
    parsed = legacy_metrics(goal_metric, lenient=True)
    unreadable = [
        _raw(_source_metric(unified, goal_metric)).isNotNull() & value.isNull()
        for unified, value in parsed.items()
    ]
    bad = reduce(lambda a, b: a | b, unreadable)
    return rows.filter(~bad), rows.filter(bad)


def month_windows(spark: SparkSession, begin: str | dt.date, end: dt.date) -> DataFrame:
    """Calendar-month windows from ``begin`` to ``end``, newest first; none if inverted."""
    bounds = spark.range(1).select(
        F.lit(iso_date(begin)).alias("begin"), F.lit(end).alias("end")
    )
    return split_months(bounds).orderBy(F.desc("window_start"))


def split_months(bounds: DataFrame) -> DataFrame:
    """One row per calendar month touched by each row's ``begin`` .. ``end``."""
    months = F.when(
        F.col("begin") <= F.col("end"),
        F.sequence(F.trunc("begin", "MM").cast("date"), F.col("end"), F.expr("interval 1 month")),
    )
    return bounds.select("begin", "end", F.explode(months).alias("month")).select(
        F.greatest("month", "begin").alias("window_start"),
        F.least(F.last_day("month"), F.col("end")).alias("window_end"),
    )


def backfill_bound(target: DataFrame) -> DataFrame:
    """The day before the first day of the target: the last day a backfill may fill."""
    return target.agg(F.date_sub(F.min("date"), 1).alias("bound"))
