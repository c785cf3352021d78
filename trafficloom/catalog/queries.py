"""Every operator as a query over the sample tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trafficloom.functions.dates import iso_day_or_null, utc_today
from trafficloom.operators.events import explode_params
from trafficloom.operators.legacy import (
    backfill_bound,
    flatten_report_pages,
    legacy_landing_page,
    legacy_metrics,
    normalize_legacy,
    split_months,
)
from trafficloom.operators.legacy import month_windows as legacy_windows
from trafficloom.operators.report_query import DISTINCT_PAGES, ReportQuery, legacy_report
from trafficloom.operators.reports import label_dimensions, ranked
from trafficloom.operators.sampling import DrawnLayout
from trafficloom.plans import reports
from trafficloom.plans.jobs import backfill, daily_pull, initial_pull
from trafficloom.plans.sql_reports import LANDING_SQL, SOURCE_MEDIUM_SQL, report_by_sql
from trafficloom.schemas import (
    DEFAULT_GOAL_METRIC,
    EXPORT,
    LANDING_DIMENSIONS,
    LEGACY_METRICS,
    RATIO_METRIC,
    SOURCE_MEDIUM_DIMENSIONS,
)
from trafficloom.session import shared_folder
from trafficloom.sinks.target import append_days, create_target, read_target, review_months, review_sources, stored_days
from trafficloom.sources.export import PARTITION_PREFIX, scan_export, scan_table, shard_days
from trafficloom.sources.report_pages import last_pages, read_report_pages, stage_report_pages
from trafficloom.sources.sample_tables import (
    SAMPLE_START,
    export_from_events,
    legacy_rows_from_pages,
    report_from_rows,
    report_pages_from_pages,
)
from trafficloom.storage import child_names, move_folder

CONVERSION = "purchase"
Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_from_events(table(spark, sf_dir, "events"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_pages_from_pages(table(spark, sf_dir, "pages"), DEFAULT_GOAL_METRIC)


def landed_export(spark: SparkSession, sf_dir: str) -> str:
    """The export written as day partitions, as an exporter lands it."""
    root = shared_folder(spark, "export")
    by_day = export(spark, sf_dir).hint("rebalance", "event_date")
    by_day.write.partitionBy("event_date").parquet(root)
    return root


def landed_pages(spark: SparkSession, sf_dir: str) -> str:
    root = shared_folder(spark, "pages")
    pages(spark, sf_dir).write.partitionBy("window_start").json(root)
    return root


# events

def scan_window(spark, sf_dir):
    return scanned(scan_export(spark, landed_export(spark, sf_dir), dt.date(2024, 1, 30), prior_days=6))


def scan_shards(spark, sf_dir):
    """The same window from a shard per day, which holds its day in its name only."""
    root = landed_export(spark, sf_dir)
    for name in child_names(spark, root):
        move_folder(spark, f"{root}/{name}", f"{root}/events_{name.removeprefix(PARTITION_PREFIX)}")
    shards = scan_export(spark, root, dt.date(2024, 1, 30), 6, table_prefix="events_", day_from_name=True)
    return scanned(shards)


def scan_table_window(spark, sf_dir):
    """The same window by name, from a view partitioned by its day."""
    root, view = landed_export(spark, sf_dir), f"export_{uuid.uuid4().hex}"
    spark.read.schema(EXPORT).parquet(root).createOrReplaceTempView(view)
    return scanned(scan_table(spark, view, dt.date(2024, 1, 30), 6))


def scanned(days: DataFrame) -> DataFrame:
    return days.select(
        "event_date",
        "event_timestamp",
        "user_first_touch_timestamp",
        "event_name",
        "user_pseudo_id",
        F.col("device.category").alias("device_category"),
        F.col("geo.country").alias("geo_country"),
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
        F.when(F.col("event_params").isNotNull(), F.size("event_params")).cast("bigint").alias("n_params"),
    )


def param_explode(spark, sf_dir):
    return explode_params(export(spark, sf_dir)).select(
        "event_date",
        "event_timestamp",
        "event_name",
        "user_pseudo_id",
        F.col("param.key").alias("param_key"),
        F.col("param.value.string_value").alias("string_value"),
        F.col("param.value.int_value").alias("int_value"),
    )


def flat(spark, sf_dir):
    return reports.landing_flat(export(spark, sf_dir), CONVERSION)


def flat_columns(*columns: str) -> Query:
    def query(spark, sf_dir):
        return flat(spark, sf_dir).select("event_date", "event_time", "event_name", "user_pseudo_id", *columns)

    return query


def flat_acquisition(spark, sf_dir):
    return reports.acquisition_flat(export(spark, sf_dir), CONVERSION)


def purchase_transactions(spark, sf_dir):
    return flat_acquisition(spark, sf_dir).select(
        "event_date", "event_time", "event_name", "user_pseudo_id", "ecommerce_transaction_id"
    )


# sessions and reports

def sessions(spark, sf_dir):
    return reports.landing_sessions(flat(spark, sf_dir))


def sessions_acquisition(spark, sf_dir):
    return reports.acquisition_sessions(flat_acquisition(spark, sf_dir))


def two_decimals(frame: DataFrame) -> DataFrame:
    """Money to cents: the last bits of a double sum depend on the order of the rows."""
    return frame.withColumn("ecommerce_revenue", F.round("ecommerce_revenue", 2))


def session_rollup(spark, sf_dir):
    return two_decimals(sessions(spark, sf_dir))


def session_rollup_acquisition(spark, sf_dir):
    return two_decimals(sessions_acquisition(spark, sf_dir))


def session_columns(*columns: str) -> Query:
    def query(spark, sf_dir):
        return sessions(spark, sf_dir).select("event_date", *columns)

    return query


def label_defaults(spark, sf_dir):
    return label_dimensions(sessions(spark, sf_dir)).select("event_date", *LANDING_DIMENSIONS[1:])


def landing(spark, sf_dir):
    return reports.landing_page_report(export(spark, sf_dir), CONVERSION)


def source_medium(spark, sf_dir):
    return reports.acquisition_report(export(spark, sf_dir), CONVERSION)


def report_by_sql_text(text: str) -> Query:
    """A report as SQL with parameters, over a view of the export."""

    def query(spark, sf_dir):
        view = f"export_{uuid.uuid4().hex}"
        export(spark, sf_dir).createOrReplaceTempView(view)
        return report_by_sql(spark, text, view, 29, CONVERSION, dt.date(2024, 1, 30))

    return query


def engagement_ratio(spark, sf_dir):
    return source_medium(spark, sf_dir).select(*SOURCE_MEDIUM_DIMENSIONS, "sessions", RATIO_METRIC)


def ranked_report(spark, sf_dir):
    return ranked(landing(spark, sf_dir))


# legacy

def legacy_rows(spark, sf_dir):
    return flatten_report_pages(pages(spark, sf_dir))


def legacy_pages_flatten(spark, sf_dir):
    landed = read_report_pages(spark, landed_pages(spark, sf_dir), one_page_per_file=False)
    return flatten_report_pages(landed)


def legacy_bad_pages(spark, sf_dir):
    """What is landed of each window, one page per legacy row, of which some were cut off while
    they were written and some hold an error message: pages, those unreadable, last pages, and
    the rows of the others."""
    rows = legacy_rows_from_pages(table(spark, sf_dir, "pages"), DEFAULT_GOAL_METRIC, "page_id")
    last = rows.groupBy("window_start").agg(F.max("page_id").alias("last_page"))
    more = F.when(F.col("page_id") < F.col("last_page"), F.col("page_id").cast("string"))
    page = F.to_json(F.struct(report_from_rows(F.array("row"), more, DEFAULT_GOAL_METRIC).alias("reports")))
    cut = F.when(F.col("page_id") % 10 == 3, F.substring(page, F.lit(1), F.floor(F.length(page) / 2).cast("int")))
    refused = F.when(F.col("page_id") % 10 == 7, F.lit('{"error": {"code": 503}}'))
    root = shared_folder(spark, "pages")
    landed = rows.join(F.broadcast(last), "window_start")  # one row per calendar month of the mapping
    landed.select("window_start", F.coalesce(cut, refused, page).alias("value")).write.partitionBy("window_start").text(root)
    staged = stage_report_pages(read_report_pages(spark, root, one_page_per_file=False), shared_folder(spark, "staged"))
    held = staged.select("window_start", F.explode("reports").alias("report")).groupBy("window_start")
    counted = held.agg(F.sum(F.size("report.data.rows")).alias("legacy_rows"))
    return last_pages(staged).join(counted, "window_start", "left").fillna(0, ["legacy_rows"])


def legacy_metric_types(spark, sf_dir):
    typed = legacy_metrics()
    return legacy_rows(spark, sf_dir).select(
        F.col("`ga:date`").alias("legacy_date"), *(value.alias(name) for name, value in typed.items())
    )


def legacy_pages_url(spark, sf_dir):
    host, path = F.col("`ga:hostname`"), F.col("`ga:landingPagePath`")
    return legacy_rows(spark, sf_dir).select(
        host.alias("host"), path.alias("path"), legacy_landing_page(host, path).alias("landing_page")
    )


def legacy(spark, sf_dir):
    return normalize_legacy(legacy_rows(spark, sf_dir))


def month_windows(spark, sf_dir):
    """Windows from the first legacy day to the day before the export, with what each holds;
    a window may hold nothing."""
    per_day = legacy(spark, sf_dir).groupBy("date").agg(
        F.count("*").alias("legacy_rows"), F.sum("sessions").alias("sessions")
    )
    begin = per_day.agg(F.min("date").alias("begin"), F.lit(None).cast("date").alias("end"))
    bound = backfill_bound(landing(spark, sf_dir))
    end = bound.select(F.lit(None).cast("date").alias("begin"), F.col("bound").alias("end"))
    bounds = begin.unionByName(end).agg(F.max("begin").alias("begin"), F.max("end").alias("end"))
    windows = split_months(bounds).withColumn("month", F.trunc("window_start", "MM"))
    days = per_day.withColumn("month", F.trunc("date", "MM"))
    inside = (windows["month"] == days["month"]) & F.col("date").between(F.col("window_start"), F.col("window_end"))
    held = windows.join(days, inside, "left")
    return held.groupBy("window_start", "window_end").agg(
        F.coalesce(F.sum("legacy_rows"), F.lit(0)).alias("legacy_rows"),
        F.coalesce(F.sum("sessions"), F.lit(0)).alias("sessions"),
    )


def bound(spark, sf_dir):
    return backfill_bound(landing(spark, sf_dir))


# target

def backfilled_target(spark, sf_dir) -> str:
    """The unified table as stored: the report, then all legacy history before it.

    A month without landed pages is one that no page of the sample falls into; it is landed
    here as the service would, with a report without rows, so that a lost one cannot pass.
    """
    target, landed = shared_folder(spark, "target"), shared_folder(spark, "pages")
    create_target(landing(spark, sf_dir), target)
    found = pages(spark, sf_dir)
    begin, until = first_legacy_day(spark, sf_dir), stored_days(spark, target)[0] - dt.timedelta(days=1)
    months = legacy_windows(spark, begin, until).select(F.trunc("window_start", "MM").alias("window_start"))
    missing = months.join(found.select("window_start").distinct(), "window_start", "left_anti")
    no_rows = F.array(F.struct(F.lit(None), F.lit(None), F.lit(None))).cast(found.schema["reports"].dataType)
    nothing = missing.select(no_rows.alias("reports"), "window_start")
    found.select("reports", "window_start").union(nothing).write.partitionBy("window_start").json(landed)
    backfill(spark, target, landed, begin, one_page_per_file=False)
    return target


def first_legacy_day(spark, sf_dir) -> dt.date:
    """The first day of the first month that pages were pulled for; with no page at all, of the sample's."""
    first = pages(spark, sf_dir).agg(F.min("window_start").alias("day")).first()["day"]
    return first or SAMPLE_START


def backfill_union(spark, sf_dir):
    return read_target(spark, backfilled_target(spark, sf_dir))


def backfill_windows(spark, sf_dir):
    """The windows a backfill loads into a target that holds the report, newest first."""
    target = shared_folder(spark, "target")
    create_target(landing(spark, sf_dir), target)
    bound = stored_days(spark, target)[0] - dt.timedelta(days=1)
    begin = SAMPLE_START - dt.timedelta(days=47)  # history may begin before the first landed page
    order = Window.orderBy(F.desc("window_start"))  # one row per month
    return legacy_windows(spark, begin, bound).withColumn("nth", F.row_number().over(order).cast("long") - 1)


def daily_incremental(spark, sf_dir):
    """An initial pull of the first days, legacy rows before them, then a pull of a window that
    overlaps both: what the export does not hold stays."""
    root, target = landed_export(spark, sf_dir), shared_folder(spark, "target")
    days = sorted(shard_days(child_names(spark, root), PARTITION_PREFIX).values())
    first, middle, last = days[0], days[len(days) // 2], days[-1]
    initial_pull(spark, root, target, (middle - first).days, CONVERSION, as_of=middle)
    append_days(legacy(spark, sf_dir).filter(F.col("date") < F.lit(first)), target)
    daily_pull(spark, root, target, (last - first).days + 400, CONVERSION, as_of=last)
    return read_target(spark, target)


def pull_totals(spark, sf_dir):
    """What a pull of the whole export says it has written, counted while it wrote."""
    root, target = landed_export(spark, sf_dir), shared_folder(spark, "target")
    days = sorted(shard_days(child_names(spark, root), PARTITION_PREFIX).values())
    written = initial_pull(spark, root, target, (days[-1] - days[0]).days, CONVERSION, as_of=days[-1])
    return spark.createDataFrame(written)  # one row per day


def unified(spark, sf_dir):
    return legacy(spark, sf_dir).unionByName(landing(spark, sf_dir))


def target_review(spark, sf_dir):
    return review_months(backfill_union(spark, sf_dir))


def target_sources(spark, sf_dir):
    return review_sources(backfill_union(spark, sf_dir))


def target_bound(spark, sf_dir):
    """The bound of a stored target, from its first day."""
    return backfill_bound(backfill_union(spark, sf_dir))


# report query

EVERYTHING = ("1900-01-01", "9999-12-31")


def report(spark, sf_dir) -> ReportQuery:
    return ReportQuery(unified(spark, sf_dir), as_of=dt.date(2024, 1, 31)).date_range([EVERYTHING])


def report_distinct_pages(spark, sf_dir):
    """Distinct pages over all days, from sketches in the daily rows, beside the sum of daily ones."""
    rows = reports.landing_page_report(export(spark, sf_dir), CONVERSION, sketch_pages=True)
    wanted = ReportQuery(rows, as_of=dt.date(2024, 1, 31)).date_range([EVERYTHING]).dimensions(["utm_medium", "country"])
    return wanted.metrics(["ga:uniquePageviews", DISTINCT_PAGES]).get().rows


def report_default_today(spark, sf_dir):
    """The default range counts back from today, so the rows are moved up to end today."""
    rows = unified(spark, sf_dir)
    newest = rows.agg(F.max("date").alias("newest"))
    today = F.lit(utc_today())
    moved = rows.crossJoin(newest).withColumn("date", F.date_add(today, F.date_diff("date", "newest"))).drop("newest")
    return ReportQuery(moved).metrics(["users", "sessions"]).get().rows


def report_query_default(spark, sf_dir):
    return ReportQuery(unified(spark, sf_dir), as_of=dt.date(2024, 1, 31)).get().rows


def report_query(spark, sf_dir):
    wanted = report(spark, sf_dir).dimensions(["ga:country", "utm_medium"]).metrics(list(LEGACY_METRICS))
    return wanted.get().rows


def report_date_ranges(spark, sf_dir):
    ranges = [("2023-12-01", "2024-01-15"), ("2024-01-10", "2024-01-31")]
    wanted = report(spark, sf_dir).date_range(ranges).dimensions(["ga:medium"])
    return wanted.metrics(["ga:users", "sessions", RATIO_METRIC]).get().rows


def report_many_ranges(spark, sf_dir):
    """A thousand overlapping ranges of up to 45 days, and one of everything."""
    starts = [SAMPLE_START + dt.timedelta(days=7 * k % 120) for k in range(1000)]
    ranges = [(first, first + dt.timedelta(days=k % 45)) for k, first in enumerate(starts)]
    wanted = report(spark, sf_dir).date_range([*ranges, EVERYTHING]).dimensions(["ga:medium"])
    return wanted.metrics(["ga:users", "sessions", RATIO_METRIC]).get().rows


def report_segment(spark, sf_dir):
    filters = {
        "organic": F.col("utm_medium") == "organic",
        "paid": F.col("utm_medium") == "cpc",
        "buyers": F.col("ecommerce_transactions") > 0,
    }
    query = ReportQuery(
        unified(spark, sf_dir), as_of=dt.date(2024, 1, 31), segment_filters=filters
    )
    wanted = query.date_range([EVERYTHING]).segment(["paid", "buyers", "organic"]).dimensions(["date"])
    return wanted.metrics(["users", "sessions", "ga:transactionRevenue"]).get().rows


def report_page(spark, sf_dir):
    wanted = report(spark, sf_dir).dimensions(["date", "ga:country", "ga:source"])
    return wanted.metrics(["sessions", "ga:pageviews"]).page_size(500).page_token("250").get().rows


def report_page_large(spark, sf_dir):
    """A page too large for one task, by rank, from far inside the report."""
    wanted = report(spark, sf_dir).dimensions(LANDING_DIMENSIONS).metrics(["sessions", "ga:pageviews"])
    return wanted.page_size(20_000).page_token("750").get().rows


def report_follow_tokens(spark, sf_dir):
    """Every page of a report, each asked for with the token of the one before it, with its number."""
    query = report(spark, sf_dir).dimensions(["date", "ga:country"]).metrics(["users", "sessions"])
    stored = query.get().rows
    query = query.page_size(max(1, -(-stored.count() // 4)))
    pages, token = [], "0"
    while token is not None:
        page = query.page_token(token).get()
        pages.append(page.rows.withColumn("page", F.lit(len(pages))))
        token = page.next_page_token()
    return reduce(DataFrame.union, pages)


def report_sample_clustered(spark, sf_dir):
    """The sampled report from a copy of the table that is cut by draws, of which only the
    files of the drawn buckets are read."""
    layout, folder = DrawnLayout(seed=7), shared_folder(spark, "drawn")
    layout.write(unified(spark, sf_dir), folder)
    wanted = ReportQuery(layout.read(spark, folder), layout=layout).date_range([EVERYTHING]).dimensions(["date"])
    return wanted.metrics(["users", "sessions"]).sampling_level("SMALL", fraction=0.25, seed=7).get().rows


def report_sample(spark, sf_dir):
    wanted = report(spark, sf_dir).dimensions(["date"]).metrics(["users", "sessions"])
    return wanted.sampling_level("SMALL", fraction=0.25, seed=7).get().rows


def report_all_pages(spark, sf_dir):
    """Every page of a report, each read on its own, with its number."""
    wanted = report(spark, sf_dir).dimensions(["date", "ga:country"]).metrics(["sessions"]).page_size(2000)
    pages = [p.withColumn("page", F.lit(k)) for k, p in enumerate(wanted.get().pages())]
    return reduce(DataFrame.union, pages)


def legacy_report_preset(spark, sf_dir):
    """All pages of the historical pull."""
    return legacy_report(unified(spark, sf_dir), *EVERYTHING).get().paged()


def iso_date_check(spark, sf_dir):
    """Order days spelled in valid and invalid ways, and the date read from each."""
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    spelled = (
        F.when(key % 5 == 0, F.date_format(day, "yyyyMMdd"))
        .when(key % 5 == 1, F.concat(F.date_format(day, "yyyy-MM"), F.lit("-31")))
        .when(key % 5 == 2, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" ")))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", spelled.alias("spelled"))
    return orders.withColumn("day", iso_day_or_null(F.col("spelled")))


QUERIES: dict[str, Query] = {
    "scan_window": scan_window,
    "scan_shards": scan_shards,
    "scan_table_window": scan_table_window,
    "param_explode": param_explode,
    "param_pivot": flat_columns(
        "ga_session_id", "ga_session_number", "page_title", "pageview_location", "landing_page",
        "utm_source", "utm_medium", "utm_campaign",
    ),
    "event_times": flat_columns("user_first_touch_time"),
    "event_flags": flat_columns("entrance", "new_user"),
    "engagement_seconds": flat_columns("engagment_time_sec"),
    "event_revenue": flat_columns("ecommerce_purchase_revenue"),
    "conversion_count": flat_columns("conversions"),
    "purchase_transactions": purchase_transactions,
    "event_flatten": flat,
    "event_flatten_acquisition": flat_acquisition,
    "session_rollup": session_rollup,
    "session_rollup_acquisition": session_rollup_acquisition,
    "session_landing_page": session_columns("landing_page"),
    "user_session_flags": session_columns("users", "sessions"),
    "page_views": session_columns("page_views", "unique_page_views"),
    "label_defaults": label_defaults,
    "engagement_ratio": engagement_ratio,
    "source_medium_report": source_medium,
    "landing_report": landing,
    "source_medium_report_sql": report_by_sql_text(SOURCE_MEDIUM_SQL),
    "landing_report_sql": report_by_sql_text(LANDING_SQL),
    "ranked_report": ranked_report,
    "legacy_pages_flatten": legacy_pages_flatten,
    "legacy_bad_pages": legacy_bad_pages,
    "legacy_metric_types": legacy_metric_types,
    "legacy_landing_page": legacy_pages_url,
    "legacy_normalize": legacy,
    "month_windows": month_windows,
    "backfill_bound": bound,
    "backfill_union": backfill_union,
    "daily_incremental": daily_incremental,
    "pull_totals": pull_totals,
    "backfill_windows": backfill_windows,
    "target_review": target_review,
    "target_sources": target_sources,
    "target_bound": target_bound,
    "report_query_default": report_query_default,
    "report_query": report_query,
    "report_distinct_pages": report_distinct_pages,
    "report_date_ranges": report_date_ranges,
    "report_many_ranges": report_many_ranges,
    "report_segment": report_segment,
    "report_default_today": report_default_today,
    "report_page": report_page,
    "report_page_large": report_page_large,
    "report_follow_tokens": report_follow_tokens,
    "report_all_pages": report_all_pages,
    "report_sample": report_sample,
    "report_sample_clustered": report_sample_clustered,
    "legacy_report_preset": legacy_report_preset,
    "iso_date_check": iso_date_check,
}
