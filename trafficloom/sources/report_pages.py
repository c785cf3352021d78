"""Read landed pages of the legacy report service."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficloom.schemas import REPORT_PAGE
from trafficloom.storage import empty_files

LANDED = T.StructType([*REPORT_PAGE, T.StructField("window_start", T.DateType())])
UNREADABLE = "unreadable"
WINDOW_FOLDER = "window_start="


def read_report_pages(spark: SparkSession, root: str, one_page_per_file: bool = True) -> DataFrame:
    """All landed pages: ``reports``, the ``window_start`` they were pulled for, and
    ``unreadable``, which is NULL for a good page.

    ``root`` holds one ``window_start=yyyy-MM-dd`` folder per pulled window, so a
    job for one month opens that month only. Files hold one response each, or
    one response per line.

    A page that does not parse, such as one cut off while it was written, keeps its text in
    ``unreadable``. A response without reports, such as an error message, and a file without
    a byte are named there: none of them may pass for the empty last page of a window.
    """
    schema = T.StructType([*LANDED, T.StructField(UNREADABLE, T.StringType())])
    reader = spark.read.schema(schema).option("multiLine", one_page_per_file).option("mode", "PERMISSIVE")
    pages = reader.option("columnNameOfCorruptRecord", UNREADABLE).json(root)
    no_reports = F.when(F.col("reports").isNull(), F.lit("a response without reports"))
    found = pages.select("reports", "window_start", F.coalesce(UNREADABLE, no_reports).alias(UNREADABLE))
    if not one_page_per_file:
        return found
    # Spark's readers pass over a file without a byte; such files should be none, or few
    empty = empty_files(spark, f"{root}/{WINDOW_FOLDER}*/*")
    named = [(None, dt.date.fromisoformat(f.removeprefix(WINDOW_FOLDER)), f"an empty file: {f}/{n}") for f, n in empty]
    return found.union(spark.createDataFrame(named, schema)) if named else found


def next_page_token(reports: str = "reports") -> Column:
    """Continuation token of a response: that of its last report."""
    return F.try_element_at(F.col(reports), F.lit(-1))["nextPageToken"]


def stage_report_pages(pages: DataFrame, folder: str) -> DataFrame:
    """The pages parsed once into a folder per window, with whether each is a last page."""
    if UNREADABLE not in pages.columns:
        pages = pages.withColumn(UNREADABLE, F.lit(None).cast("string"))
    staged = pages.withColumn("is_last", F.col(UNREADABLE).isNull() & next_page_token().isNull())
    staged.write.partitionBy("window_start").parquet(folder)
    schema = T.StructType([f for f in staged.schema if f.name != "window_start"]).add("window_start", T.DateType())
    return pages.sparkSession.read.schema(schema).parquet(folder)


def last_pages(staged: DataFrame) -> DataFrame:
    """Per staged window: its pages, how many of them are a last page, and how many are unreadable.

    A window is complete if all its pages can be read and exactly one of them has no
    continuation token.
    """
    return staged.groupBy("window_start").agg(
        F.count("*").alias("pages"),
        F.count_if("is_last").alias("last_pages"),
        F.count(UNREADABLE).alias("unreadable_pages"),
    )
