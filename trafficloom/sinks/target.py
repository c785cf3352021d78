"""The unified table: create it, replace days, append months, review it.

A target is a folder of Parquet files (anything with a slash) or a catalog
table; both are partitioned by ``date``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficloom.schemas import TARGET
from trafficloom.session import shared_folder
from trafficloom.storage import child_names, delete_folder


def is_folder(target: str) -> bool:
    return "/" in target


def read_target(spark: SparkSession, target: str, schema: T.StructType = TARGET) -> DataFrame:
    stored = spark.read.schema(schema).parquet(target) if is_folder(target) else spark.table(target)
    return stored.select(*schema.fieldNames())  # partition columns are read last


def conform(report: DataFrame, schema: T.StructType = TARGET) -> DataFrame:
    """Columns in target order and type."""
    return report.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def _by_day(report: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of a day together, so that each day gets few files.

    A rebalance, unlike a plain repartition, lets adaptive execution split a day
    that holds far more rows than the others.
    """
    return conform(report, schema).hint("rebalance", "date")


@dataclass(frozen=True)
class DayTotal:
    """What was written for a day."""

    date: dt.date
    report_rows: int
    users: int
    sessions: int
    page_views: int
    conversions: int
    ecommerce_revenue: float
    ecommerce_transactions: int


class DayTotals:
    """Rows and totals per day, counted by the tasks that write them, so that no second scan is
    needed. The days have to be known; each takes a handful of counters."""

    #: Days that one observation counts; more would not compile into one piece of code.
    AT_ONCE = 30

    def __init__(self, days: Iterable[dt.date]):
        self.days = sorted(set(days))
        self.observed: list[tuple[list[dt.date], Observation]] = []

    def watch(self, rows: DataFrame) -> DataFrame:
        """The rows, which are counted by the next action on them; this must be the last step
        before a write, or repeated tasks of an earlier one would count twice."""
        names = [f.name for f in fields(DayTotal)][2:]
        for start in range(0, len(self.days), self.AT_ONCE):
            some, observation = self.days[start : start + self.AT_ONCE], Observation()
            counters = []
            for k, day in enumerate(some):
                here = F.col("date") == F.lit(day)
                counters.append(F.count_if(here).alias(f"{k} rows"))
                counters += [F.sum(F.when(here, F.col(name))).alias(f"{k} {name}") for name in names]
            rows = rows.observe(observation, *counters)
            self.observed.append((some, observation))
        return rows

    def totals(self) -> list[DayTotal]:
        """A total per day, also of days without rows. Waits for the write."""
        names, found = [f.name for f in fields(DayTotal)][2:], []
        for some, observation in self.observed:
            seen = observation.get
            for k, day in enumerate(some):
                sums = {name: seen[f"{k} {name}"] or 0 for name in names}
                sums["ecommerce_revenue"] = round(float(sums["ecommerce_revenue"]), 2)
                found.append(DayTotal(day, seen[f"{k} rows"], **sums))
        return sorted(found, key=lambda total: total.date)


def create_target(report: DataFrame, target: str, schema: T.StructType = TARGET, totals: DayTotals | None = None) -> None:
    """Write a new target; fails if there is one already."""
    _save(_watched(_by_day(report, schema), totals).write.mode("errorifexists"), target)


def append_days(report: DataFrame, target: str, schema: T.StructType = TARGET, totals: DayTotals | None = None) -> None:
    """Add rows to the target."""
    _save(_watched(_by_day(report, schema), totals).write.mode("append"), target)


def _watched(rows: DataFrame, totals: DayTotals | None) -> DataFrame:
    return rows if totals is None else totals.watch(rows)


def _save(writer: DataFrameWriter, target: str) -> None:
    writer = writer.format("parquet").partitionBy("date")
    writer.save(target) if is_folder(target) else writer.saveAsTable(target)


def replace_days(
    report: DataFrame,
    target: str,
    days: Iterable[dt.date],
    schema: T.StructType = TARGET,
    totals: DayTotals | None = None,
) -> None:
    """Make the target hold exactly ``report`` for the given days, and leave all others.

    The report is computed once into a staging folder, which also tells the days
    that have rows, and feeds ``totals`` on its way. Those are swapped in by a dynamic partition overwrite. That
    would leave a day untouched whose new result is empty, so such days are
    dropped afterwards. Running it again with the same input changes nothing.
    """
    spark = report.sparkSession
    days = sorted(set(days))
    if not days:
        return
    staging = shared_folder(spark, "staging")
    try:
        fenced = report.filter(F.col("date").between(F.lit(days[0]), F.lit(days[-1])))
        create_target(fenced, staging, schema, totals)
        filled = set(child_names(spark, staging))
        fresh = [day for day in days if f"date={day}" in filled]
        if fresh:
            _overwrite_days(spark, staging, fresh, target, schema)
        _drop_days(spark, target, [day for day in days if day not in fresh])
    finally:
        delete_folder(spark, staging)


def _overwrite_days(spark: SparkSession, staging: str, days: list[dt.date], target: str, schema: T.StructType) -> None:
    """Swap in the staged days.

    A table's insert takes the overwrite mode from its session only, so it runs in a session
    of its own: others may be writing in this one.
    """
    if is_folder(target):
        rows = read_target(spark, staging, schema).filter(F.col("date").isin(days))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("date").parquet(target)
        return
    other = spark.newSession()
    other.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows = read_target(other, staging, schema).filter(F.col("date").isin(days))
    # insertInto matches by position, and a table keeps its partition column last
    rows.select(*other.table(target).columns).write.insertInto(target, overwrite=True)
    spark.catalog.refreshTable(target)


def stored_days(spark: SparkSession, target: str) -> list[dt.date]:
    """The days the target has partitions for, by their names alone."""
    if is_folder(target):
        names = child_names(spark, target)
    else:
        names = [row[0] for row in spark.sql(f"SHOW PARTITIONS {target}").collect()]  # one per day
    return sorted(dt.date.fromisoformat(n.removeprefix("date=")) for n in names if n.startswith("date="))


def _drop_days(spark: SparkSession, target: str, days: list[dt.date]) -> None:
    if is_folder(target):
        present = set(child_names(spark, target))
        for name in (f"date={day}" for day in days):
            if name in present:
                delete_folder(spark, f"{target}/{name}")
    else:
        for day in days:
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION (date = DATE '{day}')")


def review(target: DataFrame, limit: int = 100) -> DataFrame:
    """The first rows of the target, newest day and most sessions first."""
    dimensions = [f.name for f in target.schema if f.dataType == T.StringType()]
    return target.orderBy(F.desc("date"), F.desc("sessions"), *dimensions).limit(limit)


def _totals() -> list[Column]:
    return [
        F.count("*").alias("report_rows"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.count_distinct("date").alias("days"),
        F.sum("users").alias("users"),
        F.sum("sessions").alias("sessions"),
        F.sum("conversions").alias("conversions"),
        F.round(F.sum("ecommerce_revenue"), 2).alias("ecommerce_revenue"),
        F.sum("ecommerce_transactions").alias("ecommerce_transactions"),
    ]


def review_months(target: DataFrame) -> DataFrame:
    """Rows, day range and main totals of each month in the target."""
    return target.groupBy(F.trunc("date", "MM").alias("month")).agg(*_totals())


def review_sources(target: DataFrame) -> DataFrame:
    """Rows, day range and main totals of each source and medium in the target."""
    return target.groupBy("utm_source", "utm_medium").agg(*_totals())
