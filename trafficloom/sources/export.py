"""Scan the raw event export for a window of days."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficloom.functions.dates import SHARD_DAY, utc_today
from trafficloom.schemas import EXPORT
from trafficloom.storage import child_names

PARTITION_PREFIX = "event_date="


def day_window(as_of: dt.date | None, prior_days: int) -> tuple[dt.date, dt.date]:
    """First and last day, both included: ``prior_days`` + 1 days ending on ``as_of``."""
    last = as_of or utc_today()
    return last - dt.timedelta(days=prior_days), last


def split_days(first: dt.date, last: dt.date, size: int) -> list[tuple[dt.date, dt.date]]:
    """The days from ``first`` to ``last`` in runs of at most ``size``, newest first."""
    if size < 1:
        raise ValueError("a run needs at least one day")
    ends = [last - dt.timedelta(days=n) for n in range(0, (last - first).days + 1, size)]
    return [(max(first, end - dt.timedelta(days=size - 1)), end) for end in ends]


def shard_days(names: list[str], prefix: str, on_bad_suffix: str = "error") -> dict[str, dt.date]:
    """Folder names with ``prefix`` and the day each suffix stands for."""
    if on_bad_suffix not in ("error", "skip"):
        raise ValueError(f"unknown on_bad_suffix: {on_bad_suffix!r}")
    days, bad = {}, []
    for name in names:
        if not name.startswith(prefix):
            continue
        suffix = name.removeprefix(prefix).removesuffix(".parquet")
        try:
            if not re.fullmatch(r"\d{8}", suffix):
                raise ValueError
            days[name] = dt.datetime.strptime(suffix, "%Y%m%d").date()
        except ValueError:
            bad.append(name)
    if bad and on_bad_suffix == "error":
        raise ValueError(f"not a day (yyyyMMdd): {sorted(bad)}")
    return days


def held_days(
    spark: SparkSession,
    root: str,
    as_of: dt.date | None = None,
    prior_days: int = 0,
    table_prefix: str | None = None,
    on_bad_suffix: str = "error",
) -> dict[dt.date, str]:
    """The days of the window that the export below ``root`` holds, with their folders.

    Without ``table_prefix``, ``root`` holds ``event_date=yyyyMMdd`` partitions; with one, a
    shard per day named prefix + ``yyyyMMdd``. Folder names are the only thing listed. A
    folder with another suffix, such as an intraday shard, is an error unless
    ``on_bad_suffix`` is ``skip``. An export without any day, as below a mistyped root or
    with a mistyped prefix, is an error, and so is a window of which it holds no day.
    """
    prefix = PARTITION_PREFIX if table_prefix is None else table_prefix
    days = shard_days(child_names(spark, root), prefix, on_bad_suffix)
    if not days:
        raise ValueError(f"nothing named {prefix}yyyyMMdd below {root}")
    first, last = day_window(as_of, prior_days)
    held = {day: f"{root}/{name}" for name, day in days.items() if first <= day <= last}
    if not held:
        raise ValueError(f"{root} holds no day from {first} to {last}")
    return dict(sorted(held.items()))


def scan_export(
    spark: SparkSession,
    root: str,
    as_of: dt.date | None = None,
    prior_days: int = 0,
    table_prefix: str | None = None,
    on_bad_suffix: str = "error",
    day_from_name: bool = False,
) -> DataFrame:
    """Events of the window's days, as :func:`held_days` finds them; no other folder is opened.

    ``day_from_name`` takes the day of shards from their names, for files that do not hold it.
    """
    held = held_days(spark, root, as_of, prior_days, table_prefix, on_bad_suffix)
    reader = spark.read.schema(EXPORT)
    if table_prefix is None:
        return reader.option("basePath", root).parquet(*held.values())
    events = reader.parquet(*held.values())
    if not day_from_name:
        return events
    named = F.regexp_extract(F.col("_metadata.file_path"), r"(\d{8})(?:/[^/]+|\.parquet)$", 1)
    return events.withColumn("event_date", named)


def scan_table(
    spark: SparkSession,
    table: str,
    as_of: dt.date | None = None,
    prior_days: int = 0,
    on_bad_suffix: str = "error",
) -> DataFrame:
    """The same window from a catalog table holding the export, by a text or date column.

    The bare column is compared with bounds of its own type, so partitions are pruned:
    ``yyyyMMdd`` text sorts like the day it names. Text that names no day is an error
    unless ``on_bad_suffix`` is ``skip``.
    """
    columns = spark.table(table).select(*EXPORT.fieldNames())
    first, last = day_window(as_of, prior_days)
    day = F.col("event_date")
    if not isinstance(columns.schema["event_date"].dataType, T.StringType):
        rows = columns.filter(day.between(F.lit(first), F.lit(last)))
        return rows.withColumn("event_date", F.date_format(day, SHARD_DAY))
    named = day.rlike(r"^\d{8}$") & F.try_to_date(day, SHARD_DAY).isNotNull()
    inside = day.between(f"{first:%Y%m%d}", f"{last:%Y%m%d}")
    if on_bad_suffix == "skip":
        return columns.filter(inside & named)
    failed = F.raise_error(F.concat(F.lit("not a day (yyyyMMdd): "), day)).cast("string")
    return columns.filter(inside | ~named).withColumn("event_date", F.when(named, day).otherwise(failed))
