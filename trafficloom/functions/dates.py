"""Day, timestamp and month helpers that do not depend on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Textual formats.
SHARD_DAY = "yyyyMMdd"
CLOCK_WIDTH = len("yyyy-MM-dd HH:mm:ss")


def shard_day(column: Column) -> Column:
    """``yyyyMMdd`` text as a date; malformed text fails the query under ANSI."""
    return F.to_date(column, SHARD_DAY)


def micros_text(column: Column) -> Column:
    """Epoch microseconds as UTC clock text, whatever the session zone.

    ``date_format`` would pass through the session zone and move clock times that
    its daylight saving skips, so the zoneless timestamp is cast to text instead.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    clock = F.timestamp_add("MICROSECOND", column, epoch).cast("string")
    return F.substring(clock, 1, CLOCK_WIDTH)


def utc_today() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def days_ago(days: int, as_of: dt.date | None = None) -> dt.date:
    """``abs(days)`` before ``as_of`` (default: today in UTC)."""
    return (as_of or utc_today()) - dt.timedelta(days=abs(days))


def iso_date(value: str | dt.date) -> dt.date:
    """One day given as a date or as ``yyyy-MM-dd`` text, which has to read the same when
    the day is written out again; anything else is a ValueError."""
    if isinstance(value, dt.date):
        return value.date() if isinstance(value, dt.datetime) else value
    day = dt.date.fromisoformat(value)
    if str(day) != value:
        raise ValueError(f"a day is written as {day}, not as {value!r}")
    return day


def iso_day_or_null(column: Column) -> Column:
    """The day of a ``yyyy-MM-dd`` text, NULL for text that is not exactly a day's."""
    day = F.try_to_date(column, "yyyy-MM-dd")
    return F.when(F.date_format(day, "yyyy-MM-dd") == column, day)
