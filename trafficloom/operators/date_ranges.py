"""Which of many date ranges a day lies in, as a join on equality.

A range of days is a few blocks of 2^k days that start at a multiple of 2^k: at most two per
size. A day lies in one block of each size. So each pair of a day and a range that holds it
meets in exactly one block, and nothing else does.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Span = tuple[dt.date, dt.date]

#: Days are counted from the first one a date can name; all fit into so many bits.
FIRST_DAY = dt.date(1, 1, 1)
SIZES = 22


def blocks(first: dt.date, last: dt.date) -> Iterator[tuple[int, int]]:
    """The blocks, as (size, number), that make up the days from ``first`` to ``last``."""
    low, high, size = (first - FIRST_DAY).days, (last - FIRST_DAY).days + 1, 0
    while low < high:
        if low & 1:
            yield size, low
            low += 1
        if high & 1:
            high -= 1
            yield size, high
        low, high, size = low >> 1, high >> 1, size + 1


def days_in_ranges(days: DataFrame, ranges: Sequence[Span], tag: str = "range_index") -> DataFrame:
    """A row (date, ``tag``) for every day of ``days``, whose dates are distinct, and every
    range by number that holds it."""
    spark = days.sparkSession
    pieces = [(i, size, number) for i, span in enumerate(ranges) for size, number in blocks(*span)]
    wanted = spark.createDataFrame(pieces, f"{tag} int, size int, number int")
    nth = F.unix_date("date") + (dt.date(1970, 1, 1) - FIRST_DAY).days
    sizes = F.explode(F.sequence(F.lit(0), F.lit(SIZES)))
    held = days.select("date", nth.alias("nth"), sizes.alias("size")).withColumn("number", F.expr("shiftright(nth, size)"))
    return held.join(wanted, ["size", "number"]).select("date", tag)


def tag_ranges(rows: DataFrame, ranges: Sequence[Span], tag: str = "range_index") -> DataFrame:
    """Each row once per range that holds its ``date``, with the range's number in ``tag``.

    The days that occur are matched with the ranges, and the rows are joined by their day, so
    the work follows the rows that come out, not the number of ranges.
    """
    return rows.join(days_in_ranges(rows.select("date").distinct(), ranges, tag), "date")
