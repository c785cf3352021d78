"""Ratios and strict or lenient number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """NULL where the denominator is zero or NULL."""
    return F.round(F.try_divide(numerator, denominator), digits)


def parse_number(text: Column, kind: str, lenient: bool = False) -> Column:
    """Text to ``bigint`` or ``double``.

    Whole numbers written with a fraction ("3.0") are accepted as ``bigint``.
    Anything else that does not fit fails the query, or is NULL when ``lenient``.
    """
    parsed = text.try_cast("double")
    if kind == "bigint":
        whole = parsed == F.floor(parsed)
        parsed = F.coalesce(text.try_cast("bigint"), F.when(whole, parsed.try_cast("bigint")))
    elif kind != "double":
        raise ValueError(f"unknown kind: {kind!r}")
    if lenient:
        return parsed
    problem = F.concat(F.lit(f"not a {kind}: "), text)
    unreadable = text.isNotNull() & parsed.isNull()
    return F.when(unreadable, F.raise_error(problem).cast(kind)).otherwise(parsed)
