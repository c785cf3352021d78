"""Hand-written export rows and legacy pages."""

from __future__ import annotations

from trafficloom.schemas import EXPORT, LEGACY_DIMENSIONS, legacy_metric_names
from trafficloom.sources.report_pages import LANDED


def param(key, text=None, number=None):
    return (key, (text, number))


def event(
    name="page_view",
    params=(),
    user="u1",
    at=1_704_103_200_000_000,
    day="20240101",
    country="FR",
    region="R",
    city="C",
    source=None,
    medium=None,
    transaction=None,
    revenue=None,
):
    return (
        day, at, 1_700_000_000_000_000, name, user, ("desktop", "fr", ("Chrome",)),
        (country, region, city), (source, medium), (transaction, revenue),
        None if params is None else list(params),
    )


def export(spark, *events):
    return spark.createDataFrame(list(events), EXPORT)


def session_params(session=1, page=None, *more):
    found = [param("ga_session_id", number=session), *more]
    return found + [param("page_location", page)] if page is not None else found


DIMENSIONS = ["20231005", "shop.example.com", "/a", "FR", "R", "C", "google", "cpc", "(not set)"]
METRICS = ["3", "1", "2", "4", "9", "8", "12.5", "1", "12.25", "1"]


def legacy_row(dimensions=DIMENSIONS, *ranges):
    return (list(dimensions), [(list(values),) for values in (ranges or (METRICS,))])


def legacy_page(*rows, goal="ga:goalCompletionsAll", token=None, window="2023-10-01", metrics=None):
    import datetime as dt

    names = metrics or legacy_metric_names(goal)
    header = (list(LEGACY_DIMENSIONS), ([(name,) for name in names],))
    return ([(header, (list(rows),), token)], dt.date.fromisoformat(window))


def landed(spark, *pages):
    return spark.createDataFrame(list(pages), LANDED)


def changed(values, **at):
    """A copy of a value list with some positions replaced: ``changed(METRICS, p3="x")``."""
    values = list(values)
    for position, value in at.items():
        values[int(position[1:])] = value
    return values
