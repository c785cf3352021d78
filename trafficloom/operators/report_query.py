"""A fluent report query over the unified table, or over any table of dimensions and metrics."""

from __future__ import annotations

import base64
import datetime as dt
import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom.functions.dates import days_ago, iso_date, utc_today
from trafficloom.operators.date_ranges import tag_ranges
from trafficloom.operators.ranking import NTH, RankedRows, rank_rows
from trafficloom.operators.sampling import DrawnLayout, draw
from trafficloom.operators.sessions import PAGE_SKETCH
from trafficloom.schemas import (
    DEFAULT_GOAL_METRIC,
    LANDING_DIMENSIONS,
    LEGACY_DIMENSIONS,
    LEGACY_METRICS,
    METRICS,
    RATIO_METRIC,
    legacy_metric_names,
)
from trafficloom.session import checkpointed

# Defaults of a report request.
DEFAULT_DAYS_BACK = (91, 1)
DEFAULT_METRICS = ("ga:users",)
LEGACY_PAGE_SIZE = 10_000
FIRST_PAGE = "0"
UNSAMPLED = "LARGE"
SAMPLING_LEVELS = ("DEFAULT", "SMALL", "LARGE")

#: Up to so many ranges are conditions on every row; more are joined by day.
FEW_RANGES = 8
#: Rows of a page that one task may gather and sort.
SHORT_PAGE = 10_000


DISTINCT_PAGES = "distinct_pages"


def default_metrics(page_sketches: bool = False) -> dict[str, Column]:
    """How each unified metric combines over report rows.

    All of them add up, but for the per-session ratio, which is weighted by sessions, and
    ``distinct_pages``, which a table with page sketches has: rows without one add nothing.
    """
    metrics = {m: F.sum(m) for m in METRICS}
    metrics["ecommerce_revenue"] = F.round(F.sum("ecommerce_revenue"), 2)
    weighted = F.sum(F.col(RATIO_METRIC) * F.col("sessions"))
    weight = F.sum(F.when(F.col(RATIO_METRIC).isNotNull(), F.col("sessions")))
    metrics[RATIO_METRIC] = F.round(F.try_divide(weighted, weight), 2)
    if page_sketches:
        pages = F.hll_sketch_estimate(F.hll_union_agg(PAGE_SKETCH))
        metrics[DISTINCT_PAGES] = F.coalesce(pages, F.lit(0).cast("long"))
    return metrics


@dataclass(frozen=True)
class ReportQuery:
    """An immutable request: every method returns a changed copy.

    Names are accepted in the unified and in the legacy spelling; result columns
    carry the unified names. ``dimension_names`` and ``metric_exprs`` describe the
    table when it is not the unified one; ``segment_filters`` maps segment ids to
    row conditions. ``layout`` says how the table is cut by draws, if it is.
    """

    table: DataFrame
    as_of: dt.date | None = None
    dimension_names: Sequence[str] = tuple(LANDING_DIMENSIONS)
    metric_exprs: Mapping[str, Column] | None = None
    segment_filters: Mapping[str, Column] | None = None
    goal_metric: str = DEFAULT_GOAL_METRIC
    ranges: tuple[tuple[dt.date, dt.date], ...] | None = None
    chosen_dimensions: tuple[str, ...] = ()
    chosen_metrics: tuple[str, ...] = DEFAULT_METRICS
    segments: tuple[str, ...] = ()
    size: int | None = None
    token: str = FIRST_PAGE
    level: str = UNSAMPLED
    fraction: float = 1.0
    seed: int = 0
    layout: DrawnLayout | None = None

    def date_range(self, ranges: Sequence[tuple[str | dt.date, str | dt.date]]) -> ReportQuery:
        """Inclusive ISO date ranges, replacing the previous ones.

        With several, rows are tagged with ``range_index`` and a day counts in
        every range that holds it.
        """
        checked = tuple((iso_date(first), iso_date(last)) for first, last in ranges)
        if not checked:
            raise ValueError("no date range")
        return replace(self, ranges=checked)

    def dimensions(self, names: Sequence[str]) -> ReportQuery:
        return replace(self, chosen_dimensions=tuple(names))

    def metrics(self, names: Sequence[str]) -> ReportQuery:
        return replace(self, chosen_metrics=tuple(names))

    def segment(self, ids: Sequence[str]) -> ReportQuery:
        """Rows per segment, tagged with ``segment``; a row counts in every segment it is in."""
        return replace(self, segments=tuple(ids))

    def page_size(self, rows: int) -> ReportQuery:
        """At most that many rows."""
        if rows < 1:
            raise ValueError("page size must be positive")
        return replace(self, size=rows)

    def page_token(self, token: str) -> ReportQuery:
        """Start at a row offset ("0", "10000", ...) or where another page ended."""
        return replace(self, token=token)

    def sampling_level(self, level: str, fraction: float = 1.0, seed: int = 0) -> ReportQuery:
        """``LARGE`` reads everything; the other levels read ``fraction`` of the report rows. Of
        a table whose ``layout`` has the same seed, only the files that may hold them are read."""
        if level not in SAMPLING_LEVELS:
            raise ValueError(f"unknown sampling level: {level!r}")
        if not 0 < fraction <= 1:
            raise ValueError("fraction must be in (0, 1]")
        return replace(self, level=level, fraction=fraction, seed=seed)

    def get(self) -> Report:
        return Report(self)

    def _resolve(self, names: Sequence[str], legacy: Mapping[str, str], known: Sequence[str]) -> list[str]:
        unified = [legacy.get(name, name) for name in names]
        unknown = [name for name, u in zip(names, unified) if u not in known]
        if unknown:
            raise ValueError(f"unknown names: {unknown}; known: {list(known)}")
        return list(dict.fromkeys(unified))

    def _tags(self) -> dict[str, list[tuple[Column, Column]]]:
        """Tag columns with their (condition, value) choices."""
        tags = {}
        if self.ranges and 1 < len(self.ranges) <= FEW_RANGES:
            tags["range_index"] = [
                (_within(first, last), F.lit(i)) for i, (first, last) in enumerate(self.ranges)
            ]
        if self.segments:
            known = self.segment_filters or {}
            unknown = [s for s in self.segments if s not in known]
            if unknown:
                raise ValueError(f"unknown segments: {unknown}; known: {list(known)}")
            tags["segment"] = [(known[s], F.lit(s)) for s in self.segments]
        return tags

    def _sampled(self, rows: DataFrame) -> DataFrame:
        if self.level == UNSAMPLED or self.fraction == 1.0:
            return rows
        if self.layout and (self.layout.seed, self.layout.dimensions) == (self.seed, tuple(self.dimension_names)):
            rows = rows.filter(self.layout.may_hold(self.fraction))
        return rows.filter(draw(self.dimension_names, self.seed) < self.fraction)

    def plan(self) -> tuple[DataFrame, list[str]]:
        """The whole report, unordered, and its grouping columns."""
        exprs = dict(self.metric_exprs or default_metrics(PAGE_SKETCH in self.table.columns))
        legacy_metrics = dict(zip(legacy_metric_names(self.goal_metric), LEGACY_METRICS.values()))
        chosen = self._resolve(self.chosen_dimensions, LEGACY_DIMENSIONS, self.dimension_names)
        metrics = self._resolve(self.chosen_metrics, legacy_metrics, list(exprs))
        today = self.as_of or utc_today()
        ranges = self.ranges or (tuple(days_ago(n, today) for n in DEFAULT_DAYS_BACK),)

        many = len(ranges) > FEW_RANGES
        spans = [(min(first for first, _ in ranges), max(last for _, last in ranges))] if many else ranges
        rows = self._sampled(self.table.filter(reduce(lambda a, b: a | b, (_within(*r) for r in spans))))
        tags = self._tags()
        for tag, choices in tags.items():
            # one pass over the table, however many ranges or segments there are
            matching = F.array(*(F.when(cond, value) for cond, value in choices))
            rows = rows.withColumn(tag, F.explode(matching)).filter(F.col(tag).isNotNull())
        if many:
            rows = tag_ranges(rows, ranges, "range_index")
        keys = [*(["range_index"] if many else []), *tags, *chosen]
        report = rows.groupBy(*keys).agg(*(exprs[m].alias(m) for m in metrics))
        return report, keys


def _within(first: dt.date, last: dt.date) -> Column:
    return F.col("date").between(F.lit(first), F.lit(last))


class Report:
    """The result of a query: the page as ``rows`` and the token of the next one.

    Rows are in the order of their grouping columns, which is total, so offsets
    mean the same on every run. A short page from the start or a key is a top-k. For any other,
    the report is dealt into ranges of its keys once, and a page reads the ranges it touches.
    One row more than a page shows tells whether another page follows.
    """

    def __init__(self, query: ReportQuery):
        self.query = query
        self.whole, self.keys = query.plan()

    @property
    def _from_token(self) -> DataFrame:
        """The rows a token with a key leaves; all of them for an offset."""
        token = self.query.token
        return self.whole if token.isdecimal() else self.whole.filter(_after(self.keys, self.whole, token))

    @cached_property
    def _ranked(self) -> RankedRows:
        return rank_rows(self._from_token, self.keys)

    @cached_property
    def _top(self) -> DataFrame:
        """The rows of a short page and the one after them, numbered and written once."""
        return numbered_rows(self._from_token.orderBy(*self.keys).limit(self.query.size + 1), self.keys)[0]

    def _places(self, first: int, end: int | None) -> DataFrame:
        """Rows by their place after the token, in order, numbered in ``NTH``."""
        size, token = self.query.size, self.query.token
        short = size is not None and size <= SHORT_PAGE and (token == FIRST_PAGE or not token.isdecimal())
        if short and end is not None and end <= size + 1:
            return self._top.filter(F.col(NTH).between(first, end - 1))
        offset = int(token) if token.isdecimal() else 0
        found = self._ranked.between(offset + first, self._ranked.total if end is None else offset + end)
        return found.withColumn(NTH, F.col(NTH) - offset).orderBy(NTH)

    @property
    def rows(self) -> DataFrame:
        """The page; without a page size, everything from the token on, unordered from the start."""
        if not self.keys or (self.query.size is None and self.query.token == FIRST_PAGE):
            return self.whole
        return self._places(0, self.query.size).drop(NTH)

    def next_page_token(self) -> str | None:
        """Where the page after this one starts, or None at the end of the report.

        The token names the last row of this page. The next page is then a filter
        and a short top-k, however far into the report it lies.
        """
        size = self.query.size
        if size is None or not self.keys:
            return None
        key = F.to_json(F.struct(*self.keys), {"ignoreNullFields": "false"}).alias("key")
        ends = self._places(size - 1, size + 1).orderBy(NTH).select(key).collect()  # at most two
        return base64.urlsafe_b64encode(ends[0]["key"].encode()).decode() if len(ends) == 2 else None

    def paged(self) -> DataFrame:
        """This page and all that follow as one frame, numbered from 0 in ``page``."""
        size = self.query.size
        if size is None or not self.keys:
            return self.rows.withColumn(PAGE, F.lit(0).cast("long"))
        return self._places(0, None).withColumn(PAGE, F.floor(F.col(NTH) / size)).drop(NTH)

    def pages(self) -> Iterator[DataFrame]:
        """This page and all that follow, each a read of the ranges it touches."""
        size = self.query.size
        if size is None or not self.keys:
            yield self.rows
            return
        offset = int(self.query.token) if self.query.token.isdecimal() else 0
        left = max(0, self._ranked.total - offset)
        for page in range(max(1, -(-left // size))):
            found = self._ranked.between(offset + page * size, offset + (page + 1) * size)
            yield found.orderBy(NTH).drop(NTH)


PAGE = "page"


def numbered_rows(report: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """The report's rows with their place in the order of the keys, and their number.

    The sorted rows are checkpointed so that partition boundaries stay put, the
    partitions are counted, and each row's number follows from the counts before
    its partition. No row passes through the driver or one task.
    """
    part, at = "_part", "_at"
    # the partition in the high bits and the row within it in the low 33
    ordered = checkpointed(report.orderBy(*keys)).withColumn(at, F.monotonically_increasing_id())
    ordered = ordered.withColumn(part, F.shiftright(at, 33))
    counts = ordered.groupBy(part).count().orderBy(part).collect()  # one row per partition
    before, total = [], 0
    for row in counts:
        before.append((row[part], total))
        total += row["count"]
    starts = report.sparkSession.createDataFrame(before, f"{part} long, _before long")
    within = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ordered.join(F.broadcast(starts), part)  # one row per partition
    return numbered.withColumn(NTH, F.col("_before") + within).drop(part, at, "_before"), total


def _after(keys: list[str], report: DataFrame, token: str) -> Column:
    """Rows past the key in the token. Structs compare field by field, NULL first, as in the sort."""
    text = base64.urlsafe_b64decode(token.encode()).decode()
    if list(json.loads(text)) != keys:
        raise ValueError("the token belongs to a report with other dimensions")
    schema = report.select(*keys).schema
    here = F.struct(*keys)
    return here > F.from_json(F.lit(text), schema)


def legacy_report(
    table: DataFrame,
    first_day: str | dt.date,
    last_day: str | dt.date,
    goal_metric: str = DEFAULT_GOAL_METRIC,
    page_token: str = FIRST_PAGE,
) -> ReportQuery:
    """The wide historical pull: all legacy dimensions and metrics, in pages."""
    return (
        ReportQuery(table, goal_metric=goal_metric)
        .date_range([(first_day, last_day)])
        .dimensions(list(LEGACY_DIMENSIONS))
        .metrics(legacy_metric_names(goal_metric))
        .page_size(LEGACY_PAGE_SIZE)
        .page_token(page_token)
        .sampling_level(UNSAMPLED)
    )
