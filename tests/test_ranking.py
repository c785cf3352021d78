"""Pages by rank, many date ranges, and sampling that skips files."""

import datetime as dt
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.test_report_query import ALL_DAYS, row, table
from trafficloom.operators import report_query
from trafficloom.operators.date_ranges import FIRST_DAY, SIZES, blocks, days_in_ranges, tag_ranges
from trafficloom.operators.ranking import NTH, RANGE, rank_rows
from trafficloom.operators.report_query import ReportQuery
from trafficloom.operators.sampling import DRAWN, DrawnLayout
from trafficloom.schemas import TARGET
from trafficloom.session import shared_folder

DAY = dt.timedelta(days=1)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def keyed(spark, number=2000):
    ids = spark.range(number).withColumn("a", F.when(F.col("id") % 3 > 0, (F.col("id") * 7919 % 40).cast("string")))
    return ids.select("a", F.when(F.col("id") > 0, F.col("id")).alias("b"), (F.col("id") * 2).alias("n")).repartition(5)


@pytest.mark.parametrize("range_rows", [10**6, 100, 1])
def test_places_follow_the_order_of_the_keys(spark, range_rows):
    rows = keyed(spark, 2000 if range_rows > 1 else 40)
    ranked = rank_rows(rows, ["a", "b"], range_rows)
    expected = [tuple(r) for r in rows.orderBy("a", "b").collect()]
    assert ranked.total == len(expected)
    for first, end in [(0, len(expected)), (0, 1), (3, 33), (len(expected) - 2, len(expected) + 9), (5, 5), (10**6, 10**6 + 3)]:
        found = ranked.between(first, end).orderBy(NTH).collect()
        assert [r[NTH] for r in found] == list(range(first, min(end, len(expected))))
        assert [tuple(r)[:3] for r in found] == expected[first:end]


def test_a_page_reads_the_ranges_it_touches(spark):
    ranked = rank_rows(keyed(spark), ["a", "b"], 100)
    assert len(ranked.counts) > 10 and max(ranked.counts) < 400
    page = ranked.between(500, 620)
    text = plan(page)
    filters = next(line for line in text.splitlines() if "FileScan" in line).split("PartitionFilters: [")[1]
    touched = re.search(rf"{RANGE}#\d+ IN \(([\d,]+)\)", filters).group(1).split(",")
    assert 1 <= len(touched) <= 4
    assert "TakeOrderedAndProject" not in text and "SinglePartition" not in text


def test_no_rows_have_no_places(spark):
    ranked = rank_rows(keyed(spark).limit(0), ["a", "b"])
    assert ranked.total == 0 and ranked.between(0, 10).collect() == []


def test_large_pages_equal_short_ones(spark, monkeypatch):
    rows = [row(day=f"2024-01-{d:02d}", page=f"/{p}" if p else None, users=d) for d in range(1, 21) for p in range(11)]
    query = ReportQuery(table(spark, *rows)).date_range(ALL_DAYS).dimensions(["date", "landing_page"])

    def pages(start):
        found, token = [], start
        while token is not None:
            page = query.page_size(64).page_token(token).get()
            found.append([tuple(r) for r in page.rows.collect()])
            token = page.next_page_token()
        return found

    short = {start: pages(start) for start in ("0", "37")}
    assert [len(p) for p in short["0"]] == [64, 64, 64, 28] and sum(short["0"], []) [37:] == sum(short["37"], [])
    monkeypatch.setattr(report_query, "SHORT_PAGE", 1)
    monkeypatch.setattr("trafficloom.operators.ranking.RANGE_ROWS", 30)
    assert {start: pages(start) for start in ("0", "37")} == short
    text = plan(query.page_size(64).get().rows)
    assert "TakeOrderedAndProject" not in text and "SinglePartition" not in text
    assert [[tuple(r) for r in p.collect()] for p in query.page_size(64).get().pages()] == short["0"]


# date ranges

days = st.dates(dt.date(1999, 12, 1), dt.date(2001, 2, 1)) | st.dates()


@settings(max_examples=200, deadline=None)
@given(days, days)
def test_blocks_make_up_the_range_without_overlap(first, last):
    found = sorted((number << size, (number + 1) << size) for size, number in blocks(first, last))
    assert len(found) <= 2 * SIZES
    if last < first:
        assert found == []
        return
    assert found[0][0] == (first - FIRST_DAY).days and found[-1][1] == (last - FIRST_DAY).days + 1
    assert all(a[1] == b[0] for a, b in zip(found, found[1:]))


def test_days_and_ranges_meet_once(spark):
    draw = random.Random(3)
    start = dt.date(2023, 12, 20)
    held = [start + k * DAY for k in range(60) if k % 7] + [dt.date(1, 1, 1), dt.date(9999, 12, 31)]
    ranges = [(start + draw.randrange(-20, 60) * DAY, start + draw.randrange(-20, 60) * DAY) for _ in range(200)]
    ranges += [(dt.date(1, 1, 1), dt.date(9999, 12, 31)), (held[0], held[0])]
    found = days_in_ranges(spark.createDataFrame([(d,) for d in held], "date date"), ranges)
    expected = sorted((d, i) for i, (first, last) in enumerate(ranges) for d in held if first <= d <= last)
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_many_ranges_equal_conditions(spark, monkeypatch):
    frame = table(spark, *(row(day=f"2024-01-{d:02d}", medium=m, users=d) for d in range(1, 21) for m in ("cpc", None)))
    ranges = [(dt.date(2024, 1, 1) + k % 17 * DAY, dt.date(2024, 1, 1) + (k % 17 + k % 5) * DAY) for k in range(40)]
    query = ReportQuery(frame).date_range(ranges).dimensions(["ga:medium"])
    joined = query.get().rows
    text = plan(joined)
    assert not any(node in text for node in ("NestedLoop", "Cartesian"))
    monkeypatch.setattr(report_query, "FEW_RANGES", 100)
    conditions = query.get().rows
    assert joined.columns == conditions.columns == ["range_index", "utm_medium", "users"]
    assert sorted(map(str, joined.collect())) == sorted(map(str, conditions.collect()))


def test_a_hot_day_is_joined_once_per_range(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") > 0, F.lit("2024-01-05")).otherwise("2024-01-06").cast("date").alias("date"), "id")
    ranges = [(dt.date(2024, 1, 1), dt.date(2024, 1, k)) for k in range(1, 11)]
    found = {r["range_index"]: r["count"] for r in tag_ranges(rows, ranges).groupBy("range_index").count().collect()}
    assert found == {k: 19_999 + (k > 4) for k in range(4, 10)}


# sampling

def test_a_laid_out_table_is_read_by_bucket(spark):
    frame = table(spark, *(row(day=f"2024-01-{d:02d}", page=f"/{p}") for d in (1, 2) for p in range(200)))
    layout, folder = DrawnLayout(seed=5, buckets=8), shared_folder(spark, "drawn")
    layout.write(frame, folder)
    stored = layout.read(spark, folder)
    assert stored.count() == 400 and stored.columns == [*TARGET.fieldNames(), DRAWN]

    def report(rows, seed, **options):
        query = ReportQuery(rows, **options).date_range(ALL_DAYS).dimensions(["landing_page"])
        return query.sampling_level("SMALL", fraction=0.2, seed=seed).get().rows

    for seed in (5, 6):
        plain, laid = report(frame, seed), report(stored, seed, layout=layout)
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, laid.collect()))
    scan = next(line for line in plan(report(stored, 5, layout=layout)).splitlines() if "FileScan" in line)
    filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert f"isnotnull({DRAWN}#" in filters  # the text of the plan is cut after that
    assert 30 < report(stored, 5, layout=layout).agg(F.sum("users")).first()[0] < 130
    whole = ReportQuery(stored, layout=layout).date_range(ALL_DAYS).get().rows
    assert whole.first()["users"] == 400
