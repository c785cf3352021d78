"""Shapes of the physical plans, and results on heavily skewed input."""

import re

import duckdb
import pytest

from tests.compare import connect, differences
from tests.conftest import SF_SMALL
from trafficloom.catalog import queries as catalog
from trafficloom.catalog.oracles import ORACLES
from trafficloom.plans import reports
from trafficloom.session import shared_folder
from trafficloom.schemas import EXPORT


@pytest.fixture(scope="module")
def landed(spark):
    return spark.read.schema(EXPORT).parquet(catalog.landed_export(spark, SF_SMALL))


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def count(text: str, node: str) -> int:
    return len(re.findall(rf"\b{node}\b", text))


FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "Window", "PythonUDF", "BatchEvalPython", "RoundRobinPartitioning"]


@pytest.mark.parametrize("build", [reports.landing_page_report, reports.acquisition_report])
def test_a_report_takes_four_shuffles_and_no_expansion(landed, build):
    text = plan(build(landed, "purchase"))
    # event identity, session and counted value, session, report dimensions
    assert count(text, "Exchange hashpartitioning") == 4
    assert "SinglePartition" not in text
    assert [node for node in FORBIDDEN if count(text, node)] == []


def test_each_shuffle_is_preceded_by_a_partial_aggregation(landed):
    lines = plan(reports.landing_page_report(landed, "purchase")).splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(below) == 4 and all("Aggregate" in line and "partial_" in line for line in below)


def test_events_are_not_exploded_before_the_first_shuffle(landed):
    text = plan(reports.landing_page_report(landed, "purchase"))
    lowest = text[text.rindex("Exchange hashpartitioning"):]
    assert "Generate" not in lowest


def test_parameters_are_picked_before_the_sort(landed):
    lines = plan(reports.landing_page_report(landed, "purchase")).splitlines()
    (lowest,) = [i for i, line in enumerate(lines) if "Sort [" in line and "Exchange" not in "".join(lines[i + 1 :])]
    output = lines[lowest + 1].split(" AS ")
    assert "Project [" in lines[lowest + 1] and "event_params" not in output[0]
    assert sum("FileScan" in line for line in lines) == 1


def test_unused_columns_stay_unread(landed):
    (scan,) = [line for line in plan(reports.acquisition_report(landed, "purchase")).splitlines() if "FileScan" in line]
    assert not {"device", "geo"} & set(re.findall(r"\w+", scan.split("ReadSchema")[1]))


def test_report_queries_take_one_pass_over_the_table(spark):
    for query in (catalog.report_date_ranges, catalog.report_segment):
        text = plan(query(spark, SF_SMALL))
        assert count(text, "CartesianProduct") == count(text, "BroadcastNestedLoopJoin") == 0
        assert text.count("events.parquet") == 1


SKEW = {
    # a third of all events without user, on one day and without their own hour
    "one session": "CASE WHEN event_id % 3 = 0 THEN 29 ELSE user_id END AS user_id, event_type, "
                   "CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-05 00:00:00' + to_minutes(event_id % 300) ELSE ts END AS ts",
    # a third of all events with the same identity
    "one identity": "CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id, "
                    "CASE WHEN event_id % 3 = 0 THEN 'purchase' ELSE event_type END AS event_type, "
                    "CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-05 00:00:00' ELSE ts END AS ts",
}


@pytest.fixture(scope="module", params=SKEW)
def skewed(request, spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    duckdb.execute(
        f"COPY (SELECT event_id, {SKEW[request.param]}, value, props FROM '{SF_SMALL}/events.parquet') "
        f"TO '{folder}/events.parquet'"
    )
    duckdb.execute(f"COPY (SELECT * FROM '{SF_SMALL}/pages.parquet') TO '{folder}/pages.parquet'")
    return str(folder)


@pytest.mark.parametrize(
    "name", ["event_flatten", "event_flatten_acquisition", "session_rollup", "landing_report", "source_medium_report"]
)
def test_skewed_input(spark, skewed, name):
    con = connect(skewed)
    assert differences(catalog.QUERIES[name](spark, skewed), con, ORACLES[name]) == []


def test_results_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        con = connect(SF_SMALL)
        for name in ("event_flatten", "landing_report", "legacy_normalize"):
            assert differences(catalog.QUERIES[name](spark, SF_SMALL), con, ORACLES[name]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_shared_folder_is_below_the_configured_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(root) and first != second
