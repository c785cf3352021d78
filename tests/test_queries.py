"""Every registered query against DuckDB, and the known totals of the sample tables."""

import functools

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from tests.compare import connect, differences
from tests.conftest import SF_SMALL, SF_TEST
from trafficloom.catalog import queries as catalog
from trafficloom.catalog.oracles import ORACLES
from trafficloom.schemas import RATIO_METRIC, SOURCE_MEDIUM, TARGET

QUERIES = catalog.QUERIES


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_SMALL)
    yield con
    con.close()


@pytest.fixture(scope="module", autouse=True)
def one_target(spark):
    """The stored target that several review keys read is made once."""
    make = catalog.backfilled_target
    catalog.backfilled_target = functools.cache(make)
    yield
    catalog.backfilled_target = make


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_SMALL), duck, ORACLES[name]) == []


def test_entry(spark):
    assert entry_point.entry(spark).count() == 603


def test_known_totals(spark):
    flat = catalog.flat(spark, SF_TEST)
    assert flat.count() == 9713
    assert flat.filter("conversions > 1").count() == 17
    sessions = catalog.sessions(spark, SF_TEST)
    assert sessions.count() == 7568
    assert sessions.filter("sessions = 0").count() == 523
    assert sessions.filter("users = 0").count() == 129
    landing = catalog.landing(spark, SF_TEST)
    found = landing.agg(
        F.count("*"),
        F.count_if(F.col(RATIO_METRIC).isNull()),
        F.count_if(F.col("country") == "(not set)"),
        F.count_if(F.col("landing_page") == "(not set"),
        F.sum("ecommerce_transactions"),
    ).first()
    assert tuple(found) == (5804, 266, 818, 4090, 3876)
    totals = catalog.source_medium(spark, SF_TEST).agg(
        F.count("*"),
        *(F.sum(c) for c in ("users", "sessions", "page_views", "conversions", "ecommerce_transactions")),
    )
    assert tuple(totals.first()) == (120, 7439, 7045, 1830, 1844, 1926)


def test_report_schemas(spark):
    kinds = lambda schema: [(f.name, f.dataType) for f in schema]
    assert kinds(catalog.landing(spark, SF_SMALL).schema) == kinds(TARGET)
    assert kinds(catalog.source_medium(spark, SF_SMALL).schema) == kinds(SOURCE_MEDIUM)
    assert kinds(catalog.legacy(spark, SF_SMALL).schema) == kinds(TARGET)


def test_additive_metrics_survive_every_step(spark):
    flat = catalog.flat(spark, SF_TEST)
    sessions = catalog.sessions(spark, SF_TEST)
    report = catalog.landing(spark, SF_TEST)
    from_flat = flat.agg(F.sum("entrance"), F.sum("new_user"), F.sum("conversions"), F.count("pageview_location"))
    from_sessions = sessions.agg(F.sum("entrance"), F.sum("new_user"), F.sum("conversions"), F.sum("page_views"))
    from_report = report.agg(F.sum("entrances"), F.sum("new_users"), F.sum("conversions"), F.sum("page_views"))
    assert tuple(from_flat.first()) == tuple(from_sessions.first()) == tuple(from_report.first())
