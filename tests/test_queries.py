"""Every registered query against its SQL form."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.compare import compare, connect
from tickmacro.checks.oracles import ORACLES
from tickmacro.checks.queries import QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_sql_form():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, db, name):
    assert compare(QUERIES[name](spark, sf_dir), db, ORACLES[name]) > 0


def test_entry_runs(spark):
    assert contract.entry(spark).columns == ["symbol", "rolling_corr_30d", "dt"]


def test_queries_do_not_depend_on_the_session_zone(spark, sf_dir, db):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        name = "silver_market_bar_1m"
        compare(QUERIES[name](spark, sf_dir), db, ORACLES[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
