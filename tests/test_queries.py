"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as driver
import oracle
from wattloom.plans import catalog

QUERIES = {name: driver.queries()[name] for name in catalog.load()}
SQL = {name: driver.oracle_sql()[name] for name in catalog.load()}
# Two nations lack weather at night; the smallest tables have no building there.
MAY_BE_EMPTY = {"unmatched_weather"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, con):
    df = QUERIES[name](spark, sf_dir)
    assert oracle.difference(df, con, SQL[name], name in MAY_BE_EMPTY) is None


def test_entry_runs(spark):
    assert driver.entry(spark).limit(1).count() == 1
