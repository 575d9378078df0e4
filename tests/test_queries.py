"""Every registered query against its SQL on a second engine, where SQL can express it."""

import pytest
from check_engine import compare, connect
from conftest import SF_DIR

import __spark_entry__ as entry

from oracle.catalog import oracle_sql
from subrev.plans.catalog import queries

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and len(QUERIES) > 80
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert compare(df, con, SQL[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["month", "gains", "losses", "quick_ratio"] and df.count() > 12
