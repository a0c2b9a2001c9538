"""Every registered query against its SQL in DuckDB."""

import os

import oracle
import pytest

import __spark_entry__ as contract
from lodestead.queries import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    problem = oracle.difference(QUERIES[name](spark, SF_DIR), con, SQL[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
