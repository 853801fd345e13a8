"""Every registered query against its SQL, on whole tables."""

import pytest
from check import compare, duck
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries
from folioscan.plans import load
from folioscan.plans.registry import ORACLES as SQL, QUERIES

load()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SMALL) is None


def test_queries_without_sql(spark):
    assert set(QUERIES) - set(SQL) == {"size_profile"}


def test_entry_holds_all(spark):
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
