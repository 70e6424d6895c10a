"""Every registered query against its SQL form, or for rows at least where there is none."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    assert compare(spark, con, sf, QUERIES[name], SQL.get(name)) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
