"""Every registered query against its plain SQL form in DuckDB."""

from __future__ import annotations

import pytest
from compare import connect, difference
from conftest import SF_DIR

import __spark_entry__ as entry_point
from deskmart.queries import QUERIES

ORACLE = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_sql(spark, duck, key):
    assert difference(QUERIES[key](spark, SF_DIR), duck, ORACLE[key]) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
