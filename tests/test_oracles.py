"""Every registered query equals its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from oracle_check import compare, duck

from __spark_entry__ import entry, oracle_sql, queries
from catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, queries()[name], oracle_sql()[name], SF) is None


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and df.columns[0] == "provider"
