"""Every registered query against its SQL, and the contract of the entry module."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, SF, name) is None


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLE.items() <= entry_points.oracle_sql().items()


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and len(df.columns) == 18
