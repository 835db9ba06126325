"""Every registered query against its check SQL."""

import os

import pytest
from compare import difference, duck

from __spark_entry__ import entry, oracle_sql, queries

from souk.registry.oracle import ORACLE
from souk.registry.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees(spark, con, name):
    assert difference(con, queries()[name](spark, SF_DIR), oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).columns == ["city", "revenue"]
