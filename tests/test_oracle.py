"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from catalog import base
from catalog.check import compare, connect
from tests.conftest import SF_DIR

ORACLE = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_of_the_library_has_sql():
    assert set(base.QUERIES) == set(base.ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], ORACLE[name], SF_DIR) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["Source", "Node", "Memo", "Text", "Fragment"]
