"""Every registered query against DuckDB on the smallest test tables."""

import os

import pytest

from checks.compare import connect, differences
from checks.oracle import build
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
SQL = build()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in SQL:
        assert differences(spark, con, SF, name, SQL[name]) == ""
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)
