"""Every query with an SQL twin, on the smallest tables, plus the shape of the entry module."""

import os

import pytest

from riskloom.plans.catalog import ORACLES, QUERIES
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    problem, _, _ = compare(spark, con, FOLDER, QUERIES[name], ORACLES[name])
    assert problem is None


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 2
