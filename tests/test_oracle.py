"""Every registered query against its reference SQL, on the smallest test tables."""

import os

import pytest

from harness.compare import connect, difference
from harness.oracle import oracle_sql
from harness.queries import queries

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_reference_sql():
    assert list(queries()) == list(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    assert difference(spark, con, SF_DIR, name) is None


def test_flagship_query(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
