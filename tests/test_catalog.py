"""Every registered query against its SQL, on the smallest given tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tools.compare import connect, differences  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = df.collect()
    assert got
    if name in entry.oracle_sql():
        assert differences(df, got, db, entry.oracle_sql()[name]) == []


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
