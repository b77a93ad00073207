"""Every registered query against DuckDB on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_query(spark, duck, key):
    df = entry.queries()[key](spark, FOLDER)
    if key in SQL:
        diff = compare(df, duck, SQL[key])
        assert diff is None or diff == "no rows", diff
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())
