"""Every registered query on the smallest tables, against SQL where there is some."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
# The smallest tables have no history that is long enough for the risk job.
LONGER = "/root/testdata/sf0.01"
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return {folder: connect(folder) for folder in (FOLDER, LONGER)}


def test_every_check_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    folder = LONGER if "brand_long" in SQL[name] else FOLDER
    assert differences(QUERIES[name](spark, folder), con[folder], SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert sorted(entry.entry(spark).columns) == ["date", "ret", "series"]
