"""Every registered query equals its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import compare

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, small, name):
    if name not in ORACLE:
        pytest.skip("checked in its own test")
    try:
        wrong = compare.difference(spark, con, name, QUERIES[name], ORACLE[name], small)
    finally:
        spark.catalog.clearCache()
    assert wrong is None


def test_no_sql_without_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
