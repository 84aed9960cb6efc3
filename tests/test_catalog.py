import pytest
from compare import difference, open_tables

from hustings.catalog import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_its_sql(spark, tables, key):
    assert difference(QUERIES[key](spark, SF), tables, SQL[key]) is None


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
