"""Every registered query against its SQL, on the smallest data."""

import os

import pytest

import __spark_entry__ as entry_points
from checks.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_flagship(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["codigo", "menor_preco", "recomendacao", "origem", "link"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert not df.isEmpty()
    if name in SQL:
        assert differences(df, con.sql(SQL[name])) == ""
