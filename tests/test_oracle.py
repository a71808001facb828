"""Every registered query against its DuckDB oracle at sf0.001 (the driver does the same at sf0.01)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], SQL.get(name), SF, con)
    assert r["spark_rows"] >= 0
    if name in SQL:
        assert r["schema_match"], r
        assert r["value_match"], r


def test_entry(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"source", "id", "key", "split", "text"}
    assert df.count() > 0
