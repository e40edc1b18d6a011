"""Every registered query with SQL gives the same rows and types in Spark and in DuckDB."""

import pytest

import __spark_entry__ as registry
from tests.oracle import connect, duckdb_types, normalized

DIRECTORY = "/root/testdata/sf0.01"
QUERIES = registry._own_queries()
SQL = registry._own_sql()


@pytest.fixture(scope="module")
def connection():
    with connect(DIRECTORY) as found:
        yield found


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, connection, name):
    df = QUERIES[name](spark, DIRECTORY)
    relation = connection.sql(SQL[name])
    assert dict(df.dtypes) == duckdb_types(relation)
    ours = normalized([tuple(r) for r in df.collect()], df.columns)
    assert ours
    theirs = normalized(relation.fetchall(), relation.columns)
    assert ours == theirs


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert registry.entry(spark).columns == ["customer_id", "year_month", "order_count", "month_rank"]
