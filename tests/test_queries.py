"""Every registered query against its SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import TABLES, rows_of

DIRECTORY = "/root/testdata/sf0.001"
SQL = entry_points.oracle_sql()
QUERIES = entry_points.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIRECTORY}/{t}.parquet'")
    cursor = con.execute(SQL[name])
    expected_columns = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    df = QUERIES[name](spark, DIRECTORY)
    assert sorted(df.columns) == sorted(expected_columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(expected_columns, expected)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
