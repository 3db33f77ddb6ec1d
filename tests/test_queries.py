"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]
ORACLE = {n: sql for n, sql in entry.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = rows_of(df.columns, df.collect())
    assert got
    if name in ORACLE:
        cursor = con.execute(ORACLE[name])
        names = [c[0] for c in cursor.description]
        assert sorted(names) == sorted(df.columns)
        assert got == rows_of(names, cursor.fetchall())


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    # Which rows an approximate search finds is beyond SQL; these queries compare with the exact search themselves.
    # A network's weights are drawn by numpy; test_encoder holds its vectors.
    assert set(QUERIES) - set(ORACLE) == {"search_index", "search_index_filtered", "embed_ngrams"}
