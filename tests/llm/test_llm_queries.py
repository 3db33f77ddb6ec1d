"""The queries of this part against their SQL on the smallest tables, and the part's separation."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of
from talklake.llm import queries

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("name", list(queries.all_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    df = queries.ALL[name](spark, sf_dir)
    cursor = con.execute(queries.all_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())


def test_all_are_registered():
    assert {n.split("_")[0] for n in queries.ALL} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.ALL) | {"pipeline"} <= set(entry.queries())


def test_the_rest_does_not_need_this_part(tmp_path):
    """A copy without the part's folders still has the other queries."""
    code = (
        "import os, shutil, sys\n"
        f"shutil.copytree({REPO!r}, 'copy', ignore=shutil.ignore_patterns('.git', 'llm', 'corpus_pipeline.py', '__pycache__'))\n"
        "sys.path.insert(0, os.path.abspath('copy'))\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert len(names) >= 40 and 'pipeline' not in names and not any(n.startswith('op') for n in names), names\n"
        "assert set(e.oracle_sql()) <= names\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
