"""The entry imports and the workers run without the repository on any path."""

import os
import subprocess
import sys

import pyspark
import pytest
from pyspark.ml.feature import StopWordsRemover

from talklake.functions.terms import english_stop_words

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_stop_words_are_those_of_spark(spark):
    assert sorted(english_stop_words()) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


def test_entry_imports_from_the_zip_without_a_session(tmp_path):
    zips = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    path = [os.path.join(zips, n) for n in sorted(os.listdir(zips), reverse=True) if n.endswith(".zip")]
    code = (
        f"import sys; sys.path[:0] = {path!r}; sys.path.append({REPO!r})\n"
        "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert min(map(int, done.stdout.split()[-2:])) >= 39


def test_functions_on_workers_travel_with_their_code():
    from pyspark import cloudpickle
    from talklake.operators import vectors

    sent = cloudpickle.dumps(vectors._best)
    code = "import pickle, sys; f = pickle.load(sys.stdin.buffer); print(f.__name__)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], input=sent, cwd="/", env=env, capture_output=True, timeout=120)
    assert done.returncode == 0, done.stderr.decode()


def test_search_runs_under_submit_without_a_path(tmp_path):
    job = tmp_path / "job.py"
    job.write_text(
        "import sys\n"
        f"sys.path.insert(0, {REPO!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.getOrCreate()\n"
        "import __spark_entry__ as e\n"
        "print('ROWS', len(e.queries()['search_topk'](spark, '/root/testdata/sf0.001').collect()))\n"
    )
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    options = ["--master", "local[2]", "--conf", "spark.ui.enabled=false"]
    done = subprocess.run([submit, *options, str(job)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=280)
    assert "ROWS 50" in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize("library", ["duckdb", "tiktoken", "ahocorasick", "regex", "public_tokenizers", "no_such_part"])
def test_queries_do_not_need_the_libraries_of_the_training_data_part(library):
    """A missing library costs the queries that need it at most, and says which it was."""
    code = (
        "import sys, warnings\n"
        f"sys.path.insert(0, {REPO!r})\n"
        f"sys.modules[{library!r}] = None\n"
        "warnings.simplefilter('ignore')\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert len(names) >= 47 and 'search_topk' in names and set(e.oracle_sql()) <= names, names\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_a_missing_module_of_the_library_is_an_error():
    code = (
        "import sys\n"
        f"sys.path.insert(0, {REPO!r})\n"
        "sys.modules['talklake.session'] = None\n"
        "import __spark_entry__ as e\n"
        "e._llm('talklake.plans.fetch')\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True, timeout=120)
    assert done.returncode != 0 and "talklake.session" in done.stderr
