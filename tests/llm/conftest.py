import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture
def docs(spark):
    """Documents from ``(doc_id, text)`` pairs, with columns that clash with the operators' names."""

    def make(rows, **extra):
        names = list(extra)
        data = [(i, t, *extra.values()) for i, t in rows]
        schema = "doc_id bigint, text string" + "".join(f", `{n}` string" for n in names)
        return spark.createDataFrame(data, schema)

    return make
