import random

import pytest

from talklake.operators.documents import numbered
from talklake.operators.numbering import number_rows


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = set()
    for _ in range(600):
        # One group holds most rows; keys have gaps.
        group = 4 if rng.random() < 0.7 else rng.randint(0, 40)
        data.add((group, rng.randint(1, 5000)))
    data = list(data)
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "ord int, position long").repartition(6)


@pytest.mark.parametrize("partitions", [1, 7, None])
def test_numbers_within_groups(rows, partitions):
    data, df = rows
    got = {(r["ord"], r["position"]): r["n"] for r in number_rows(df, "ord", "position", "n", partitions=partitions).collect()}
    for group in {g for g, _ in data}:
        for place, key in enumerate(sorted(k for g, k in data if g == group), 1):
            assert got[(group, key)] == place


@pytest.mark.parametrize("partitions, start", [(1, 1), (7, 100), (None, 5)])
def test_numbers_through_groups(rows, partitions, start):
    data, df = rows
    out = number_rows(df, "ord", "position", "n", partitions=partitions, start=start, through_groups=True)
    got = {(r["ord"], r["position"]): r["n"] for r in out.collect()}
    assert got == {key: start + i for i, key in enumerate(sorted(data))}


def test_documents_are_numbered_in_registry_order(rows):
    data, df = rows
    got = {(r["ord"], r["position"]): r["number"] for r in numbered(df, 7).collect()}
    assert got == {key: 7 + i for i, key in enumerate(sorted(data))}


def test_sparse_keys_and_a_hot_group(spark):
    hot = spark.range(3000).selectExpr("1 AS ord", "id * 7919 * 1000003 AS position")
    out = number_rows(hot, "ord", "position", "n", partitions=6)
    got = {r["position"]: r["n"] for r in out.collect()}
    assert [got[k] for k in sorted(got)] == list(range(1, 3001))
