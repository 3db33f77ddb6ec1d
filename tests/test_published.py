"""Files that become visible as a batch, or not at all."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from talklake.session import scratch_path
from talklake.sources import published


@pytest.fixture
def root(spark):
    return scratch_path(spark, "published")


def docs(spark, n, text="text", partitions=3):
    rows = spark.range(0, n, 1, partitions)
    name = F.format_string("TRANSCRIPT-%03d-x.md", "id")
    return rows.select(name.alias("filename"), F.concat(F.lit(text), F.lit(" "), F.col("id").cast("string"), F.lit("\n")).alias("content"))


def content(spark, root):
    return {(r["batch"], r["filename"]): r["content"] for r in published.read_published(spark, root).collect()}


def visible(root):
    return sorted(f for f in os.listdir(root) if f[0] != "_") if os.path.exists(root) else []


def test_a_failed_task_shows_nothing_and_a_repeat_shows_all(spark, root):
    whole = docs(spark, 30)
    broken = whole.withColumn(
        "content", F.when(F.col("filename").contains("-029-"), F.raise_error(F.lit("third task"))).otherwise(F.col("content"))
    )
    with pytest.raises(PySparkException):
        published.publish(broken, root, "one")
    assert visible(root) == []
    published.publish(whole, root, "one")
    want = {("one", f"TRANSCRIPT-{i:03d}-x.md"): f"text {i}\n" for i in range(30)}
    assert content(spark, root) == want and visible(root) == ["one"]
    # A later failure leaves the earlier batch as it was.
    with pytest.raises(PySparkException):
        published.publish(broken, root, "one")
    assert content(spark, root) == want and visible(root) == ["one"]


def test_a_batch_is_replaced_others_stay(spark, root):
    published.publish(docs(spark, 5), root, "one")
    published.publish(docs(spark, 2), root, "two")
    published.publish(docs(spark, 3, "new"), root, "one")
    found = content(spark, root)
    assert sorted(found) == [(b, f"TRANSCRIPT-{i:03d}-x.md") for b, n in (("one", 3), ("two", 2)) for i in range(n)]
    assert found[("one", "TRANSCRIPT-001-x.md")] == "new 1\n" and visible(root) == ["one", "two"]
    # An empty batch is visible, too.
    published.publish(docs(spark, 0), root, "one")
    assert {b for b, _ in content(spark, root)} == {"two"} and visible(root) == ["one", "two"]


def test_odd_rows(spark, root):
    published.publish(docs(spark, 1).withColumn("content", F.lit(None).cast("string")), root, "none")
    # The file is there and empty; Spark's readers pass over empty files.
    assert [(f, os.path.getsize(os.path.join(d, f))) for d, _, names in os.walk(root) for f in names] == [("TRANSCRIPT-000-x.md", 0)]
    assert content(spark, root) == {}
    for name in (None, "", "a/b.md"):
        with pytest.raises(PySparkException):
            published.publish(docs(spark, 4).withColumn("filename", F.lit(name).cast("string")), root, "odd")
    for batch in ("", "_hidden", ".x", "a/b"):
        with pytest.raises(ValueError):
            published.publish(docs(spark, 1), root, batch)
    assert visible(root) == ["none"]


def test_hidden_folders_are_cleared(spark, root):
    published.publish(docs(spark, 2), root, "one")
    os.makedirs(f"{root}/_staging-lost/attempt")
    published.clear_staging(root)
    assert os.listdir(root) == ["one"] and len(content(spark, root)) == 2
