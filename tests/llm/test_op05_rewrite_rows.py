from collections import Counter

import pytest
from pyspark.sql import functions as F

from talklake.llm import reshard as rs
from tests.llm.test_op05_reshard import plan_of


def test_rewrite_keeps_null_and_repeated_rows(spark, tmp_path):
    rows = [(0, i % 7, "a" * 9) for i in range(40)] + [(0, None, t) for t in (None, "", "x", "x", "y")] + [(1, 100, "b" * 9)] * 6
    planned = plan_of(spark, rows, 3, 2)
    docs = spark.createDataFrame([(d, t) for _, d, t in rows], "doc_id bigint, text string")
    path = str(tmp_path / "shards")
    written = {r["shard"]: r["count"] for r in rs.rewrite(docs, planned, path).collect()}
    want = {r["shard"]: r["count"] for r in planned.groupBy("shard").count().collect()}
    assert written == {s: want[s] for s in written} and set(written) == {0, 1, 2}
    got = spark.read.parquet(path)
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter((d, t) for _, d, t in rows)
    place = lambda f: Counter((r["doc_id"], r["shard"], r["slot"]) for r in f.collect())
    assert place(got) == place(planned)


def test_copies_in_several_shards_need_their_shard(spark, tmp_path):
    rows = [(0, 5, "t" * 9)] * 20 + [(1, 5, "t" * 9)] * 10
    planned = plan_of(spark, rows, 3, 2)
    docs = spark.createDataFrame([(d, t, o) for o, d, t in rows], "doc_id bigint, text string, source int")
    with pytest.raises(ValueError):
        rs.rewrite(docs, planned, str(tmp_path / "a"))
    path = str(tmp_path / "b")
    written = {r["shard"]: r["count"] for r in rs.rewrite(docs, planned, path, old=F.col("source")).collect()}
    assert written == {0: 10, 2: 10}
    assert Counter(r["source"] for r in spark.read.parquet(path).collect()) == {0: 20}
