import os
import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from talklake.llm import reshard as rs
from tests.llm.test_op05_reshard import moved, plan_of


def frame(spark, rows):
    return spark.createDataFrame([(o, d, t, o) for o, d, t in rows], "source int, doc_id bigint, text string, Slot int")


def test_move_writes_what_the_plan_says(spark, tmp_path):
    rng = random.Random(4)
    rows = [(0 if rng.random() < 0.5 else rng.randrange(4), i % 90, rng.choice([None, "", "é" * rng.randint(1, 40)])) for i in range(400)]
    rows += [(1, None, t) for t in (None, "", "x", "x", "y" * 5000)] + [(2, None, "same")] * 30
    path = str(tmp_path / "shards")
    got = rs.move(frame(spark, rows), F.col("source"), 6, 4, path, blocks=8).collect()
    names = ("old", "doc_id", "size", "text_crc32", "shard", "slot")
    want = Counter(tuple(r[n] for n in names) for r in plan_of(spark, rows, 6, 4).collect())
    assert Counter(tuple(r["old_shard" if n == "old" else n] for n in names) for r in got) == want
    files = spark.read.parquet(path)
    assert sorted(files.columns) == ["doc_id", "old_shard", "shard", "slot", "source", "text"]
    assert Counter((r["source"], r["doc_id"], r["text"]) for r in files.collect()) == Counter(rows)


def test_shards_that_stay_are_not_written(spark, tmp_path):
    # All shards get 100 bytes: shard 0 has 150 and sends 50 to shard 2; shards 1 and 3 have theirs.
    rows = [(0, i, "a" * 9) for i in range(15)] + [(2, 50 + i, "a" * 9) for i in range(5)]
    rows += [(3, 100 + i, None) for i in range(100)] + [(1, 300 + i, "") for i in range(100)]
    path = str(tmp_path / "shards")
    got = rs.move(frame(spark, rows), F.col("source"), 4, 4, path, blocks=8).collect()
    assert Counter((r["old_shard"], r["shard"]) for r in got) == {(0, 0): 10, (0, 2): 5, (2, 2): 5, (1, 1): 100, (3, 3): 100}
    assert {f for f in os.listdir(path) if f.startswith("shard=")} == {"shard=0", "shard=2"}
    assert all(r["text_crc32"] == zlib.crc32(b"a" * 9) for r in got if r["doc_id"] < 80)


def test_nothing_to_move_and_no_rows(spark, tmp_path):
    rows = [(i % 2, i, "abc") for i in range(40)]
    got = rs.move(frame(spark, rows), F.col("source"), 2, 2, str(tmp_path / "a")).collect()
    assert len(got) == 40 and all(r["old_shard"] == r["shard"] for r in got)
    assert rs.move(frame(spark, []), F.col("source"), 3, 2, str(tmp_path / "b")).collect() == []


def test_many_shards_cost_no_time_and_equal_the_general_flow():
    rng = random.Random(5)
    for _ in range(20):
        old = [rng.randint(0, 30) for _ in range(rng.randint(1, 6))]
        new = rs.capacities(sum(old) + rng.randint(0, 9), rng.randint(1, 7))
        general = rs.min_cost_flow(old, new, [[int(i != j) for j in range(len(new))] for i in range(len(old))])
        assert moved(rs.transfers(old, new)) == moved(general)
    old = [rng.randint(0, 10**9) for _ in range(rs.MAX_SHARDS)]
    flow = rs.transfers(old, rs.capacities(sum(old), rs.MAX_SHARDS))
    assert [sum(r) for r in flow] == old


def test_query_reads_what_it_wrote(spark, sf_dir):
    from talklake.llm.queries import op5_resharding

    got = {(r["doc_id"], r["text_crc32"], r["size"]) for r in op5_resharding(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert got == {(r["doc_id"], zlib.crc32((r["text"] or "").encode()), len((r["text"] or "").encode()) + 1) for r in docs}
