import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from talklake.llm import reshard as rs


def moved(flow):
    return sum(x for i, row in enumerate(flow) for j, x in enumerate(row) if i != j)


def test_fewest_bytes_move():
    rng = random.Random(1)
    for _ in range(50):
        old = [rng.choice([0, rng.randint(1, 1000)]) for _ in range(rng.randint(1, 6))]
        new = rs.capacities(sum(old), rng.randint(1, 7))
        flow = rs.transfers(old, new)
        assert [sum(r) for r in flow] == old and [sum(c) for c in zip(*flow)] == new
        stays = sum(min(o, n) for o, n in zip(old, new))
        assert moved(flow) == sum(old) - stays


def test_flow_with_general_costs_equals_brute_force():
    rng = random.Random(2)
    for _ in range(20):
        supply, demand = [2, 1, 2], [1, 2, 3]
        cost = [[rng.randint(0, 9) for _ in demand] for _ in supply]
        flow = rs.min_cost_flow(supply, demand, cost)
        got = sum(f * c for fs, cs in zip(flow, cost) for f, c in zip(fs, cs))
        units = [i for i, s in enumerate(supply) for _ in range(s)]
        best = min(
            sum(cost[u][j] for u, j in zip(units, choice))
            for choice in itertools.product(range(3), repeat=len(units))
            if all(choice.count(j) <= demand[j] for j in range(3))
        )
        assert got == best
    with pytest.raises(ValueError):
        rs.min_cost_flow([5], [4], [[1]])


def plan_of(spark, rows, shards, old_shards, blocks=8):
    frame = spark.createDataFrame(rows, "old int, doc_id bigint, text string").select(
        "old", "doc_id", rs.size_of(F.col("text")).alias("size"), rs.checksum(F.col("text")).alias("text_crc32")
    )
    return rs.plan(frame, shards, old_shards, blocks)


def test_plan_is_even_gapless_and_moves_little(spark):
    rng = random.Random(3)
    rows = [(0 if rng.random() < 0.4 else rng.randrange(5), i, rng.choice([None, "", "é" * rng.randint(1, 50)])) for i in range(600)]
    rows += [rows[0], rows[0], (2, None, "x"), (4, 7, "long" * 400)]
    got = plan_of(spark, rows, 7, 5).collect()
    assert sorted(((r["old"], r["doc_id"], r["size"]) for r in got), key=repr) == sorted(((o, d, len((t or "").encode()) + 1) for o, d, t in rows), key=repr)
    sizes, slots = [0] * 7, [[] for _ in range(7)]
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    mean = sum(sizes) / 7
    assert max(abs(s - mean) for s in sizes) <= 120
    old = [sum(r["size"] for r in got if r["old"] == i) for i in range(5)]
    least = sum(old) - sum(min(o, c) for o, c in zip(old, rs.capacities(sum(old), 7)))
    assert sum(r["size"] for r in got if r["old"] != r["shard"]) <= least + 600
    crc = {d: zlib.crc32((t or "").encode()) for _, d, t in rows if d is not None}
    assert all(r["text_crc32"] == crc[r["doc_id"]] for r in got if r["doc_id"] is not None and r["doc_id"] != 7)


def test_no_rows_and_too_many_shards(spark):
    assert plan_of(spark, [], 3, 2).collect() == []
    with pytest.raises(ValueError):
        plan_of(spark, [], rs.MAX_SHARDS + 1, 2)


def test_rewrite_touches_only_shards_that_change(spark, tmp_path):
    rows = [(0, i, "a" * 9) for i in range(20)] + [(1, 100 + i, "b" * 9) for i in range(10)]
    planned = plan_of(spark, rows, 3, 2)
    docs = spark.createDataFrame([(d, t, "s") for _, d, t in rows], "doc_id bigint, text string, slot string")
    assert {r["shard"]: r["sources"] for r in rs.affected(planned).collect()}[1] == [1]
    path = str(tmp_path / "shards")
    written = {r["shard"]: r["count"] for r in rs.rewrite(docs, planned, path).collect()}
    assert written == {0: 10, 2: 10}
    assert spark.read.parquet(path).columns == ["doc_id", "text", "slot", "shard"]


def test_query_is_even(spark, sf_dir):
    from talklake.llm.queries import SHARDS, op5_resharding

    got = op5_resharding(spark, sf_dir)
    sizes = [r[1] for r in got.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == SHARDS
    assert got.groupBy("shard").agg((F.max("slot") + 1 - F.count("*")).alias("gap")).where("gap <> 0").isEmpty()
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
