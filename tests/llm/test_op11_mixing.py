from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from talklake.llm import mixing

SCHEMA = "doc_id bigint, source string, text string, Size string, target string"


def make(spark, rows):
    return spark.createDataFrame([(i, s, t, "x", "y") for i, s, t in rows], SCHEMA)


def plain_targets(sizes, weights, budget, repeats):
    """Reshare what is over, source by source, until no target is above its room."""
    full = set()
    while True:
        free = [s for s in sizes if s not in full]
        left = budget - sum(repeats * sizes[s] for s in full)
        goals = {s: repeats * sizes[s] for s in full} | {s: left * weights[s] / sum(weights[f] for f in free) for s in free}
        over = {s for s in free if goals[s] > repeats * sizes[s]}
        if not over:
            return goals
        full |= over


def taken_of(mixed):
    return mixed.documents.select("doc.*", F.col("size").alias("n"), "source_size", F.col("target").alias("goal"), "taken").collect()


def test_against_plain_targets_and_a_plain_queue(spark):
    rows = [(i, f"s{i % 7}" if i % 3 else "hot", "w " * (i * i % 41)) for i in range(700)] + [(900 + i, None, "a b c") for i in range(9)]
    found = taken_of(mixing.mix(make(spark, rows)))
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for r in found:
        assert r.n == len(dict((i, t) for i, _, t in rows)[r.doc_id].split())
        sizes[r.source] += r.n
    names = sorted(s for s in sizes if s is not None) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    goals = plain_targets(dict(sizes), weights, 1.5 * sum(sizes.values()), 2)
    took = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and r.goal == pytest.approx(goals[r.source])
        assert r.taken in (0, r.n, 2 * r.n)
        took[r.source] += r.taken
    largest = max(r.n for r in found)
    assert sum(took.values()) <= 1.5 * sum(sizes.values()) < sum(took.values()) + largest
    assert all(abs(took[s] - goals[s]) <= largest for s in goals)


def test_mix_is_in_order_of_finish_and_agrees_with_the_counts(spark):
    rows = [(i, "ab"[i % 2], "w " * (1 + i % 5)) for i in range(200)]
    mixed = mixing.mix(make(spark, rows))
    listed = [tuple(r) for r in mixing.ordered(mixed).select("doc_id", "epoch", "finish").collect()]
    assert [f for _, _, f in listed] == sorted(f for _, _, f in listed)
    counts = defaultdict(int)
    for i, _, _ in listed:
        counts[i] += 1 + i % 5
    assert counts == {r.doc_id: r.taken for r in taken_of(mixed) if r.taken}
    assert [i for i, _, _ in listed][:20] != sorted(i for i, _, _ in listed)[:20]


def test_reruns_and_other_partitions_agree(spark):
    rows = [(i, f"s{i % 4}", f"{i} " * (i % 9)) for i in range(300)]
    first = sorted((r.doc_id, r.taken) for r in taken_of(mixing.mix(make(spark, rows))))
    again = sorted((r.doc_id, r.taken) for r in taken_of(mixing.mix(make(spark, rows[::-1]).repartition(7))))
    assert first == again


def test_hard_rows(spark):
    """Null ids, texts and sources, empty and repeated rows, a long text; clashing names stay in the struct."""
    rows = [(None, None, None), (None, "a", "x y"), (1, "a", ""), (1, "a", ""), (2, "b", "w " * 50_000)] + [(3, "b", "u v")] * 40
    mixed = mixing.mix(make(spark, rows))
    found = taken_of(mixed)
    assert len(found) == len(rows) and all(r.taken <= 2 * r.n for r in found)
    assert {r.n for r in found if r.source is None} == {0}
    assert {r.goal for r in found if r.source is None} == {0.0}
    assert {(r.Size, r.target) for r in found} == {("x", "y")}
    # Forty equal rows are forty documents.
    assert sum(1 for r in found if r.doc_id == 3) == 40


def test_hot_equal_rows_are_counted_one_by_one(spark):
    rows = [(7, "a", "one two three")] * 3000 + [(i, "b", "x y") for i in range(1000)]
    found = taken_of(mixing.mix(make(spark, rows)))
    took = sum(r.taken for r in found if r.source == "a")
    goal = next(r.goal for r in found if r.source == "a")
    assert abs(took - goal) <= 3


def test_empty_and_wordless_tables(spark):
    assert taken_of(mixing.mix(make(spark, []).limit(0))) == []
    found = taken_of(mixing.mix(make(spark, [(1, "a", " "), (2, None, None)])))
    assert [(r.n, r.goal, r.taken) for r in found] == [(0, 0.0, 0)] * 2


def test_weights_of_the_user(spark):
    rows = [(i, "ab"[i % 2], "w w") for i in range(400)]
    weights = spark.createDataFrame([("a", 3), ("b", 1)], "source string, weight bigint")
    found = taken_of(mixing.mix(make(spark, rows), weights, share=0.5))
    assert {(r.source, r.goal) for r in found} == {("a", 300.0), ("b", 100.0)}
    assert sum(r.taken for r in found) == 400
    with pytest.raises(Exception, match="no positive weight"):
        mixing.mix(make(spark, rows), weights.where("source = 'a'"))
