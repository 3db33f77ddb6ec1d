"""Inverted lists: approximate search with recall, exact search with pruning, lists kept up by writes."""

import os
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog import queries as catalog
from talklake.operators import quantise, vectors
from talklake.sources.store import Store, points

SF_DIR = "/root/testdata/sf0.01"


def clustered(n=3000, size=16, groups=40, seed=1):
    dice = np.random.default_rng(seed)
    centres = dice.normal(size=(groups, size))
    return (centres[dice.integers(groups, size=n)] + 0.15 * dice.normal(size=(n, size))).tolist()


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, v, f"g{i % 3}" if i % 100 else "rare") for i, v in enumerate(clustered())]
    df = spark.createDataFrame(rows, "video_id bigint, embedding array<double>, label string").repartition(6)
    model = quantise.Quantiser.fit(df, 16, lists=60, parts=4)
    return df, model, model.assign(df)


def asked_of(df):
    return df.where("video_id % 50 = 0").select(F.col("video_id").alias("query_id"), "embedding", "label")


def hits(found, skip_itself=True):
    own = {}
    for r in found.orderBy("query_id", "rank").collect():
        if not skip_itself or r["query_id"] != r["video_id"]:
            own.setdefault(r["query_id"], []).append((r["video_id"], r["score"]))
    return {q: h[:5] for q, h in own.items()}


def test_recall_and_rows_scored_on_clustered_vectors(corpus):
    df, model, rows = corpus
    queries = asked_of(df).drop("label")
    found, scored = quantise.near_lists(rows, queries, model, 0.06, 6)
    got, want = hits(found), hits(vectors.top_k(df, queries, 6))
    assert len(want) == 60
    total = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert total / sum(map(len, want.values())) >= 0.9
    shares = [r["scored"] / r["total"] for r in scored.collect()]
    assert len(shares) == 60 and sum(shares) / 60 < 0.1
    # Scores are exact, whatever the codes said.
    exact = {(q, i): s for q, h in hits(vectors.top_k(df, queries, 60), False).items() for i, s in h}
    assert all(abs(exact[q, i] - s) < 1e-9 for q, h in got.items() for i, s in h if (q, i) in exact)


def test_pruned_search_is_the_full_scan_with_lists_skipped(corpus):
    df, model, rows = corpus
    queries = asked_of(df).drop("label")
    found, scored = quantise.exact_top_k(rows, queries, model, 6)
    assert hits(found, False) == hits(vectors.top_k(df, queries, 6), False)
    shares = [r["scored"] / r["total"] for r in scored.collect()]
    assert len(shares) == 60 and sum(shares) / 60 < 0.5


def test_rare_label_is_found(corpus):
    """Thirty rows of three thousand; each query asks the lists that hold rows of its label."""
    df, model, rows = corpus
    queries = asked_of(df).where("label = 'rare'")
    found, _ = quantise.near_lists(rows, queries, model, 0.5, 6, label="label")
    got, want = hits(found), hits(vectors.top_k(df.where("label = 'rare'"), queries.drop("label"), 6))
    total = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert want and total / sum(map(len, want.values())) >= 0.9


def test_rows_without_a_direction_are_in_no_list(spark, corpus):
    _, model, _ = corpus
    odd = spark.createDataFrame([(1, None), (2, []), (3, [0.0] * 16), (4, [1.0]), (5, [1.0] * 16)], "video_id bigint, embedding array<double>")
    rows = model.assign(odd)
    assert {r["video_id"] for r in rows.where("list IS NOT NULL").collect()} == {5}
    queries = odd.select(F.col("video_id").alias("query_id"), "embedding")
    for found, _ in (quantise.near_lists(rows, queries, model, 1.0, 2), quantise.exact_top_k(rows, queries, model, 2)):
        assert [(r["query_id"], r["video_id"]) for r in found.orderBy("query_id").collect()] == [(3, 5), (5, 5)]
    assert quantise.Quantiser.fit(odd.where("video_id < 4"), 16) is None


def test_index_is_kept_up_by_writes(spark, tmp_path):
    """Inserts and upserts reach the lists; superseded rows and uncommitted ones do not count."""
    made = clustered(200, 8, 5)
    rows = spark.createDataFrame([(f"v{i}", v, i) for i, v in enumerate(made)], "video_id string, embedding array<double>, number bigint")
    payload = {n: F.lit("x") for n in ("title", "channel", "url", "transcript")}
    full = rows.withColumns({**payload, "published": F.lit(datetime(2026, 1, 1)), "duration_seconds": F.lit(1), "topics": F.array(F.lit("t")), "metadata_tags": F.array(F.lit("m"))})
    all_points = points(full, datetime(2026, 1, 2), "b")
    store = Store.ensure(spark, str(tmp_path / "store"), 8, buckets=4)
    with pytest.raises(ValueError, match="no index"):
        store.index_rows()
    store.insert_if_absent(all_points.where("transcript_number < 120"))
    assert store.build_index(lists=6, parts=2)
    store.upsert(all_points.where("transcript_number BETWEEN 50 AND 150").withColumn("embedding", F.reverse("embedding")))
    store.insert_if_absent(all_points)
    store._append(store._checked(all_points.where("transcript_number < 9"), "never committed", "lost"))
    index, _ = store.index_rows()
    key = lambda df: sorted((r["video_id"], tuple(round(x, 5) for x in r["embedding"])) for r in df.select("video_id", "embedding").collect())
    assert key(index) == key(store.read()) and len(key(index)) == 200


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_recall_of_the_registered_queries(spark):
    for query in (catalog.search_index, catalog.search_index_filtered):
        found = query(spark, SF_DIR).collect()
        assert len(found) == 10
        assert sum(r["found"] for r in found) / sum(r["exact"] for r in found) >= 0.9
