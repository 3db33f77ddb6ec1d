import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from talklake.operators import embed, vectors
from talklake.plans.search import search
from talklake.sources import results

DIM = 8


def cosine(a, b):
    na, nb = np.linalg.norm(a), np.linalg.norm(b)
    return float(a @ b / (na * nb)) if na and nb else 0.0


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    corpus = rng.normal(size=(300, DIM)).astype(np.float32)
    corpus[200:260] = corpus[0]  # a group of copies
    corpus[260:264] = 0
    return corpus, rng.normal(size=(23, DIM)).astype(np.float32)


@pytest.fixture(scope="module")
def frames(spark, data):
    corpus, queries = data
    rows = [(f"v{i:03d}", [float(x) for x in v]) for i, v in enumerate(corpus)] + [("short", [1.0]), ("none", None)]
    store = spark.createDataFrame(rows, "video_id string, embedding array<float>").repartition(5)
    asked = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(queries)], "query_id int, embedding array<float>"
    )
    return store, asked


def expected(data, k):
    corpus, queries = data
    out = {}
    for q, query in enumerate(queries.astype(np.float64)):
        scored = [(-round(cosine(v, query), 12), f"v{i:03d}") for i, v in enumerate(corpus.astype(np.float64))]
        out[q] = [(name, round(-s, 9)) for s, name in sorted(scored)[:k]]
    return out


def got(rows):
    out = {}
    for r in rows.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["video_id"], round(r["score"], 9)))
    return out


@pytest.mark.parametrize("k, rows, queries", [(5, 1 << 14, 1 << 10), (5, 7, 4), (70, 50, 30), (400, 1 << 14, 9)])
def test_top_k_equals_brute_force(frames, data, k, rows, queries, monkeypatch):
    monkeypatch.setattr(vectors, "ROW_BLOCK", rows)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", queries)
    assert got(vectors.top_k(*frames, k=k)) == expected(data, k)


def test_vectors_of_several_sizes(frames, data):
    store, asked = frames
    short = store.sparkSession.createDataFrame([(900, [2.0]), (901, [0.5, 1.0, 1.0]), (902, None)], "query_id int, embedding array<float>")
    found = got(vectors.top_k(store, asked.unionByName(short)))
    assert found.pop(900) == [("short", 1.0)] and found == expected(data, 5)


def test_top_k_with_number_ids(frames, data):
    store, asked = frames
    numbered = store.where("video_id like 'v%'").select(F.substring("video_id", 2, 9).cast("int").alias("vec"), "embedding")
    rows = vectors.top_k(numbered, asked, id_col="vec")
    assert dict(rows.dtypes) == {"query_id": "int", "rank": "int", "vec": "int", "score": "double"}
    first = [r["vec"] for r in rows.where("query_id = 0").orderBy("rank").collect()]
    assert first == [int(name[1:]) for name, _ in expected(data, 5)[0]]


def test_no_queries_and_no_corpus(frames):
    store, asked = frames
    assert vectors.top_k(store, asked.where("false")).count() == 0
    assert vectors.top_k(store.where("false"), asked).count() == 0


def test_corpus_is_not_joined_or_shuffled(frames, plan):
    text = plan(vectors.top_k(*frames))
    assert "Join" not in text and "CartesianProduct" not in text
    assert text.count("Exchange hashpartitioning") == 1
    with open(vectors.__file__) as file:
        source = file.read()
    assert ".collect()" not in source and ".first()" not in source


def test_filtered_search(frames, data):
    store, asked = frames
    part = store.where("video_id >= 'v100'")
    assert all(name >= "v100" for hits in got(vectors.top_k(part, asked)).values() for name, _ in hits)


def test_nearest(frames, data, plan):
    store, _ = frames
    corpus, queries = data
    found = vectors.nearest(store, [float(x) for x in queries[3]])
    assert "TakeOrderedAndProject" in plan(found)
    assert [r["video_id"] for r in found.collect()] == [name for name, _ in expected(data, 5)[3]]


def test_cosine_expression(one):
    arr = lambda *xs: F.array(*[F.lit(float(x)) for x in xs])
    assert one(vectors.cosine(arr(1, 0), arr(1, 1))) == pytest.approx(math.sqrt(0.5))
    assert one(vectors.cosine(arr(0, 0), arr(1, 1))) == 0.0


def test_approximate_search(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, DIM))
    points = np.repeat(centres, 30, axis=0) + rng.normal(scale=0.1, size=(600, DIM))
    store = spark.createDataFrame(
        [(f"p{i}", [float(x) for x in v]) for i, v in enumerate(points)], "video_id string, embedding array<float>"
    )
    asked = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(centres)] + [(99, None)], "query_id int, embedding array<float>"
    )
    planes = vectors.SignPlanes(tables=8, bits=6)
    indexed, questions = planes.with_keys(store), planes.with_keys(asked)
    near, exact = got(vectors.near_top_k(indexed, questions)), got(vectors.top_k(store, asked))
    found = sum(len(set(near.get(q, [])) & set(hits)) for q, hits in exact.items())
    assert found / 100 >= 0.9 and 99 not in near
    assert vectors.sharing_keys(indexed, questions).count() < 0.4 * 20 * 600
    # Against brute force over the same keys.
    rows = {r["video_id"]: set(r["keys"]) for r in indexed.collect()}
    keys = {r["query_id"]: set(r["keys"] or []) for r in questions.collect()}
    normals = planes.normals(DIM)
    for i, v in enumerate(points.astype(np.float32).astype(np.float64)):
        sides = (normals @ v > 0).reshape(8, 6)
        assert rows[f"p{i}"] == {(t << 6) + sum(1 << b for b in range(6) if sides[t, b]) for t in range(8)}
    by_name = {f"p{i}": v.astype(np.float32).astype(np.float64) for i, v in enumerate(points)}
    for q, centre in enumerate(centres):
        scored = sorted(
            (-round(cosine(by_name[n], centre.astype(np.float32).astype(np.float64)), 12), n)
            for n, own in rows.items()
            if own & keys[q]
        )[:5]
        assert [n for n, _ in near[q]] == [n for _, n in scored]


def test_hashed_terms(spark):
    texts = spark.createDataFrame([(1, "red fox red"), (2, "fox red red"), (3, ""), (4, "1 2"), (5, None)], "id int, text string")
    rows = {r["id"]: r["embedding"] for r in embed.embed(texts, embed.HashedTerms(16), "text").collect()}
    assert rows[1] == rows[2] and len(rows[1]) == 16
    assert sum(x * x for x in rows[1]) == pytest.approx(1, abs=1e-6)
    assert rows[3] is None and rows[5] is None and set(rows[4]) == {0.0}


def test_model_runs_in_batches_and_is_loaded_once(spark, tmp_path):
    log = str(tmp_path / "loads")

    def load():
        with open(log, "a") as f:
            f.write("load\n")

        def encode(texts):
            assert 0 < len(texts) <= 32 and all(texts)
            return [[float(len(t)), float(len(texts))] for t in texts]

        return encode

    model = embed.BatchModel(load, vector_size=2)
    texts = spark.createDataFrame(pd.DataFrame({"id": range(100), "text": ["x" * (i % 7) for i in range(100)]})).coalesce(1)
    rows = {r["id"]: r["embedding"] for r in embed.embed(texts, model, "text").collect()}
    for i in range(100):
        assert (rows[i] is None) if i % 7 == 0 else rows[i][0] == i % 7
    assert max(v[1] for v in rows.values() if v) == 32.0
    assert open(log).read().count("load") == 1


def test_vector_sizes():
    assert [embed.vector_size(m) for m in ("all-MiniLM-L6-v2", "all-mpnet-base-v2", "other")] == [384, 768, 384]


@pytest.fixture(scope="module")
def store(spark):
    embedder = embed.HashedTerms(32)
    rows = spark.createDataFrame(
        [("v1", "apples and pears", ["fruit"]), ("v2", "iron and steel", None), ("v3", "pears", ["fruit", "pears"])],
        "video_id string, text string, topics array<string>",
    )
    return embed.embed(rows, embedder, "text").select(
        "video_id",
        F.concat(F.lit("T "), "video_id").alias("title"),
        F.lit("C").alias("channel"),
        F.lit("2026-03-01 00:00:00").cast("timestamp_ntz").alias("published_date"),
        F.lit("u").alias("url"),
        "topics",
        "embedding",
    )


def test_search_by_text(spark, store):
    texts = spark.createDataFrame([("q1", "pears"), ("q2", ""), ("q3", "steel")], "query_id string, text string")
    hits = search(store, texts, embed.HashedTerms(32), k=2)
    rows = hits.orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["video_id"]) for r in rows if r["rank"] == 1] == [("q1", "v3"), ("q3", "v2")]
    assert rows[0]["score"] == pytest.approx(1.0) and rows[0]["published_date"] == "2026-03-01T00:00:00"
    limited = search(store, texts, embed.HashedTerms(32), k=2, where=F.array_contains("topics", "pears"))
    assert {r["video_id"] for r in limited.collect()} == {"v3"}
    shown = {(r["query_id"], r["rank"]): r["text"] for r in results.as_text(hits, texts).collect()}
    assert shown[("q1", 1)] == (
        "1. [1.000] T v3\n   Channel: C\n   Date: 2026-03-01T00:00:00\n   URL: u\n   Topics: fruit, pears"
    )
    assert shown[("q3", 1)].endswith("Topics: ")
    assert shown[("q2", 0)] == "No results found."
    json = [r["json"] for r in results.as_json(hits).where("query_id = 'q1' and rank = 1").collect()][0]
    assert '"video_id":"v3"' in json and '"topics":["fruit","pears"]' in json
    near = search(store, texts, embed.HashedTerms(32), k=1, planes=vectors.SignPlanes(tables=12, bits=2))
    assert ("q1", "v3") in [(r["query_id"], r["video_id"]) for r in near.collect()]
