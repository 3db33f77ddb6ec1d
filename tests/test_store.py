from datetime import datetime

import pytest
from pyspark.sql import functions as F

from talklake.functions.ids import point_id
from talklake.operators.candidates import stored_among, unprocessed, with_point
from talklake.schemas import STORE
from talklake.session import scratch_path, staged
from talklake.sources import store as st
from talklake.sources.store import Store

AS_OF = datetime(2026, 3, 1, 6, 30)


def rows(spark, ids, title, size=2, batch="b", order=None, start=1):
    df = spark.createDataFrame([(str(i), n) for n, i in enumerate(ids, start)], "video_id string, number long")
    videos = df.withColumns(
        {
            "title": F.lit(title),
            "channel": F.lit("c"),
            "published": F.lit("2026-02-01").cast("timestamp_ntz"),
            "url": F.lit("u"),
            "duration_seconds": F.lit(3),
            "transcript": F.repeat(F.lit("x"), 8001),
            "topics": F.array(F.lit("t")),
            "metadata_tags": F.lit(None).cast("array<string>"),
            "embedding": F.array_repeat(F.lit(0.5), size),
        }
    )
    return st.points(videos, AS_OF, batch, order)


@pytest.fixture
def store(spark):
    return Store.ensure(spark, scratch_path(spark, "store"), vector_size=2, buckets=4)


def content(store):
    return {r["video_id"]: r["title"] for r in store.read().collect()}


def test_ensure_keeps_what_exists(spark, store):
    assert store.read().count() == 0 and store.read().schema == STORE
    store.upsert(rows(spark, [1, 2], "a"))
    again = Store.ensure(spark, store.root, vector_size=99, buckets=7)
    assert (again.vector_size, again.buckets) == (2, 4)
    assert content(again) == {"1": "a", "2": "a"}


def test_payload(spark, store):
    store.upsert(rows(spark, [1], "a"))
    row = store.read().first()
    assert len(row["transcript_text"]) == 8000 and row["metadata_tags"] == []
    assert row["indexed_at"] == AS_OF and row["batch_id"] == "b" and row["transcript_number"] == 1
    assert row["point_id"] == store.spark.range(1).select(point_id(F.lit("1"))).first()[0]
    assert row["bucket"] == row["point_id"] % 4


def test_upsert_replaces_and_twice_is_once(spark, store):
    store.upsert(rows(spark, range(20), "old"))
    for _ in range(2):
        store.upsert(rows(spark, range(15, 30), "new"))
        want = {str(i): "old" for i in range(15)} | {str(i): "new" for i in range(15, 30)}
        assert content(store) == want and store.read().count() == 30


def files(store):
    rows = store.spark.read.schema(STORE).parquet(store.path)
    return set(map(tuple, rows.select(F.input_file_name(), "bucket").distinct().collect()))


def test_upsert_only_appends(spark, store):
    store.upsert(rows(spark, range(40), "old"))
    before = files(store)
    store.upsert(rows(spark, [7], "new"))
    assert before < files(store)
    assert content(store)["7"] == "new" and store.read().count() == 40


def test_what_is_not_committed_is_not_read(spark, store):
    store.upsert(rows(spark, range(6), "old"))
    before = content(store)
    commit, store._commit = store._commit, lambda write_id: None
    store.upsert(rows(spark, range(3, 9), "lost"))
    store.insert_if_absent(rows(spark, range(20, 22), "lost"))
    assert content(store) == before and store.read().count() == 6
    store._commit = commit
    store.upsert(rows(spark, range(3, 9), "new"))
    assert content(store) == {str(i): "old" if i < 3 else "new" for i in range(9)} and store.read().count() == 9


def test_compaction_drops_superseded_rows(spark, store):
    store.upsert(rows(spark, range(40), "old"))
    assert store.compact() == 0
    store.upsert(rows(spark, range(30), "new"))
    want, kept = content(store), files(store)
    assert store.compact(0.99) == 0 and files(store) == kept
    assert store.compact() == 4
    assert content(store) == want and spark.read.schema(STORE).parquet(store.path).count() == 40
    store.upsert(rows(spark, [1], "newer"))
    assert content(store) == want | {"1": "newer"}


def test_skip_join_reads_the_buckets_of_the_candidates(spark, store, plan):
    store.upsert(rows(spark, range(40), "old"))
    some = staged(with_point(spark.createDataFrame([("7",), ("99",)], "video_id string"), store.buckets), "some")
    known = stored_among(some, store.read())
    assert "dynamicpruning" in plan(known.select("video_id")).lower()
    assert [r["video_id"] for r in known.collect()] == ["7"]
    assert [r["video_id"] for r in unprocessed(some, store.read()).collect()] == ["99"]


def test_insert_if_absent(spark, store):
    store.insert_if_absent(rows(spark, range(10), "old"))
    for _ in range(2):
        store.insert_if_absent(rows(spark, range(5, 15), "new"))
        assert content(store) == {str(i): "old" if i < 10 else "new" for i in range(15)}
        assert store.read().count() == 15
    assert store.next_number() == 11


def test_equal_orders_have_one_winner(spark):
    frame = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b"), ("k", 0, "c")], "point_id string, write_order int, title string")
    assert {st.last_write(frame.repartition(n)).first()["title"] for n in (1, 2, 3)} == {"b"}


def test_text_cap_is_a_parameter(spark):
    videos = spark.createDataFrame([("1", "c" * 9000)], "video_id string, transcript string").withColumns(
        {n: F.lit(None).cast(k) for n, k in {"embedding": "array<float>", "title": "string", "channel": "string", "published": "timestamp_ntz", "url": "string", "duration_seconds": "bigint", "topics": "array<string>", "metadata_tags": "array<string>", "number": "bigint"}.items()}
    )
    length = lambda **k: st.points(videos, AS_OF, **k).select(F.length("transcript_text")).first()[0]
    assert (length(), length(text_cap=5), length(text_cap=None)) == (8000, 5, 9000)


def test_last_write_wins_within_a_batch(spark, store):
    first = rows(spark, [1, 2, 3], "first", order=F.lit(1))
    later = rows(spark, [2], "later", order=F.lit(5))
    store.upsert(later.unionByName(first))
    assert content(store) == {"1": "first", "2": "later", "3": "first"}


def test_wrong_size_is_not_stored(spark, store):
    store.insert_if_absent(rows(spark, [1], "a", size=3).unionByName(rows(spark, [2], "a")))
    assert set(content(store)) == {"2"}
    store.upsert(rows(spark, [3], "a", size=1))
    assert set(content(store)) == {"2"}
    assert {(r["video_id"], len(r["embedding"])) for r in store.rejected().collect()} == {("1", 3), ("3", 1)}
