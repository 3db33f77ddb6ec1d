"""Whole runs: fetch, and the stream over landed listings."""

import os
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from talklake import schemas
from talklake.operators import embed
from talklake.plans.fetch import Landing, fetch
from talklake.functions.ids import point_id
from talklake.session import scratch_path, scratch_run
from talklake.sources import landing as tables
from talklake.sources.store import Store
from talklake.streaming import incremental
from tests.conftest import TALK

AS_OF = datetime(2026, 3, 1, 6, 30)


def listing(spark, *rows):
    return tables.conform(
        spark.createDataFrame([(c, p, i, f"T {i}", "20260228") for c, p, i in rows], "channel_id string, position long, id string, title string, upload_date string"),
        "listing",
    )


@pytest.fixture(scope="module")
def landing(spark):
    words = lambda video, track, text: [(video, track, float(n), 1.0, n, s) for n, s in enumerate(text.split(". "))]
    segments = words("a1", "m", TALK) + words("a1", "g", "wrong track") + words("b1", "g", "tiny talk") + words("b2", "g", "[Music]. ") + words("b4", "g", TALK)
    return Landing(
        channels=spark.createDataFrame(
            [(0, "@a", "A", True, 30, 5, ["x"]), (1, "@b", "B", True, 30, 5, None), (2, "@broken", "C", True, 30, 5, None), (3, "@off", "D", False, 30, 5, None)],
            schemas.CHANNELS,
        ),
        listing=listing(
            spark, ("@a", 1, "a0"), ("@a", 2, "a1"), ("@a", 3, "a2"), ("@b", 1, "a1"), ("@b", 2, "b1"), ("@b", 3, "b2"), ("@b", 4, "b3"), ("@b", 5, "b4"), ("@off", 1, "o1")
        ),
        details=spark.createDataFrame([("a1", "Full", "Chan", "20260227", "w", 75, "0:00 Start\n1:00 End", None)], schemas.DETAILS),
        tracks=spark.createDataFrame(
            [("a0", "g", "en", True), ("a1", "g", "en", True), ("a1", "m", "en", False), ("a2", "g", "de", True), ("b1", "g", "en", True), ("b2", "g", "en", True), ("b4", "g", "en", True)],
            schemas.TRACKS,
        ),
        segments=tables.conform(
            spark.createDataFrame(segments, "video_id string, track_id string, start double, duration double, seq long, text string"), "segments"
        ),
        failed_channels=spark.createDataFrame([("@broken",)], "channel_id string"),
        failed_texts=spark.createDataFrame([("b3",), ("b3",)], "video_id string"),
    )


def seed(spark, vector_size=16):
    store = Store.ensure(spark, scratch_path(spark, "run"), vector_size, buckets=2)
    old = spark.createDataFrame([("a0", [1.0] * vector_size)], "video_id string, embedding array<float>")
    points = old.select(point_id(F.col("video_id")).alias("point_id"), "*").withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in schemas.STORE if f.name not in ("point_id", "video_id", "embedding")}
    )
    store.insert_if_absent(points.withColumn("transcript_number", F.lit(40).cast("bigint")))
    return store


def outcomes(run):
    return {(r["channel_id"], r["video_id"]): r["status"] for r in run.outcomes.collect()}


def test_fetch(spark, landing):
    store = seed(spark)
    run = fetch(landing, AS_OF, store=store, number_start=store.next_number())
    assert outcomes(run) == {
        ("@a", "a0"): "already_processed",
        ("@a", "a1"): "processed",
        ("@a", "a2"): "no_transcript",
        ("@b", "a1"): "already_processed",
        ("@b", "b1"): "processed",
        ("@b", "b2"): "no_transcript",
        ("@b", "b3"): "transcript_error",
        ("@b", "b4"): "processed",
        ("@broken", None): "channel_failed",
    }
    videos = {r["video_id"]: r for r in run.videos.collect()}
    assert {v: r["number"] for v, r in videos.items()} == {"a1": 41, "b1": 42, "b4": 43}
    assert videos["a1"]["title"] == "Full" and len(videos["a1"]["chapter_marks"]) == 2
    assert "tomatoes" in videos["a1"]["topics"] and videos["b1"]["topics"] == []
    assert videos["a1"]["transcript"].startswith("Tomatoes need warm soil")
    assert videos["b1"]["title"] == "T b1" and videos["b1"]["chapter_marks"] == []
    names = {r["filename"] for r in run.documents.collect()}
    assert names == {"TRANSCRIPT-041-chan.md", "TRANSCRIPT-042-b.md", "TRANSCRIPT-043-b.md"}
    assert run.summary.first()["processed"] == 3
    assert run.manifest.where("section = 'file'").count() == 3 and run.batch_id == "batch-2026-03-01T06-30-00"
    store.insert_if_absent(run.points)
    assert {r["video_id"] for r in store.read().collect()} == {"a0", "a1", "b1", "b4"}
    assert store.read().where("video_id = 'a1'").first()["metadata_tags"] == ["x"]
    # The next run finds nothing new.
    assert fetch(landing, AS_OF, store=store).videos.count() == 0


def test_without_store_nothing_is_skipped(spark, landing):
    run = fetch(landing, AS_OF)
    found = outcomes(run)
    assert found[("@a", "a1")] == found[("@b", "a1")] == "processed"
    assert run.videos.count() == 4 and run.documents.select("filename").distinct().count() == 4
    once = fetch(landing, AS_OF, once_per_run=True)
    assert outcomes(once)[("@b", "a1")] == "already_processed" and once.videos.count() == 3


def test_a_repeat_of_what_came_to_nothing_has_the_same_outcome(spark, landing):
    again = listing(spark, ("@a", 4, "b2"), ("@a", 5, "b3"))
    store = seed(spark)
    run = fetch(replace(landing, listing=landing.listing.unionByName(again)), AS_OF, store=store)
    found = outcomes(run)
    assert found[("@a", "b2")] == found[("@b", "b2")] == "no_transcript"
    assert found[("@a", "b3")] == found[("@b", "b3")] == "transcript_error"
    # What could not be stored is tried again, with a document and a number of its own.
    run = fetch(landing, AS_OF, store=store, embedder=embed.HashedTerms(3))
    found = outcomes(run)
    assert found[("@a", "a1")] == found[("@b", "a1")] == "store_failed" and run.documents.count() == 4


def test_scratch_of_a_run_goes_with_it(spark, landing):
    store = seed(spark)
    with scratch_run(spark) as folder:
        run = fetch(landing, AS_OF, store=store)
        store.insert_if_absent(run.points)
        assert os.listdir(folder)
    assert not os.path.exists(folder) and store.read().count() == 4


def test_failed_vector_keeps_document_and_number(spark, landing):
    store = seed(spark)
    run = fetch(landing, AS_OF, store=store, embedder=embed.HashedTerms(3))
    assert outcomes(run)[("@a", "a1")] == "store_failed"
    assert run.documents.count() == 4 and run.summary.first()["processed"] == 4
    store.insert_if_absent(run.points)
    assert store.read().count() == 1


def test_stream(spark, landing):
    store = seed(spark)
    landed, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "checkpoint")
    runs = []

    def go():
        query = incremental.start(landing, landed, store, checkpoint, AS_OF, on_run=lambda run: runs.append(run.summary.first()["processed"]))
        query.awaitTermination()
        return {r["video_id"]: r["transcript_number"] for r in store.read().collect()}

    landing.listing.where("position <= 2").write.parquet(landed)
    first = go()
    assert first == {"a0": 40, "a1": 41, "b1": 42}
    assert go() == first and len(runs) == 1
    landing.listing.write.mode("append").parquet(landed)
    assert go() == first | {"b4": 43}
    # A lost checkpoint replays everything and stores nothing twice.
    checkpoint = scratch_path(spark, "checkpoint")
    assert go() == first | {"b4": 43} and store.read().count() == 4
