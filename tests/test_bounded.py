"""The stream that remembers what it saw for a bounded time."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from talklake.functions.ids import point_id
from talklake.session import scratch_path
from talklake.sources import landing as tables
from talklake.sources.store import Store
from talklake.streaming import incremental
from tests.test_runs import AS_OF, landing, seed  # noqa: F401  (landing is a fixture)


def entries(spark, *rows):
    """Rows of (channel, position, id, day of February at noon, or None)."""
    found = spark.createDataFrame([(c, p, i, f"T {i}", "20260228") for c, p, i, _ in rows], "channel_id string, position long, id string, title string, upload_date string")
    times = spark.createDataFrame([(c, p, None if d is None else datetime(2026, 2, d, 12)) for c, p, _, d in rows], "channel_id string, position long, seen_at timestamp")
    seen = tables.conform(found, "listing").join(times, ["channel_id", "position"])
    return seen.select(*tables.TABLES["listing"].fieldNames(), "seen_at")


class Run:
    """Landings and restarts of one stream of fresh entries."""

    def __init__(self, spark):
        self.spark, self.landed, self.checkpoint = spark, scratch_path(spark, "landed"), scratch_path(spark, "check")

    def __call__(self, *rows, remember="3 days"):
        if rows:
            entries(self.spark, *rows).coalesce(1).write.mode("append").parquet(self.landed)
        found = []
        stream = tables.stream(self.spark, "listing", self.landed, more=incremental.SEEN_AT)
        query = (
            incremental.fresh(stream, remember)
            .writeStream.foreachBatch(lambda batch, _: found.extend(r["id"] for r in batch.collect()))
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return sorted(found), incremental.state_report(query)


def test_replayed_late_and_expired(spark):
    run = Run(spark)
    assert run(("@a", 1, "x", 1), ("@a", 2, "y", 1), ("@b", 1, "x", 1)) == (["x", "y"], {"state_rows": 2, "expired": 0, "late": 0})
    # The same file again, and a new video.
    assert run(("@a", 1, "x", 2), ("@a", 2, "y", 2), ("@a", 3, "z", 2)) == (["z"], {"state_rows": 3, "expired": 0, "late": 0})
    # A much later entry moves the watermark, and all that came before goes.
    assert run(("@a", 4, "w", 20)) == (["w"], {"state_rows": 1, "expired": 3, "late": 0})
    # Now x counts as new, and what is older than the watermark is late.
    assert run(("@a", 1, "x", 21), ("@a", 5, "late", 3)) == (["x"], {"state_rows": 2, "expired": 0, "late": 1})
    # Nothing landed: nothing runs.
    assert run() == ([], {"state_rows": 0, "expired": 0, "late": 0})


def test_entries_without_id_or_time_are_dropped(spark):
    found, report = Run(spark)(("@a", 1, None, 1), ("@a", 2, "", 1), ("@a", 3, "x", None), ("@a", 4, "y", 1))
    assert found == ["y"] and report["state_rows"] == 1


def test_bounded_run_fills_the_store(spark, landing):  # noqa: F811
    store = seed(spark)
    landed, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "checkpoint")
    outcomes = []

    def go():
        keep = lambda run: outcomes.extend((r["video_id"], r["status"]) for r in run.outcomes.collect())
        incremental.start(landing, landed, store, checkpoint, AS_OF, on_run=keep, remember="30 days").awaitTermination()
        return {r["video_id"]: r["transcript_number"] for r in store.read().collect()}

    seen = landing.listing.withColumn("seen_at", F.lit(datetime(2026, 2, 28, 12)).cast("timestamp"))
    seen.where("position <= 2").write.parquet(landed)
    # The stream never saw a0, which the store holds: it is worked again, and the insert keeps it out.
    first = go()
    assert set(first) == {"a0", "a1", "b1"} and first["a0"] == 40
    assert ("a0", "already_processed") not in outcomes
    outcomes.clear()
    seen.write.mode("append").parquet(landed)
    second = go()
    assert set(second) == {"a0", "a1", "b1", "b4"} and all(second[v] == first[v] for v in first)
    assert second["b4"] > max(first.values())
    assert not {"a1", "b1"} & {video for video, _ in outcomes}


@pytest.fixture
def store(spark):
    return Store.ensure(spark, scratch_path(spark, "numbers"), 2, buckets=2)


def numbered(spark, *pairs):
    rows = spark.createDataFrame(list(pairs), "video_id string, transcript_number long")
    rows = rows.withColumn("point_id", point_id(F.col("video_id"))).withColumn("embedding", F.lit([0.5, 1.0]).cast("array<float>"))
    fields = [f for f in tables.schemas.STORE if f.name not in rows.columns]
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in fields})


def test_commits_carry_the_next_number(spark, store):
    assert store.next_number() == 1
    store.insert_if_absent(numbered(spark, ("a", 7), ("b", 3)))
    assert store.next_number() == 8
    # The same again, a write of nothing and one without numbers change nothing.
    store.insert_if_absent(numbered(spark, ("a", 7), ("b", 3)))
    store.upsert(numbered(spark, ("c", None)))
    store.insert_if_absent(numbered(spark, ("c", 1)).limit(0))
    assert store.next_number() == 8
    # A point that was there already may have a document under its new number.
    store.insert_if_absent(numbered(spark, ("a", 9)))
    assert store.next_number() == 10
    # A number is not given again when its point is replaced.
    store.upsert(numbered(spark, ("a", 2)))
    assert store.next_number() == 10
    # Commits of an earlier layout: the points are asked.
    old = spark.createDataFrame([("earlier",)], "write_id string")
    old.write.mode("append").parquet(f"{store.root}/commits")
    assert store.next_number() == 10
