"""A stream that numbers the videos it has not seen, with all that it must remember in the state store.

``transformWithStateInPandas`` keeps, per channel and lane, which ids were seen when, and how many were numbered. No
run reads the store or looks for candidates in it, and a restart goes on where the last run ended. A lane is a share of a
channel's ids by hash: a channel with a third of all entries is worked in as many tasks as there are lanes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from talklake.functions.ids import bucket, point_id

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LANES = 64
OUT = "channel_id string, video_id string, seen_at timestamp, number bigint"


def _processor(lanes: int, span_ms: int):
    """The stateful processor; made here so that workers get it by value and need not import this package."""
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Numbers(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.seen = handle.getMapState("seen", "video_id string", "seen_ms bigint")
            self.used = handle.getValueState("used", "n bigint")
            self.timer = handle.getValueState("timer", "due_ms bigint")

        def handleInputRows(self, key, rows: Iterator, timerValues):
            passed = timerValues.getCurrentWatermarkInMs()
            new = {}
            for some in rows:
                for video, seen_ms, position in zip(some["video_id"], some["seen_ms"], some["position"]):
                    this = (int(seen_ms), int(position), video)
                    if video in new:
                        new[video] = min(new[video], this)
                    elif not self.remembered(video, passed):
                        new[video] = this
            if not new:
                return
            used = self.used.get()[0] if self.used.exists() else 0
            ordered = sorted(new.values())
            for seen_ms, _, video in ordered:
                self.seen.updateValue((video,), (seen_ms,))
            self.used.update((used + len(ordered),))
            self.wake(ordered[0][0] + span_ms)
            channel, lane = key
            yield pd.DataFrame(
                {
                    "channel_id": [channel] * len(ordered),
                    "video_id": [video for _, _, video in ordered],
                    "seen_at": pd.to_datetime([seen_ms for seen_ms, _, _ in ordered], unit="ms"),
                    "number": [(used + n) * lanes + lane + 1 for n in range(len(ordered))],
                }
            )

        def remembered(self, video, passed):
            return self.seen.containsKey((video,)) and self.seen.getValue((video,))[0] + span_ms > passed

        def wake(self, due):
            """One timer per lane, for the id that expires first."""
            if self.timer.exists():
                before = self.timer.get()[0]
                if before <= due:
                    return
                self.handle.deleteTimer(before)
            self.handle.registerTimer(due)
            self.timer.update((due,))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            passed = timerValues.getCurrentWatermarkInMs()
            self.timer.clear()
            gone, least = [], None
            for (video,), (seen_ms,) in self.seen.iterator():
                due = seen_ms + span_ms
                if due <= passed:
                    gone.append(video)
                elif least is None or due < least:
                    least = due
            for video in gone:
                self.seen.removeKey((video,))
            if least is not None:
                self.wake(least)
            return iter(())

        def close(self):
            pass

    return Numbers()


def fresh_numbered(listing: DataFrame, remember_days: int, lanes: int = LANES) -> DataFrame:
    """``channel_id``, ``video_id``, ``seen_at`` and ``number`` of the entries whose video is new to its channel.

    An entry is new unless its video was seen within ``remember_days`` of event time before the watermark, which is
    ``remember_days`` behind the latest entry; what is older than the watermark is late and dropped. Then the video is
    forgotten, and a later entry counts as new and gets a further number. Within a run, of several entries of one
    video the first by time and position counts; time is taken in whole milliseconds.

    Numbers are positive, unique in a channel and never given twice: those of a lane are ``lane + 1``, ``lane + 1 + lanes``
    and so on, by run, time, position and id. With one lane they have no gaps. A stream must keep its number of lanes.
    Entries without channel, id or time are dropped; one without position comes first. State grows with the ids seen within
    the span, and by one count per lane.
    """
    named = F.col("channel_id").isNotNull() & F.col("id").isNotNull() & (F.col("id") != "") & F.col("seen_at").isNotNull()
    rows = listing.where(named).withWatermark("seen_at", f"{remember_days} days").select(
        "channel_id",
        bucket(point_id(F.col("id")), lanes).cast("int").alias("lane"),
        F.col("id").alias("video_id"),
        "seen_at",
        F.unix_millis("seen_at").alias("seen_ms"),
        F.coalesce("position", F.lit(-1)).cast("bigint").alias("position"),
    )
    return rows.groupBy("channel_id", "lane").transformWithStateInPandas(
        statefulProcessor=_processor(lanes, remember_days * 86_400_000), outputStructType=OUT, outputMode="Append", timeMode="EventTime"
    )


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Start such a stream inside: its state needs the RocksDB provider. Other streams keep theirs."""
    before = spark.conf.get(PROVIDER_KEY, None)
    spark.conf.set(PROVIDER_KEY, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_KEY)
        else:
            spark.conf.set(PROVIDER_KEY, before)
