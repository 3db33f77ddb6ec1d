"""The fetch job as a stream over newly landed listings.

``availableNow`` processes what has landed since the last run and stops, so a scheduler
may start it every few hours; the checkpoint keeps what was read, the store keeps what
was processed. The age rule is by processing time (``as_of``) and does not move with the
data, so it is no watermark.

What was seen is asked of the store, or kept by the stream itself (``remember``): then the state store holds
one row per video until the watermark has passed the video's time by that span, and no run looks for
candidates in the store. State is keyed by video and therefore even; for very many videos, let
``spark.sql.streaming.stateStore.providerClass`` name the RocksDB provider.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from talklake.plans.fetch import Landing, Run, fetch
from talklake.session import scratch_run
from talklake.sources import landing as tables
from talklake.sources.store import Store

#: When a collector saw an entry.
SEEN_AT = "seen_at timestamp"


def fresh(listing: DataFrame, remember: str, seen_at: str = "seen_at", key: str = "id") -> DataFrame:
    """The entries of a stream whose video was not seen within ``remember`` before.

    A repeat within that span of the first listing is always dropped; a later one is dropped until the watermark
    has expired the first. Afterwards the video counts as new, so ``remember`` should be the largest age that any
    channel allows: what comes back later is then too old by the age rule. An entry older than the watermark is late
    and dropped. Entries without an id, which are no videos, or without a time are dropped, too.
    """
    named = F.col(key).isNotNull() & (F.col(key) != "") & F.col(seen_at).isNotNull()
    return listing.where(named).withWatermark(seen_at, remember).dropDuplicatesWithinWatermark([key])


def state_report(query: StreamingQuery) -> dict[str, int]:
    """Rows that a finished run left in the state, and how many it expired and dropped as late."""
    operators = [op for progress in query.recentProgress for op in progress.stateOperators]
    return {
        "state_rows": operators[-1].numRowsTotal if operators else 0,
        "expired": sum(op.numRowsRemoved for op in operators),
        "late": sum(op.numRowsDroppedByWatermark for op in operators),
    }


def start(
    landing: Landing,
    listing_path: str,
    store: Store,
    checkpoint: str,
    as_of: datetime,
    on_run: Callable[[Run], None] | None = None,
    remember: str | None = None,
    **options,
) -> StreamingQuery:
    """Process newly landed listing files and insert the new videos into the store.

    A replayed batch is harmless: videos it stored before are skipped by id, and the
    insert itself checks again. ``on_run`` may write documents and outcomes; it must
    be repeatable too. With ``remember``, landed rows carry ``seen_at`` and only ``fresh`` ones are processed:
    a channel's limit then counts those alone, and the store is asked at the insert only.
    """

    def one_run(listing: DataFrame, epoch: int) -> None:
        with scratch_run(store.spark):
            run = fetch(
                replace(landing, listing=listing),
                as_of,
                store=store,
                number_start=store.next_number(),
                skip_stored=remember is None,
                **options,
            )
            if on_run:
                on_run(run)
            store.insert_if_absent(run.points)

    if remember is None:
        rows = tables.stream(store.spark, "listing", listing_path)
    else:
        rows = fresh(tables.stream(store.spark, "listing", listing_path, more=SEEN_AT), remember).drop("seen_at")
    return (
        rows.writeStream.foreachBatch(one_run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
