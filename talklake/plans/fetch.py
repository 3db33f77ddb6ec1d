"""The fetch job: from listings to documents and store points."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, Observation, functions as F

from talklake.functions import chapters, markdown
from talklake.functions.times import batch_name
from talklake.operators import candidates as cand
from talklake.operators import documents as docs
from talklake.operators import enrich, keywords, outcomes as out, segments as seg
from talklake.operators.embed import HashedTerms, embed
from talklake.operators.registry import enabled
from talklake.session import staged
from talklake.sources.store import Store, points


@dataclass(frozen=True)
class Landing:
    """The landing tables of a run. The last two are optional lists of failures."""

    channels: DataFrame
    listing: DataFrame
    details: DataFrame
    tracks: DataFrame
    segments: DataFrame
    failed_channels: DataFrame | None = None
    failed_texts: DataFrame | None = None


@dataclass(frozen=True)
class Run:
    """What a run found. Numbers, documents and points are worked out when they are first asked for."""

    batch_id: str
    as_of: datetime
    candidates: DataFrame
    outcomes: DataFrame
    #: Videos that get a document, with text, topics, chapters and vector, not yet numbered.
    done: DataFrame
    #: Landed segments that belong to no place in a video and are in no text.
    unplaced: DataFrame
    #: Channels that could not be read; few.
    broken: DataFrame | None
    #: What was counted while the candidates, and then their texts, were written.
    observed: tuple[Observation, Observation]
    number_start: int = 1
    prefix: str = markdown.FILE_PREFIX
    generator: str = markdown.GENERATOR

    @cached_property
    def videos(self) -> DataFrame:
        # Only the places are numbered; texts are not read for it.
        place = ["ord", "position"]
        return self.done.join(staged(docs.numbered(self.done.select(*place), self.number_start), "numbers"), place)

    @property
    def documents(self) -> DataFrame:
        return docs.rendered(self.videos, self.as_of, self.batch_id, self.prefix, self.generator)

    @property
    def points(self) -> DataFrame:
        return points(self.videos, self.as_of, self.batch_id)

    @property
    def summary(self) -> DataFrame:
        return out.run_summary(self.outcomes)

    @cached_property
    def counts(self) -> dict[str, int]:
        """Outcomes by status, counted by the writes of the run themselves; no table is read again for it."""
        found, worked = (watch.get for watch in self.observed)
        total = {name: worked[name] or 0 for name in out.STATUSES}
        total[out.ALREADY_PROCESSED] += found["stored"] or 0
        total[out.CHANNEL_FAILED] += 0 if self.broken is None else self.broken.count()
        return total

    @property
    def manifest(self) -> DataFrame:
        return docs.manifest(self.documents)


def find_candidates(
    landing: Landing,
    as_of: datetime,
    store: Store | None = None,
    lookahead: int | None = cand.LOOKAHEAD,
    watch: Observation | None = None,
) -> DataFrame:
    """The run's recent videos with ``stored`` and ``turn``, which listing of its video each is; written once.

    They are few and filter every landing table, so their true size is worth knowing. ``watch`` counts the stored.
    """
    watch = watch or Observation()
    seen = F.count_if("stored").alias("stored")
    recent = cand.recent_videos(landing.listing, landing.channels, as_of, lookahead)
    if landing.failed_channels is not None:
        recent = recent.join(landing.failed_channels, "channel_id", "left_anti")
    recent = recent.withColumn("turn", cand.turn_in_run())
    if store is None:
        return staged(recent.withColumn("stored", F.lit(False)).observe(watch, seen), "recent")
    placed = cand.with_point(recent, store.buckets)
    known = cand.stored_among(placed, store.read()).select("bucket", "point_id", F.lit(True).alias("stored"))
    marked = placed.join(known, ["bucket", "point_id"], "left").withColumn("stored", F.coalesce("stored", F.lit(False)))
    return staged(marked.drop("bucket", "point_id").observe(watch, seen), "recent")


def complete(
    todo: DataFrame, landing: Landing, as_of: datetime, languages: Sequence[str] = seg.LANGUAGES
) -> DataFrame:
    """Details and clean text for the candidates; landing rows of other videos are not touched."""
    track = seg.best_track(enrich.only_for(landing.tracks, todo), languages)
    texts = seg.transcripts(seg.chosen_segments(enrich.only_for(landing.segments, todo), track))
    detail = enrich.only_for(landing.details, todo)
    videos = enrich.with_details(todo, detail, as_of).join(texts, "video_id", "left")
    if landing.failed_texts is None:
        return videos.withColumn("text_error", F.lit(False))
    failed = landing.failed_texts.select("video_id", F.lit(True).alias("text_error")).distinct()
    return videos.join(failed, "video_id", "left").withColumn(
        "text_error", F.coalesce("text_error", F.lit(False))
    )


def fetch(
    landing: Landing,
    as_of: datetime,
    *,
    store: Store | None = None,
    embedder=None,
    languages: Sequence[str] = seg.LANGUAGES,
    batch_id: str | None = None,
    number_start: int = 1,
    prefix: str = markdown.FILE_PREFIX,
    generator: str = markdown.GENERATOR,
    once_per_run: bool | None = None,
    lookahead: int | None = cand.LOOKAHEAD,
    skip_stored: bool = True,
) -> Run:
    """Process the recent videos that are not stored yet. Writes only scratch tables.

    Save the result with ``sources.documents`` and ``store.insert_if_absent(run.points)``.

    ``once_per_run`` skips a further listing of a video that the run has processed; by default that is so when a
    store is given, as it then holds the video. A further listing of a video that came to nothing, or
    that could not be stored, has the same outcome again. Without ``skip_stored`` the store's ids are not read:
    the caller knows that the listing brings nothing that is stored.
    """
    batch = batch_id or batch_name(as_of)
    embedder = embedder or HashedTerms(store.vector_size if store else 384)
    once = store is not None if once_per_run is None else once_per_run
    watch_found, watch_worked = Observation(), Observation()
    recent = find_candidates(landing, as_of, store if skip_stored else None, lookahead, watch_found)
    todo = recent.where(~F.col("stored")).drop("stored")

    has_text = ~F.col("text_error") & (F.length("transcript") > 0)
    text = F.when(has_text, F.col("transcript"))
    completed = embed(complete(todo, landing, as_of, languages).withColumn("_text", text), embedder, "_text")
    size = F.coalesce(F.size("embedding"), F.lit(-1))
    missing = F.lit(False) if store is None else size != store.vector_size
    status = out.status(
        channel_failed=F.lit(False),
        stored=F.lit(False),
        text_error=F.col("text_error"),
        text=F.col("transcript"),
        vector_missing=missing,
    )
    judged = completed.withColumns(
        {
            "topics": keywords.topic_names(F.col("_text")),
            "chapter_marks": F.when(has_text, chapters.pick(F.col("chapters"), F.col("description"))),
            "status": status,
        }
    )
    again = (F.col("turn") > 1) & (F.col("status") == out.PROCESSED) & F.lit(once)
    status = F.when(again, out.ALREADY_PROCESSED).otherwise(F.col("status"))
    # Texts, vectors and outcomes of all candidates, written once; everything else is a projection of it.
    written = judged.withColumn("status", status).drop("_text", "text_error", "turn")
    worked = staged(written.observe(watch_worked, *out.counts(F.col("status"))), "worked")
    done = worked.where(out.has_document(F.col("status"))).drop("status")

    key = ["channel_id", "position", "video_id"]
    skipped = recent.where("stored").select(*key, F.lit(out.ALREADY_PROCESSED).alias("status"))
    results = worked.select(*key, "status").unionByName(skipped)
    broken = None
    if landing.failed_channels is not None:
        broken = enabled(landing.channels).join(landing.failed_channels, "channel_id", "left_semi")
        results = results.unionByName(
            broken.select("channel_id", F.lit(out.CHANNEL_FAILED).alias("status")),
            allowMissingColumns=True,
        )
    return Run(
        batch_id=batch,
        as_of=as_of,
        candidates=todo.drop("turn"),
        outcomes=results.select(F.lit(batch).alias("batch_id"), *key, "status"),
        done=done,
        unplaced=seg.unplaced(landing.segments),
        broken=broken,
        observed=(watch_found, watch_worked),
        number_start=number_start,
        prefix=prefix,
        generator=generator,
    )
