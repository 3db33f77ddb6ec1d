"""From channel listings to the videos a run will process."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from talklake.functions.ids import bucket, point_id
from talklake.functions.times import moment, parse_day
from talklake.operators.registry import SITE, enabled
from talklake.schemas import VIDEO_FIELDS

# --- fixed values --------------------------------------------------------------------
WATCH_URL = SITE + "watch?v="
UNKNOWN = "Unknown"
LOOKAHEAD = 2
# -------------------------------------------------------------------------------------


def parse_listing(listing: DataFrame, as_of: datetime) -> DataFrame:
    """Typed videos from listing entries; entries without an id are dropped.

    A missing or malformed date counts as ``as_of``.
    """
    video_id = F.col("id")
    return listing.where(video_id.isNotNull() & (video_id != "")).select(
        "channel_id",
        "position",
        video_id.alias("video_id"),
        F.coalesce("title", F.lit(UNKNOWN)).alias("title"),
        F.coalesce("channel_name", "channel_id").alias("channel"),
        F.coalesce(parse_day(F.col("upload_date")), moment(as_of)).alias("published"),
        F.coalesce("url", F.concat(F.lit(WATCH_URL), video_id)).alias("url"),
        F.coalesce("duration", F.lit(0)).cast("bigint").alias("duration_seconds"),
        F.lit("").alias("description"),
        F.array().cast("array<struct<start_time:double,end_time:double,title:string>>").alias("chapters"),
    )


def young_enough(published: Column, as_of: datetime, max_age_days: Column) -> Column:
    """Not older than the channel allows; the limit itself is still young enough."""
    return published >= moment(as_of) - F.make_dt_interval(days=max_age_days)


def recent_videos(
    listing: DataFrame, channels: DataFrame, as_of: datetime, lookahead: int | None = LOOKAHEAD
) -> DataFrame:
    """At most ``max_videos_per_run`` young videos per enabled channel, in page order.

    Only the first ``lookahead * max_videos_per_run`` positions are looked at; ``None`` looks at all. The
    largest such bound is pushed into the scan first, so however long a channel's page is, no
    more than that many rows per channel are joined or sorted.
    """
    active = enabled(channels).select(
        "ord",
        "channel_id",
        "max_age_days",
        "max_videos_per_run",
        "metadata_tags",
    )
    deep = F.col("max_videos_per_run") * lookahead if lookahead is not None else F.lit(None).cast("bigint")
    head = listing
    if lookahead is not None:
        head = listing.where(F.col("position") <= active.select(F.max(deep)).scalar())
    seen = parse_listing(head, as_of).join(active, "channel_id")
    near = F.lit(True) if lookahead is None else F.col("position") <= deep
    fresh = seen.where(near & young_enough(F.col("published"), as_of, F.col("max_age_days")))
    turn = F.row_number().over(W.partitionBy("ord").orderBy("position"))
    return (
        fresh.withColumn("turn", turn)
        .where(F.col("turn") <= F.col("max_videos_per_run"))
        .select("ord", "channel_id", "position", "video_id", *VIDEO_FIELDS, "metadata_tags")
    )


def stored_among(candidates: DataFrame, store: DataFrame) -> DataFrame:
    """The store's rows of the candidates' points, by ``bucket`` and ``point_id``.

    The store is the big side: it is filtered by the candidates, which Catalyst broadcasts when they are
    small, so the store need not be shuffled. The bucket is a folder: the comparison below marks the candidates
    as selective, so that folders without a candidate are not even listed for reading.
    """
    keys = candidates.select("bucket", "point_id").where("bucket >= 0")
    return store.join(keys, ["bucket", "point_id"], "left_semi")


def unprocessed(candidates: DataFrame, store: DataFrame) -> DataFrame:
    """Candidates with ``bucket`` and ``point_id`` that the store does not hold."""
    known = stored_among(candidates, store).select("bucket", "point_id")
    return candidates.join(known, ["bucket", "point_id"], "left_anti")


def with_point(candidates: DataFrame, buckets: int) -> DataFrame:
    """Add the point id and the bucket under which a store of this many buckets holds each candidate."""
    return candidates.withColumn("point_id", point_id(F.col("video_id"))).withColumn(
        "bucket", bucket(F.col("point_id"), buckets)
    )


def turn_in_run() -> Column:
    """Which listing of its video a candidate is, in registry and page order."""
    return F.row_number().over(W.partitionBy("video_id").orderBy("ord", "position"))


def first_in_run(candidates: DataFrame) -> DataFrame:
    """One row per video id: the first in registry and page order."""
    return candidates.withColumn("turn", turn_in_run()).where("turn = 1").drop("turn")


def dry_run(candidates: DataFrame) -> DataFrame:
    """What a run would process."""
    line = F.format_string("[DRY RUN] Would process: %s (%s)", "title", "video_id")
    return candidates.select("ord", "position", "video_id", line.alias("line"))


def recent_counts(recent: DataFrame) -> DataFrame:
    """Number of recent videos per channel."""
    return recent.groupBy("channel_id").agg(F.count("*").alias("video_count"))
