"""Joins that complete a candidate video."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from talklake.functions.times import moment, parse_day
from talklake.operators.candidates import UNKNOWN, WATCH_URL
from talklake.operators.registry import with_defaults
from talklake.schemas import VIDEO_FIELDS


def parse_details(details: DataFrame, as_of: datetime) -> DataFrame:
    """Typed videos from detail records, with defaults for absent fields."""
    return details.select(
        "video_id",
        F.coalesce("title", F.lit(UNKNOWN)).alias("title"),
        F.coalesce("channel", F.lit(UNKNOWN)).alias("channel"),
        F.coalesce(parse_day(F.col("upload_date")), moment(as_of)).alias("published"),
        F.coalesce("webpage_url", F.concat(F.lit(WATCH_URL), "video_id")).alias("url"),
        F.coalesce("duration", F.lit(0)).cast("bigint").alias("duration_seconds"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce(
            "chapters",
            F.array().cast("array<struct<start_time:double,end_time:double,title:string>>"),
        ).alias("chapters"),
    )


def only_for(table: DataFrame, candidates: DataFrame) -> DataFrame:
    """The rows of a landing table that belong to the candidates."""
    return table.join(candidates.select("video_id"), "video_id", "left_semi")


def with_details(candidates: DataFrame, details: DataFrame, as_of: datetime) -> DataFrame:
    """Replace the listing's fields by the detail record's, all or none per video.

    For few candidates and many details, pass ``only_for(details, candidates)``.
    """
    record = F.struct(*VIDEO_FIELDS)
    found = parse_details(details, as_of).select(
        "video_id", record.alias("detail")
    )
    rest = [c for c in candidates.columns if c not in VIDEO_FIELDS]
    return (
        candidates.select(*rest, record.alias("listed"))
        .join(found, "video_id", "left")
        .select(*rest, F.coalesce("detail", "listed").alias("video"))
        .select(*rest, "video.*")
    )


def with_text(videos: DataFrame, texts: DataFrame) -> DataFrame:
    """Videos that have a transcript with text."""
    return videos.join(texts.where(F.length("transcript") > 0), "video_id")


def with_tags(videos: DataFrame, channels: DataFrame) -> DataFrame:
    """Attach the tags of each video's channel; Catalyst broadcasts a small registry."""
    tags = with_defaults(channels).select("channel_id", "metadata_tags")
    return videos.join(tags, "channel_id")
