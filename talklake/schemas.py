"""Row types of the landing tables and of the store."""

from __future__ import annotations

from pyspark.sql import types as T

NATIVE_CHAPTERS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start_time", T.DoubleType()),
            T.StructField("end_time", T.DoubleType()),
            T.StructField("title", T.StringType()),
        ]
    )
)

CHANNELS = T.StructType(
    [
        T.StructField("ord", T.IntegerType()),
        T.StructField("channel_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("enabled", T.BooleanType()),
        T.StructField("max_age_days", T.IntegerType()),
        T.StructField("max_videos_per_run", T.IntegerType()),
        T.StructField("metadata_tags", T.ArrayType(T.StringType())),
    ]
)

# One row per entry of a channel page. `position` counts from 1 and is unique in a
# channel; entries without an id keep their position.
LISTING = T.StructType(
    [
        T.StructField("channel_id", T.StringType()),
        T.StructField("channel_name", T.StringType()),
        T.StructField("position", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("duration", T.LongType()),
        T.StructField("upload_date", T.StringType()),
    ]
)

DETAILS = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("upload_date", T.StringType()),
        T.StructField("webpage_url", T.StringType()),
        T.StructField("duration", T.LongType()),
        T.StructField("description", T.StringType()),
        T.StructField("chapters", NATIVE_CHAPTERS),
    ]
)

TRACKS = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("track_id", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("is_generated", T.BooleanType()),
    ]
)

SEGMENTS = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("track_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("start", T.DoubleType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("text", T.StringType()),
    ]
)

# The columns a video has from the listing or from its detail record.
VIDEO_FIELDS = [
    "title",
    "channel",
    "published",
    "url",
    "duration_seconds",
    "description",
    "chapters",
]

STORE = T.StructType(
    [
        T.StructField("point_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("video_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("published_date", T.TimestampNTZType()),
        T.StructField("url", T.StringType()),
        T.StructField("duration_seconds", T.LongType()),
        T.StructField("transcript_text", T.StringType()),
        T.StructField("topics", T.ArrayType(T.StringType())),
        T.StructField("metadata_tags", T.ArrayType(T.StringType())),
        T.StructField("transcript_number", T.LongType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("indexed_at", T.TimestampNTZType()),
        T.StructField("write_id", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)
