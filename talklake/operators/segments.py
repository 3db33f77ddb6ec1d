"""Caption tracks and their segments.

A video's segments are handled in blocks of consecutive ``seq``: sorting and comparing
neighbours happen per block, and only each block's last text crosses to the next. One
very long video is therefore spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from talklake.functions.text import clean_segment, squeeze

BLOCK = 2048
LANGUAGES = ("en",)


def best_track(tracks: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """One track per video: manual before generated, then by language preference.

    A minimum instead of a sorted window, so it is combined before the shuffle.
    """
    order = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang"))
    choice = F.min(F.struct("is_generated", order.alias("preference"), "track_id"))
    return (
        tracks.where(F.col("lang").isin(list(languages)))
        .groupBy("video_id")
        .agg(choice.alias("best"))
        .select("video_id", "best.track_id", "best.is_generated")
    )


def chosen_segments(segments: DataFrame, tracks: DataFrame) -> DataFrame:
    """The segments of the chosen tracks."""
    return segments.join(tracks.select("video_id", "track_id"), ["video_id", "track_id"], "left_semi")


def unplaced(segments: DataFrame) -> DataFrame:
    """Segments without a video or a place in it. No text can hold them; they are for the run's report."""
    return segments.where("video_id is null or seq is null")


def _kept(segments: DataFrame, block: int) -> DataFrame:
    """``(video_id, block, seq, text)`` of the segments that stay.

    Blank segments are NULL until the neighbours are known, so they do not break a run.
    The texts are shuffled once, by video and block; the blocks' last texts, the only rows
    that meet per video, are taken from that same shuffle and joined back to it.
    """
    text = F.nullif(clean_segment(F.coalesce("text", F.lit(""))), F.lit(""))
    keyed = segments.select(
        "video_id", F.floor(F.col("seq") / block).alias("block"), "seq", text.alias("text")
    ).where("video_id is not null and block is not null")
    in_block = "(partition by video_id, block order by seq)"
    marked = keyed.withColumns(
        {
            "prev": F.expr(f"lag(text, 1) ignore nulls over {in_block}"),
            "next": F.expr(f"lead(text, 1) ignore nulls over {in_block}"),
        }
    ).where("text is not null")
    edges = marked.where("next is null").select("video_id", "block", F.col("text").alias("last"))
    earlier = F.lag("last").over(W.partitionBy("video_id").orderBy("block"))
    before = edges.select("video_id", "block", earlier.alias("before"))
    previous = F.coalesce("prev", "before")
    return (
        marked.join(before, ["video_id", "block"])
        .where(previous.isNull() | (F.col("text") != previous))
        .select("video_id", "block", "seq", "text")
    )


def clean_segments(segments: DataFrame, block: int = BLOCK) -> DataFrame:
    """Cleaned segments without blanks and without consecutive repeats, one row each."""
    return _kept(segments, block).drop("block")


def transcripts(segments: DataFrame, block: int = BLOCK) -> DataFrame:
    """One clean text per video that has text, joined block by block.

    Blocks are already together after cleaning; only their joined texts are shuffled
    again, to become one value per video.
    """
    lines = F.sort_array(F.collect_list(F.struct("seq", "text")))
    joined = F.array_join(F.transform(lines, lambda x: x["text"]), " ")
    parts = _kept(segments, block).groupBy("video_id", "block").agg(squeeze(joined).alias("text"))
    ordered = F.sort_array(F.collect_list(F.struct("block", "text")))
    return parts.groupBy("video_id").agg(
        F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias("transcript")
    )
