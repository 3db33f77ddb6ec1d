"""The channel registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: defaults of a registry row, and the page address -----------------
MAX_AGE_DAYS = 30
MAX_VIDEOS_PER_RUN = 5
SITE = "https://www.youtube.com/"
# -------------------------------------------------------------------------------------


def with_defaults(channels: DataFrame) -> DataFrame:
    """Fill the fields a registry row may leave out."""
    return channels.withColumns(
        {
            "enabled": F.coalesce("enabled", F.lit(True)),
            "max_age_days": F.coalesce("max_age_days", F.lit(MAX_AGE_DAYS)),
            "max_videos_per_run": F.coalesce("max_videos_per_run", F.lit(MAX_VIDEOS_PER_RUN)),
            "metadata_tags": F.coalesce("metadata_tags", F.array().cast("array<string>")),
        }
    )


def enabled(channels: DataFrame) -> DataFrame:
    return with_defaults(channels).where("enabled")


def listing_url(channel_id: Column) -> Column:
    """Page of a channel: ids go under ``channel/``, handles and the rest directly."""
    folder = F.when(channel_id.startswith("UC"), F.lit("channel/")).otherwise(F.lit(""))
    return F.concat(F.lit(SITE), folder, channel_id, F.lit("/videos"))


def report(channels: DataFrame) -> DataFrame:
    """Validation report: the number of channels, then one line per channel, by ``ord``."""
    rows = with_defaults(channels)
    head = rows.agg(
        F.lit(-1).alias("ord"),
        F.format_string("  Channels: %d configured", F.count("*")).alias("line"),
    )
    state = F.when(F.col("enabled"), "enabled").otherwise("disabled")
    lines = rows.select(
        "ord", F.format_string("    - %s (%s) [%s]", "name", "channel_id", state).alias("line")
    )
    return head.unionByName(lines)
