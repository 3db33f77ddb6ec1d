"""Search results as JSON rows and as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: the text form of a hit --------------------------------------------
HIT = "%d. [%.3f] %s\n   Channel: %s\n   Date: %s\n   URL: %s\n   Topics: %s"
NO_HITS = "No results found."
# -------------------------------------------------------------------------------------

FIELDS = ["video_id", "title", "channel", "published_date", "url", "topics", "score"]


def as_json(hits: DataFrame) -> DataFrame:
    """One JSON object per hit; absent values are written as null."""
    row = F.to_json(F.struct(*FIELDS), {"ignoreNullFields": "false"})
    return hits.select("query_id", "rank", row.alias("json"))


def hit_text() -> Column:
    return F.format_string(
        HIT, "rank", "score", "title", "channel", "published_date", "url", F.array_join("topics", ", ")
    )


def as_text(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """One text per hit, and a notice for queries without hits."""
    texts = hits.select("query_id", "rank", hit_text().alias("text"))
    return (
        queries.select("query_id")
        .join(texts, "query_id", "left")
        .select(
            "query_id",
            F.coalesce("rank", F.lit(0)).alias("rank"),
            F.coalesce("text", F.lit(NO_HITS)).alias("text"),
        )
    )
