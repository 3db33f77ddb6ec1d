"""What became of each candidate, and the summary of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CHANNEL_FAILED = "channel_failed"
ALREADY_PROCESSED = "already_processed"
TRANSCRIPT_ERROR = "transcript_error"
NO_TRANSCRIPT = "no_transcript"
STORE_FAILED = "store_failed"
PROCESSED = "processed"
STATUSES = (CHANNEL_FAILED, ALREADY_PROCESSED, TRANSCRIPT_ERROR, NO_TRANSCRIPT, STORE_FAILED, PROCESSED)


def status(
    *, channel_failed: Column, stored: Column, text_error: Column, text: Column, vector_missing: Column
) -> Column:
    """The first thing that stopped a candidate, or ``processed``.

    A video whose vector could not be stored still has its document and its number.
    """
    return (
        F.when(channel_failed, CHANNEL_FAILED)
        .when(stored, ALREADY_PROCESSED)
        .when(text_error, TRANSCRIPT_ERROR)
        .when(F.coalesce(F.length(text), F.lit(0)) == 0, NO_TRANSCRIPT)
        .when(vector_missing, STORE_FAILED)
        .otherwise(PROCESSED)
    )


def has_document(status_col: Column) -> Column:
    return status_col.isin(PROCESSED, STORE_FAILED)


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Number of documents per batch."""
    done = F.count(F.when(has_document(F.col("status")), True))
    return outcomes.groupBy("batch_id").agg(done.alias("processed"), F.count("*").alias("candidates"))


def counts(status_col: Column) -> list[Column]:
    """Number of rows of each status, as metrics to observe while they are written."""
    return [F.count_if(status_col == name).alias(name) for name in STATUSES]
