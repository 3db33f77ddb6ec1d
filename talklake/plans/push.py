"""The push job: the manifest of files written earlier."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from talklake.operators.documents import manifest


def push(files: DataFrame, batch_id: str) -> DataFrame:
    """Manifest of ``(filename, content)`` rows: every file by name, numbered or not."""
    return manifest(files.select(F.lit(batch_id).alias("batch_id"), "filename"))
