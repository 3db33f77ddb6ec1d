"""The validate job: a report on the registry and the store."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from talklake.operators.registry import report
from talklake.sources.store import SETTINGS


def store_line(spark: SparkSession, root: str) -> str:
    """Whether the store can be opened; never creates it."""
    try:
        row = spark.read.schema(SETTINGS).parquet(f"{root.rstrip('/')}/settings").first()
    except AnalysisException as error:
        return f"  Store: FAILED ({error.getCondition()})"
    return f"  Store: OK ({row['vector_size']} dimensions)" if row else "  Store: FAILED (empty)"


def validate(spark: SparkSession, channels: DataFrame, store_root: str | None = None) -> DataFrame:
    """``(section, ord, line)``: registry lines, then the state of the store."""
    lines = report(channels).select(F.lit(0).alias("section"), "ord", "line")
    if store_root is None:
        return lines
    state = spark.range(1).select(
        F.lit(1).alias("section"), F.lit(0).alias("ord"), F.lit(store_line(spark, store_root)).alias("line")
    )
    return lines.unionByName(state)
