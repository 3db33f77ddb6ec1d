"""Landing tables: what collectors wrote about channels, videos and captions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from talklake import schemas

TABLES = {
    "channels": schemas.CHANNELS,
    "listing": schemas.LISTING,
    "details": schemas.DETAILS,
    "tracks": schemas.TRACKS,
    "segments": schemas.SEGMENTS,
}


def read(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """A landing table with its fixed schema; absent fields are NULL, others ignored."""
    return spark.read.schema(TABLES[name]).format(fmt).load(path)


def stream(spark: SparkSession, name: str, path: str, fmt: str = "parquet", more: str = "") -> DataFrame:
    """New files of a landing table as a stream; ``more`` names further fields, as DDL."""
    fields = [*TABLES[name], *(T.StructType.fromDDL(more) if more else [])]
    return spark.readStream.schema(T.StructType(fields)).format(fmt).load(path)


def conform(rows: DataFrame, name: str) -> DataFrame:
    """Bring rows to a landing table's columns; missing ones become NULL."""
    return rows.to(T.StructType([T.StructField(f.name, f.dataType, True) for f in TABLES[name]]))
