"""Helpers shared by the operators of this part."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from talklake.session import scratch_path

#: Bytes of text that a worker looks at in one go; a longer text is taken alone.
SLICE_BYTES = 1 << 18
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back; its shuffle files go at once.

    A lost executor costs only the rereading. Shuffle files of a finished write are of no
    further use, so their removal is switched on for this write only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_KEY)
        else:
            spark.conf.set(CLEANUP_KEY, before)
    return spark.read.schema(df.schema).parquet(path)


def slices(sizes: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows whose sizes add up to ``limit`` at most, or one larger row."""
    start, n = 0, len(sizes)
    ends = np.cumsum(sizes)
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start = stop


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and their ``n + 1`` offsets; null is empty."""
    filled = texts.cast(pa.large_string()).fill_null("") if texts.null_count else texts.cast(pa.large_string())
    offsets = np.frombuffer(filled.buffers()[1], dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_sizes(texts: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text; null has none."""
    return np.diff(text_buffer(texts)[1])


def by_slices(
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None], text: str = "text", limit: int = SLICE_BYTES, state: str = ""
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that gives ``work`` slices of bounded text size.

    A reused worker first drops what other operators keep in it; ``state`` is how the names of this one's begin.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only(state)
        for batch in batches:
            if not batch.num_rows:
                continue
            for start, stop in slices(text_sizes(batch.column(text)), limit):
                if (out := work(batch.slice(start, stop - start))) is not None:
                    yield out
        trim()

    return run


def _kept() -> dict[str, dict]:
    holder = sys.modules.setdefault("_talklake_worker_state", types.ModuleType("_talklake_worker_state"))
    return holder.__dict__.setdefault("kept", {})


def worker_state(name: str) -> dict:
    """A dictionary of this Python worker that outlives a task, for what is dear to build again."""
    return _kept().setdefault(name, {})


def keep_only(start: str) -> None:
    """Drop what this worker keeps under names that begin otherwise; ``""`` keeps nothing."""
    kept = _kept()
    if gone := [n for n in kept if not (start and n.startswith(start))]:
        for name in gone:
            del kept[name]
        gc.collect()
        trim()


def trim() -> None:
    """Give memory that is free in this Python worker back to the system, where that can be asked for."""
    pa.default_memory_pool().release_unused()
    if malloc_trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        malloc_trim(0)


def ragged_take(offsets: np.ndarray, values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``rows`` of ``values`` cut at ``offsets``, one after the other, and their own offsets."""
    sizes = offsets[rows + 1] - offsets[rows]
    ends = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    places = np.arange(ends[-1]) + np.repeat(offsets[rows] - ends[:-1], sizes)
    return ends, values[places]


def extended(schema: StructType, more: str) -> StructType:
    """``schema`` with further fields, given as DDL."""
    return StructType([*schema.fields, *StructType.fromDDL(more).fields])


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns of these names, which Spark compares without regard to case."""
    gone = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in gone))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def inner_names(df: DataFrame, keep: dict[str, str]) -> DataFrame:
    """Only the wanted columns, under the operator's own names, so that other columns cannot clash."""
    return df.select(*(F.col(f"`{own}`").alias(name) for name, own in keep.items()))
