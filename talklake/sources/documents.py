"""Rendered documents as tables and as text files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F

from talklake.functions.markdown import FILE_PREFIX
from talklake.session import staged

OPEN_COST_KEY = "spark.sql.files.openCostInBytes"
#: What opening a file counts for when small files are dealt to tasks: at Spark's 4 MB a task gets 32 of them.
OPEN_COST = 64 << 10


def write_table(docs: DataFrame, path: str) -> None:
    """Documents as a table with one folder per batch; a batch written again is replaced."""
    writer = docs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch_id").parquet(path)


def write_plain(docs: DataFrame, root: str) -> int:
    """One file ``<root>/<filename>`` per document, and the number of files written.

    ``root`` is a folder or URI that all executors share. A repeated task writes the
    same bytes to the same names, so a lost executor does no harm.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, folder = fs.FileSystem.from_uri(root)
        target.create_dir(folder, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with target.open_output_stream(f"{folder}/{name}") as out:
                    out.write(content.encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["files"])

    written = docs.select("filename", "content").mapInArrow(write, "files long")
    return written.agg(F.sum("files")).first()[0] or 0


def read_plain(spark: SparkSession, path: str, prefix: str = FILE_PREFIX) -> DataFrame:
    """``(filename, content)`` of plain ``<prefix>-*.md`` files in a folder; none gives no rows."""
    return contents(spark.read.option("pathGlobFilter", f"{prefix}-*.md"), path)


def contents(reader: DataFrameReader, path: str, *more: Column) -> DataFrame:
    """``more``, ``filename`` and ``content`` of whole files, without empty ones.

    Spark's reader of whole texts makes a Hadoop configuration for every file, which takes longer than the file; the one
    of binary files does not.
    """
    rows = reader.format("binaryFile").load(path).where("length > 0")
    return rows.select(*more, F.col("_metadata.file_name").alias("filename"), F.col("content").cast("string").alias("content"))


def gathered(files: DataFrame) -> DataFrame:
    """Rows of many small files, as a table: each file is opened once, some thousands by one task."""
    conf = files.sparkSession.conf
    before = conf.get(OPEN_COST_KEY)
    conf.set(OPEN_COST_KEY, str(OPEN_COST))
    try:
        return staged(files, "gathered")
    finally:
        conf.set(OPEN_COST_KEY, before)


def by_name(docs: DataFrame) -> DataFrame:
    """Files in order of their names. A sort reads its rows twice, once for the ranges, so they are gathered before."""
    return gathered(docs).orderBy("filename")
