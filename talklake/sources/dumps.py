"""Listing dumps as collectors leave them: one folder per run, in it one per channel, with a JSON object per line.

    <root>/<run>/channel_id=<channel>/<any name>.json
    <root>/<run>/_SUCCESS

A Python data source reads them as a table or as a stream. A line that is no entry becomes a row with the line in ``bad``
and no fields, so that its channel can be reported instead of failing the job. A file is read in pieces of ``split_bytes``,
so a channel with most of the entries is read by many tasks.

Comparisons of channel, position and date can be given at reading: folders of other channels are not opened, and
entries that do not match never leave the Python worker. They are not taken from the plan by ``pushFilters``: Spark 4.1
keeps what one query pushed with the loaded source, so that a second query over the same DataFrame, or the other side of a
union, would lose rows. Other filters are Spark's.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

FORMAT = "talklake_dump"
SCHEMA = "channel_id string, channel_name string, position bigint, id string, title string, url string, duration bigint, upload_date string, bad string"
SPLIT_BYTES = 32 << 20
#: What can be asked of an entry at reading.
COMPARED = ("channel_id", "position", "upload_date")
COMPARISONS = ("=", "<", "<=", ">", ">=", "in")


def _source() -> type:
    """The data source's class; made here so that workers get it by value and need not import this package."""
    import operator
    from dataclasses import dataclass
    from urllib.parse import unquote

    import pyarrow as pa
    from pyarrow import fs
    from pyspark.sql import datasource as ds

    texts, numbers = ("channel_name", "id", "title", "url", "upload_date"), ("position", "duration")
    schema = pa.schema(
        [(n, pa.int64() if n in numbers else pa.string()) for n in (f.split()[0] for f in SCHEMA.split(", "))]
    )
    compare = {
        "=": operator.eq,
        "<": operator.lt,
        "<=": operator.le,
        ">": operator.gt,
        ">=": operator.ge,
        "in": lambda have, wanted: have in wanted,
    }

    @dataclass
    class Piece(ds.InputPartition):
        path: str
        channel: str | None
        start: int
        stop: int

    class Files:
        """What the table and the stream have in common."""

        def __init__(self, options):
            self.root, self.split = options["root"], int(options["split_bytes"])
            self.tests = [(name, compare[how], value) for name, how, value in json.loads(options["bounds"])]

        def place(self):
            return fs.FileSystem.from_uri(self.root)

        def listed(self, folder, **how):
            target, root = self.place()
            return target.get_file_info(fs.FileSelector(f"{root.rstrip('/')}{folder}", allow_not_found=True, **how))

        def runs(self):
            """The finished runs in order, up to the first that is not finished."""
            found = []
            for run in sorted(f.base_name for f in self.listed("") if f.type == fs.FileType.Directory):
                if run[0] in "_.":
                    continue
                if not any(f.base_name == "_SUCCESS" for f in self.listed(f"/{run}")):
                    break
                found.append(run)
            return found

        def channels(self, run):
            for folder in self.listed(f"/{run}"):
                if folder.type != fs.FileType.Directory or not folder.base_name.startswith("channel_id="):
                    continue
                name = folder.base_name.removeprefix("channel_id=")
                channel = None if name == "__HIVE_DEFAULT_PARTITION__" else unquote(name)
                if self.passes({"channel_id": channel}, ("channel_id",)):
                    yield f"/{run}/{folder.base_name}", channel

        def pieces(self, runs):
            return [
                Piece(file.path, channel, start, min(start + self.split, file.size))
                for run in runs
                for folder, channel in self.channels(run)
                for file in sorted(self.listed(folder), key=lambda f: f.path)
                if file.type == fs.FileType.File and file.base_name[0] not in "_."
                for start in range(0, file.size, self.split)
            ]

        def passes(self, entry, columns=COMPARED):
            return all(
                entry.get(name) is not None and test(entry[name], value) for name, test, value in self.tests if name in columns
            )

        def lines(self, piece):
            """The lines that begin in the piece; its first one may be the end of a line of the piece before."""
            target, _ = self.place()
            with target.open_input_file(piece.path) as file:
                at = max(piece.start - 1, 0)
                file.seek(at)
                rest, skip = b"", piece.start > 0
                while at < piece.stop:
                    chunk = file.read(1 << 20)
                    rest += chunk
                    *whole, rest = rest.split(b"\n")
                    if not chunk:
                        whole, rest = [*whole, rest], b""
                    for line in whole:
                        if at >= piece.stop:
                            return
                        if not skip:
                            yield line
                        skip = False
                        at += len(line) + 1

        def entry(self, line, channel):
            try:
                found = json.loads(line)
                wrong = not isinstance(found, dict)
                wrong = wrong or any(not isinstance(found.get(n), str | None) for n in texts)
                # Half a surrogate pair is no text.
                wrong = wrong or not all(isinstance((found.get(n) or "").encode(), bytes) for n in texts)
                wrong = wrong or any(isinstance(found.get(n), bool) or not isinstance(found.get(n), int | None) for n in numbers)
                wrong = wrong or any(abs(found.get(n) or 0) >= 1 << 63 for n in numbers)
            except (ValueError, RecursionError):
                wrong = True
            if wrong:
                return {"channel_id": channel, "bad": line.decode(errors="replace")}
            return {"channel_id": channel, **{n: found.get(n) for n in texts + numbers}}

        def read(self, partition):
            rows = []
            # Spark asks for one empty piece where there is none.
            for line in self.lines(partition) if partition else ():
                if not line.strip():
                    continue
                row = self.entry(line, partition.channel)
                if self.passes(row):
                    rows.append(row)
                if len(rows) == 4096:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    class Table(Files, ds.DataSourceReader):
        def partitions(self):
            return self.pieces(self.runs())

    class Stream(Files, ds.DataSourceStreamReader):
        def initialOffset(self):
            return {"run": ""}

        def latestOffset(self):
            return {"run": max(self.runs(), default="")}

        def partitions(self, start, end):
            return self.pieces(r for r in self.runs() if start["run"] < r <= end["run"])

        def commit(self, end):
            pass

    class Dump(ds.DataSource):
        @classmethod
        def name(cls):
            return FORMAT

        def schema(self):
            return SCHEMA

        def reader(self, schema):
            return Table(self.options)

        def streamReader(self, schema):
            return Stream(self.options)

    return Dump


def _options(spark: SparkSession, root: str, split_bytes: int, bounds: Sequence[tuple]) -> dict[str, str]:
    for name, how, _ in bounds:
        if name not in COMPARED or how not in COMPARISONS:
            raise ValueError(f"cannot compare {name!r} by {how!r}")
    spark.dataSource.register(_source())
    return {"root": root, "split_bytes": str(split_bytes), "bounds": json.dumps(list(bounds))}


def read_dump(spark: SparkSession, root: str, split_bytes: int = SPLIT_BYTES, bounds: Sequence[tuple] = ()) -> DataFrame:
    """The entries of all finished runs, with the lines that are none in ``bad``.

    Only runs before the first unfinished one are read, by the table as by the stream. ``bounds`` holds
    ``(column, comparison, value)``, as in ``("position", "<=", 10)`` or ``("channel_id", "in", ["a"])``; all must hold, and
    none holds for a missing value. A missing or empty folder has no entries; lines of blanks alone are passed over;
    further fields of an entry are ignored.
    """
    return spark.read.format(FORMAT).options(**_options(spark, root, split_bytes, bounds)).load()


def stream_dump(spark: SparkSession, root: str, split_bytes: int = SPLIT_BYTES, bounds: Sequence[tuple] = ()) -> DataFrame:
    """The same as a stream. Its offset is the name of the last run read, so names of runs must rise.

    A run that never finishes holds up those after it until its folder is removed.
    """
    return spark.readStream.format(FORMAT).options(**_options(spark, root, split_bytes, bounds)).load()


def entries(dump: DataFrame) -> DataFrame:
    """The listing of a dump, as ``Landing`` takes it."""
    return dump.where(F.col("bad").isNull()).drop("bad")


def failed_channels(dump: DataFrame) -> DataFrame:
    """Channels with a line that is no entry: their listing cannot be trusted."""
    return dump.where(F.col("bad").isNotNull() & F.col("channel_id").isNotNull()).select("channel_id").distinct()


def write_dump(listing: DataFrame, root: str, run: str) -> None:
    """Write a listing as one run of a dump; it counts when Spark has marked the folder as complete."""
    if not run or "/" in run or run[0] in "_.":
        raise ValueError(f"not a name of a visible folder: {run!r}")
    listing.write.partitionBy("channel_id").json(f"{root}/{run}")
