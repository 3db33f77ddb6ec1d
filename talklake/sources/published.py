"""Documents as text files that become visible together, as one batch.

Tasks write files into folders of their own below a hidden one. Only when all tasks have succeeded are the folders of
the successful attempts gathered and the batch is shown by one rename. A failed job shows nothing; what its last tasks
still write after the cleaning up stays hidden until ``clear_staging``. The driver handles one message per task, never
a file.
"""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from talklake.functions.markdown import FILE_PREFIX
from talklake.sources.documents import contents

FORMAT = "talklake_files"
STAGING = "_staging-"


def _source() -> type:
    """The data source's class; made here so that workers get it by value and need not import this package."""
    import uuid
    from dataclasses import dataclass

    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

    @dataclass
    class Written(WriterCommitMessage):
        folder: str
        files: int

    class FilesWriter(DataSourceArrowWriter):
        def __init__(self, root: str, batch: str):
            self.root, self.batch = root, batch
            self.staging = f"{STAGING}{uuid.uuid4().hex}"

        def place(self):
            target, folder = fs.FileSystem.from_uri(self.root)
            return target, folder.rstrip("/")

        def write(self, iterator):
            target, folder = self.place()
            mine, files = f"{folder}/{self.staging}/{uuid.uuid4().hex}", 0
            for batch in iterator:
                if batch.num_rows and not files:
                    target.create_dir(mine, recursive=True)
                for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if not name or "/" in name:
                        raise ValueError(f"not a file name: {name!r}")
                    with target.open_output_stream(f"{mine}/{name}") as out:
                        out.write((content or "").encode())
                    files += 1
            return Written(mine, files)

        def commit(self, messages):
            target, folder = self.place()
            staging, final = f"{folder}/{self.staging}", f"{folder}/{self.batch}"
            target.create_dir(f"{staging}/whole", recursive=True)
            for n, message in enumerate(m for m in messages if m and m.files):
                target.move(message.folder, f"{staging}/whole/{n}")
            if target.get_file_info(final).type != fs.FileType.NotFound:
                target.move(final, f"{staging}/replaced")
            target.move(f"{staging}/whole", final)
            target.delete_dir(staging)

        def abort(self, messages):
            target, folder = self.place()
            if target.get_file_info(f"{folder}/{self.staging}").type != fs.FileType.NotFound:
                target.delete_dir(f"{folder}/{self.staging}")

    class PublishedFiles(DataSource):
        @classmethod
        def name(cls):
            return FORMAT

        def schema(self):
            return "filename string, content string"

        def writer(self, schema, overwrite):
            return FilesWriter(self.options["root"], self.options["batch"])

    return PublishedFiles


def publish(docs: DataFrame, root: str, batch: str) -> None:
    """Show all documents as files of ``<root>/<batch>``, or none; a batch published again is replaced.

    ``root`` is a folder or URI that all executors share. Null content is an empty file, which Spark's readers pass
    over; a null or empty file name, or one with a slash, fails the job. Of equal names in one task the last is kept,
    names of different tasks are all kept.
    """
    if not batch or "/" in batch or batch[0] in "_.":
        raise ValueError(f"not a name of a visible folder: {batch!r}")
    docs.sparkSession.dataSource.register(_source())
    writer = docs.select("filename", "content").write.format(FORMAT).mode("append")
    writer.option("root", root).option("batch", batch).save()


def clear_staging(root: str) -> None:
    """Remove the hidden folders that failed jobs left in ``root``. Run it while nothing else publishes there."""
    target, folder = fs.FileSystem.from_uri(root)
    for found in target.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if found.base_name.startswith(STAGING):
            target.delete_dir(found.path)


def read_published(spark: SparkSession, root: str, prefix: str = FILE_PREFIX) -> DataFrame:
    """``(batch, filename, content)`` of the ``<prefix>-*.md`` files of all batches that are visible."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"{prefix}-*.md")
    return contents(reader, root, F.element_at(F.split("_metadata.file_path", "/"), -3).alias("batch"))
