"""Rendered documents and the manifest of a batch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from talklake.functions import markdown
from talklake.functions.times import batch_name, moment
from talklake.operators.numbering import number_rows

# --- fixed values: texts of a batch's manifest ---------------------------------------
FILE_LINE = "- `%s`"
TITLE = "docs(transcripts): batch {batch_id}"
MESSAGE = """docs(transcripts): add batch {batch_id}

Auto-generated by {generator}
Files: {files} transcript(s)"""
BODY = """## Transcript Batch: `{batch_id}`

Auto-generated by **{generator}**.

### Files
{list}

---
*Review and merge to add these transcripts to the {corpus} corpus.*"""
# -------------------------------------------------------------------------------------


def numbered(videos: DataFrame, start: int | Column = 1, group: str = "ord") -> DataFrame:
    """Running number of the documents, in registry and page order."""
    return number_rows(videos, group, "position", "number", start=start, through_groups=True)


def rendered(
    videos: DataFrame,
    as_of: datetime,
    batch_id: str | None = None,
    prefix: str = markdown.FILE_PREFIX,
    generator: str = markdown.GENERATOR,
) -> DataFrame:
    """``(batch_id, number, video_id, filename, content)`` of numbered videos."""
    batch = F.lit(batch_id or batch_name(as_of))
    content = markdown.document(
        video_id=F.col("video_id"),
        title=F.col("title"),
        channel=F.col("channel"),
        published=F.col("published"),
        url=F.col("url"),
        duration_seconds=F.col("duration_seconds"),
        transcript=F.col("transcript"),
        topics=F.col("topics"),
        chapters=F.col("chapter_marks"),
        number=F.col("number"),
        batch_id=batch,
        as_of=moment(as_of),
        prefix=prefix,
        generator=generator,
    )
    return videos.select(
        batch.alias("batch_id"),
        "number",
        "video_id",
        markdown.file_name(F.col("number"), F.col("channel"), prefix).alias("filename"),
        content.alias("content"),
    )


def manifest(files: DataFrame, generator: str = markdown.GENERATOR, corpus: str = "document") -> DataFrame:
    """The manifest of each batch as a long table ``(batch_id, section, filename, text)``.

    ``files`` has ``batch_id`` and ``filename``. The sections ``title``, ``message``, ``body_head`` and ``body_tail``
    are one row each; ``file`` has one line per file, to be read in order of the names between head
    and tail. So a batch of any size has the same shape, and no task holds a batch's list.
    """
    head, tail = BODY.split("{list}")
    sections = {"title": TITLE, "message": MESSAGE, "body_head": head, "body_tail": tail}
    values = {
        "batch_id": F.col("batch_id"),
        "generator": F.lit(generator),
        "corpus": F.lit(corpus),
        "files": F.col("files").cast("string"),
    }
    texts = F.array(
        *(F.struct(F.lit(name).alias("section"), markdown.fill(text, values).alias("text")) for name, text in sections.items())
    )
    frame = files.groupBy("batch_id").agg(F.count("*").alias("files")).select("batch_id", F.explode(texts).alias("t"))
    lines = files.select(
        "batch_id", F.lit("file").alias("section"), "filename", F.format_string(FILE_LINE, "filename").alias("text")
    )
    return frame.select("batch_id", "t.section", F.lit(None).cast("string").alias("filename"), "t.text").unionByName(lines)
