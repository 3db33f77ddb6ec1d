"""Rendered documents: file names, lists and the document text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from talklake import __version__
from talklake.functions.text import slug
from talklake.functions.times import day_text, duration_text, iso_text

# --- fixed values: names and texts of the output format ------------------------------
FILE_PREFIX = "TRANSCRIPT"
FILE_NAME = "%s-%03d-%s.md"
NO_TOPICS = "*(No topics detected)*"
NO_CHAPTERS = "*(No chapter markers found)*"
DOCUMENT = """# {heading}: {title}

## Status: Raw Transcript
## Date: {date}

## Source

- **Channel:** {channel}
- **Published:** {published}
- **Duration:** {duration}
- **Video URL:** {url}
- **Video ID:** `{video_id}`
- **Batch ID:** `{batch_id}`

---

## Topics Detected

{topics}

---

## Chapter Markers

{chapters}

---

## Transcript

{transcript}

---

*Generated by {generator} on {generated_at}*
"""
# -------------------------------------------------------------------------------------

GENERATOR = f"talklake v{__version__}"


def file_name(number: Column, channel: Column, prefix: str = FILE_PREFIX) -> Column:
    return F.format_string(FILE_NAME, F.lit(prefix), number, slug(channel))


def topic_list(topics: Column) -> Column:
    lines = F.array_join(F.transform(topics, lambda t: F.concat(F.lit("- "), t)), "\n")
    return F.when(F.size(topics) > 0, lines).otherwise(F.lit(NO_TOPICS))


def chapter_list(chapters: Column) -> Column:
    line = lambda c: F.concat(F.lit("- **"), c["timestamp"], F.lit("** — "), c["title"])
    lines = F.array_join(F.transform(chapters, line), "\n")
    return F.when(F.size(chapters) > 0, lines).otherwise(F.lit(NO_CHAPTERS))


def fill(template: str, values: dict[str, Column]) -> Column:
    """Put columns into a ``{name}`` template by concatenation: values are never parsed."""
    parts: list[Column] = []
    for chunk in template.split("{"):
        name, brace, text = chunk.partition("}")
        if brace and name in values:
            parts.append(values[name])
        else:
            text = chunk
        if text:
            parts.append(F.lit(text))
    return F.concat(*parts)


def document(
    *,
    video_id: Column,
    title: Column,
    channel: Column,
    published: Column,
    url: Column,
    duration_seconds: Column,
    transcript: Column,
    topics: Column,
    chapters: Column,
    number: Column,
    batch_id: Column,
    as_of: Column,
    prefix: str = FILE_PREFIX,
    generator: str = GENERATOR,
) -> Column:
    return fill(
        DOCUMENT,
        {
            "heading": F.format_string("%s-%03d", F.lit(prefix), number),
            "title": title,
            "date": day_text(as_of),
            "channel": channel,
            "published": day_text(published),
            "duration": duration_text(duration_seconds),
            "url": url,
            "video_id": video_id,
            "batch_id": batch_id,
            "topics": topic_list(topics),
            "chapters": chapter_list(chapters),
            "transcript": transcript,
            "generator": F.lit(generator),
            "generated_at": iso_text(as_of),
        },
    )
