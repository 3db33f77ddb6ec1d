"""Chapter markers from free text or from a native list.

A chapter is ``struct<timestamp string, title string, start_seconds double>``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from talklake.functions.arrays import let
from talklake.functions.text import SPACE, strip
from talklake.functions.times import clock_text

# --- fixed values: a marker line, and the title of an untitled chapter --------------
# (?m): a marker starts a line; (?d): only \n ends a line.
MARKER = rf"(?md)^(?:(\d{{1,2}}):)?(\d{{1,2}}):(\d{{2}})[{SPACE}]+(.+)$"
UNTITLED = "Untitled"
# -------------------------------------------------------------------------------------

EMPTY = "array<struct<timestamp:string,title:string,start_seconds:double>>"


def _chapter(timestamp: Column, title: Column, start: Column) -> Column:
    return F.struct(
        timestamp.alias("timestamp"), title.alias("title"), start.cast("double").alias("start_seconds")
    )


def from_text(description: Column) -> Column:
    """All marker lines of a description; digits are ASCII, no range check."""

    def parse(line: Column) -> Column:
        # The marker's pattern has been checked: up to the first blank, a line is its clock.
        return let(F.regexp_extract(line, r"^[\d:]+", 0), lambda clock: chapter(line, clock))

    def chapter(line: Column, clock: Column) -> Column:
        title = strip(F.substr(line, F.length(clock) + 1))
        numbers = F.transform(F.split(clock, ":"), lambda n: n.cast("int"))
        return let(numbers, lambda n: mark(n, title))

    def mark(numbers: Column, title: Column) -> Column:
        hours = F.when(F.size(numbers) > 2, F.get(numbers, F.lit(0))).otherwise(0)
        minutes, seconds = F.element_at(numbers, -2), F.element_at(numbers, -1)
        return _chapter(clock_text(hours, minutes, seconds), title, hours * 3600 + minutes * 60 + seconds)

    lines = F.regexp_extract_all(F.coalesce(description, F.lit("")), F.lit(MARKER), F.lit(0))
    return F.transform(lines, parse)


def from_native(chapters: Column) -> Column:
    """Chapters that came as a list; start 0 and ``Untitled`` where absent."""

    def convert(chapter: Column) -> Column:
        start = F.coalesce(chapter["start_time"], F.lit(0.0))
        whole = F.floor(start)
        return _chapter(
            clock_text(F.floor(whole / 3600), F.floor(whole % 3600 / 60), whole % 60),
            F.coalesce(chapter["title"], F.lit(UNTITLED)),
            start,
        )

    return F.transform(F.coalesce(chapters, F.array().cast(chapters_type())), convert)


def chapters_type() -> str:
    return "array<struct<start_time:double,end_time:double,title:string>>"


def pick(native: Column, description: Column) -> Column:
    """The native list, or the markers of the description when that list is empty."""
    return F.when(F.size(native) > 0, from_native(native)).otherwise(from_text(description))
