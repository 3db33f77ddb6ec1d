"""Dates, durations and time stamps as text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def moment(as_of: datetime) -> Column:
    """A naive time as a literal that no session time zone can shift."""
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def parse_day(text: Column) -> Column:
    """``yyyyMMdd`` as midnight of that day; NULL when missing or malformed."""
    return F.try_to_date(text, "yyyyMMdd").cast("timestamp_ntz")


def day_text(moment_col: Column) -> Column:
    return F.date_format(moment_col, "yyyy-MM-dd")


def iso_text(moment_col: Column) -> Column:
    return F.date_format(moment_col, "yyyy-MM-dd'T'HH:mm:ss")


def batch_name(as_of: datetime) -> str:
    return as_of.strftime("batch-%Y-%m-%dT%H-%M-%S")


def clock_text(hours: Column, minutes: Column, seconds: Column) -> Column:
    """``h:mm:ss``, or ``m:ss`` below one hour."""
    return F.when(hours > 0, F.format_string("%d:%02d:%02d", hours, minutes, seconds)).otherwise(
        F.format_string("%d:%02d", minutes, seconds)
    )


def duration_text(seconds: Column) -> Column:
    """``1h 2m 3s``, ``2m 3s`` below one hour, ``Unknown`` for zero or less."""
    whole = seconds.cast("bigint")
    hours = F.floor(whole / 3600)
    minutes = F.floor(whole % 3600 / 60)
    rest = whole % 60
    return (
        F.when(whole <= 0, F.lit("Unknown"))
        .when(hours > 0, F.format_string("%dh %dm %ds", hours, minutes, rest))
        .otherwise(F.format_string("%dm %ds", minutes, rest))
    )
