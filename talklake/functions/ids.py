"""Stable ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def point_id(video_id: Column) -> Column:
    """First 8 bytes of SHA-256 as a big-endian number, modulo 2^63.

    ``conv`` to base -10 gives the signed 64-bit value; clearing its sign bit is the
    modulo, so no decimal arithmetic is needed.
    """
    signed = F.conv(F.substring(F.sha2(video_id, 256), 1, 16), 16, -10).cast("bigint")
    return signed.bitwiseAND(F.lit((1 << 63) - 1))


def bucket(point: Column, buckets: int) -> Column:
    return F.pmod(point, F.lit(buckets)).cast("int")
