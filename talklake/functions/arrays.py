"""Array helpers built from Spark's higher-order functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def neighbours(items: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """``combine`` for each pair of adjacent items; empty for fewer than two items."""
    pairs = F.greatest(F.size(items) - 1, F.lit(0))
    return F.zip_with(F.slice(items, 1, pairs), F.slice(items, 2, pairs), combine)


def runs(ordered: Column) -> Column:
    """Runs of equal items in a sorted array: ``struct(item, n, start)`` in order, start from 0.

    Counting by sorting keeps a document's term counts inside its own row: no
    explode, no shuffle. Work is O(n log n) in the length of the array.
    """

    def between(items: Column) -> Column:
        starts = F.filter(
            F.transform(items, lambda x, i: F.when((i == 0) | (x != F.get(items, i - 1)), i)),
            lambda i: i.isNotNull(),
        )
        return let(
            F.concat(starts, F.array(F.size(items))),
            lambda cuts: neighbours(
                cuts,
                lambda a, b: F.struct(
                    F.get(items, a).alias("item"), (b - a).alias("n"), a.alias("start")
                ),
            ),
        )

    return let(ordered, between)


def exploded(items: Column) -> Column:
    """Explode an expensive array.

    An inner explode lets Catalyst infer the filter ``size(items) > 0``, which computes
    the array a second time. The outer one does not; drop its NULL for an empty array.
    """
    return F.explode_outer(items)
