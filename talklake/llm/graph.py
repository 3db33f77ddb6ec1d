"""Connected components by hooking to the smallest neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from talklake.llm.common import written


def _roots(parents: DataFrame) -> DataFrame:
    """Follow ``(id, root)`` pointers to their ends; every pointer's target is an ``id`` too."""
    while True:
        above = parents.select(F.col("id").alias("root"), F.col("root").alias("next"))
        jumped = written(parents.join(above, "root").select("id", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "roots")
        parents = jumped.select("id", "root")
        if jumped.where("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for every id in ``edges (a, b)``; the root is the smallest id of its component.

    Each round lets every id hook to its smallest neighbour, follows the pointers to their ends and
    keeps the edges between different ends, so the number of ends with an edge at least halves.
    All tables stay distributed, are summed before they are shuffled, and are written between rounds.
    """
    left = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    labels: DataFrame | None = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b")).select("id", F.least("id", "b").alias("root"))
        ends = _roots(written(hooks, "hooks"))
        if labels is None:
            labels = ends
        else:
            further = ends.select(F.col("id").alias("root"), F.col("root").alias("end"))
            labels = written(
                labels.join(further, "root", "left").select("id", F.coalesce("end", "root").alias("root")), "labels"
            )
        a_end, b_end = (ends.select(F.col("id").alias(c), F.col("root").alias(f"{c}_end")) for c in "ab")
        moved = left.join(a_end, "a").join(b_end, "b").select(F.col("a_end").alias("a"), F.col("b_end").alias("b"))
        left = written(moved.where("a <> b").distinct(), "edges")
    if labels is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return labels
