"""Running numbers without a window over a whole group or table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from talklake.session import staged


def number_rows(
    rows: DataFrame,
    group: str,
    key: str,
    name: str,
    *,
    start: int | Column = 1,
    through_groups: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Number rows by ``key`` within each ``group``, from ``start``.

    With ``through_groups`` the count goes on from one group to the next, in order of ``group``. Rows are dealt
    by ranges of group and key and written once. Only the counts of the ranges, as many as there are
    partitions and groups, are summed in order, and only the rows of one range are sorted together: a group with a
    third of all rows, and keys of any spacing, are as well spread as others.
    """
    ranged = rows.repartitionByRange(partitions, group, key) if partitions else rows.repartitionByRange(group, key)
    placed = staged(ranged.withColumn("_part", F.spark_partition_id()), "numbered")
    counts = placed.groupBy("_part", group).agg(F.count("*").alias("_n"))
    if through_groups:
        per_part = counts.groupBy("_part").agg(F.sum("_n").alias("_n"))
        earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
        offsets = per_part.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
        turn, keys = F.row_number().over(W.partitionBy("_part").orderBy(group, key)), ["_part"]
    else:
        earlier = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
        offsets = counts.select("_part", group, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
        turn, keys = F.row_number().over(W.partitionBy("_part", group).orderBy(key)), ["_part", group]
    number = (turn + F.col("_offset") + start - 1).cast("bigint")
    return placed.join(offsets, keys).withColumn(name, number).drop("_part", "_offset")
