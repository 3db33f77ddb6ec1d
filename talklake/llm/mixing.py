"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order. A document that is taken again comes once more after
its source's last one. Its virtual finish time is the number of tokens its source has served up to its end, divided by
the source's target, so a source with twice the target runs twice as fast and all sources reach their targets
together, at time one. The mix is what all queues hold, sorted by finish time and cut where the budget is spent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F

from talklake.llm.common import written
from talklake.operators.numbering import number_rows

#: A word, in a pattern of Java and of DuckDB.
WORD = r"[^\x20\x09-\x0D]+"
#: The query's weights, dealt to the sources in order.
WEIGHTS = (5, 2, 1)
#: What the mix holds, as a share of all tokens, and how often a document may be taken.
SHARE, REPEATS = 1.5, 2
#: The order of the mix: equal finish times go by source, and within it by the queue.
ORDER = ["finish", "rank", "epoch", "key", "row"]


@dataclass(frozen=True)
class Mix:
    """``documents``: the rows with their counts; ``entries``: what is taken, and when."""

    documents: DataFrame
    entries: DataFrame


def words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def shuffle_key(doc_id: Column, text: Column, seed: str) -> Column:
    """Place of a document in its queue: 60 bits of a digest of seed, id and text, the same in every run."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("bigint")


def weights_in_turn(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, weight`` for each row of ``sources (source)``: sources by code point, null last, take the weights in turn."""
    groups = sources.select("source", F.col("source").isNull().alias("_null"))
    numbered = number_rows(groups, "_null", "source", "_at", start=0, through_groups=True)
    cycle = F.array(*(F.lit(w) for w in weights))
    return numbered.select("source", F.get(cycle, (F.col("_at") % len(weights)).cast("int")).cast("bigint").alias("weight"))


def targets(sources: DataFrame, budget: float, repeats: int = REPEATS) -> DataFrame:
    """``sources (source, source_size, weight)`` with ``target``: shares of the budget by weight.

    A target stops at ``repeats`` times the source's size; what is over goes to the other sources by weight, until
    none is above. Each round is one aggregate over the sources; only its sums come to the driver. A round that
    stops no further source is the last, so there are as many rounds as sources at most, and few in practice.
    """
    cap = F.col("source_size") * repeats
    state = sources.withColumn("full", F.lit(False))
    while True:
        open_weight = F.sum(F.when(~F.col("full"), F.col("weight")))
        sums = state.agg(F.coalesce(open_weight, F.lit(0)).alias("open"), F.coalesce(F.sum(F.when(F.col("full"), cap)), F.lit(0)).alias("used")).first()
        if not sums["open"]:
            return state.withColumn("target", cap.cast("double")).drop("full")
        share = F.lit(budget - sums["used"]) * F.col("weight") / F.lit(sums["open"])
        now = written(state.withColumn("target", F.when(F.col("full"), cap.cast("double")).otherwise(share)), "targets")
        if now.where(~F.col("full") & (F.col("target") > cap)).isEmpty():
            return now.drop("full")
        state = now.withColumn("full", F.col("full") | (F.col("target") > cap)).drop("target")


def _ranges(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` dealt by ranges of ``order`` and written, with the number of the range as ``_part``."""
    return written(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")


def _served(rows: DataFrame) -> DataFrame:
    """``rows (rank, key, row, size)`` with ``end``: what their source has served when they are through.

    Ranges are summed, and only the rows of one range are added up together. So a source with a third of all rows is
    as well spread as others, and rows of one key too: ``row`` tells them apart.
    """
    ranged = _ranges(rows, ["rank", "key", "row"])
    keys = ["_part", "rank"]
    earlier = W.partitionBy("rank").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sums = ranged.groupBy(*keys).agg(F.sum("size").alias("_sum"))
    starts = sums.select(*keys, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = W.partitionBy(*keys).orderBy("key", "row").rowsBetween(W.unboundedPreceding, 0)
    ends = ranged.withColumn("_in", F.sum("size").over(inside)).join(starts, keys)
    return written(ends.withColumn("end", F.col("_in") + F.col("_before")).drop("_part", "_before", "_in"), "served")


def _cut(entries: DataFrame, budget: float) -> Row | None:
    """The first entry, in order, with which the mix would exceed the budget; None if there is none.

    Only the range in which that happens is looked at row by row.
    """
    ranged = _ranges(entries, ORDER)
    # One number per range, as many as there are partitions.
    upto = F.sum("_sum").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, 0))
    sums = ranged.groupBy("_part").agg(F.sum("size").alias("_sum")).withColumn("_upto", upto)
    over = sums.where(F.col("_upto") > budget).orderBy("_part").first()
    if over is None:
        return None
    total = F.sum("size").over(W.partitionBy("_part").orderBy(*ORDER).rowsBetween(W.unboundedPreceding, 0))
    rows = ranged.where(F.col("_part") == over["_part"]).withColumn("_total", total)
    left = budget - (over["_upto"] - over["_sum"])
    return rows.where(F.col("_total") > left).agg(F.min(F.struct(*ORDER)).alias("first")).first()["first"]


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: str = "mix",
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carry: list[str] | None = None,
) -> Mix:
    """The mix of all ``docs``: ``share`` times their words, by the ``weights (source, weight)`` of their sources.

    ``documents`` has one row per row of ``docs``: the columns ``carry`` (all, unless named) as ``doc``, a struct, so
    that no name can clash, and ``row, source, size, source_size, target, taken``; ``taken`` counts the words the mix
    takes, repeats too. ``entries`` has one row per take: ``row, epoch, finish`` and the order ``finish, rank, epoch, key, row``.

    Without ``weights``, sources take ``WEIGHTS`` in turn. Documents are taken whole, so a source is off its target
    by about one document. A null text has no words; null is a source, the last. A document without words is taken when
    its turn comes and adds nothing. Rows that agree in id and text are told apart by a number given when the
    rows are written; they are interchangeable. An empty table gives no rows. Weights must be positive; a source
    without one is an error.
    """
    names = docs.columns if carry is None else carry
    body = F.col(f"`{text}`")
    kept = F.struct(*(F.col(f"`{c}`") for c in names)) if names else F.struct(F.lit(None).alias("none"))
    rows = written(
        docs.select(
            kept.alias("doc"),
            F.col(f"`{source}`").alias("source"),
            words(body).alias("size"),
            shuffle_key(F.col(f"`{doc_id}`"), body, seed).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "documents",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    own = weights_in_turn(sizes, WEIGHTS) if weights is None else weights.select("source", "weight")
    own = own.withColumnsRenamed({"source": "_source"})
    weighed = written(
        sizes.join(own, F.col("source").eqNullSafe(F.col("_source")), "left").select(
            "source", "source_size",
            F.when(F.col("weight") > 0, F.col("weight")).otherwise(
                F.raise_error(F.concat(F.lit("no positive weight: "), F.coalesce("source", F.lit("null"))))
            ).alias("weight"),
        ),
        "sources",
    )
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    budget = share * total
    goals = targets(weighed, budget, repeats).withColumn("_null", F.col("source").isNull())
    ranked = written(number_rows(goals, "_null", "source", "rank", through_groups=True).drop("_null"), "targets")
    ranked = ranked.select(F.col("source").alias("_source"), "rank", "source_size", "target")
    queued = rows.join(ranked, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    served = _served(queued)

    # The same queue runs again for every repeat: an epoch adds the source's size to each end.
    epochs = F.sequence(F.lit(0), F.lit(repeats - 1))

    def finish(epoch: Column) -> Column:
        served_by_then = F.col("end") + epoch * F.col("source_size")
        return F.when(F.col("target") > 0, served_by_then / F.col("target")).otherwise(0.0)

    queue = served.withColumn("epoch", F.explode(epochs)).withColumn("finish", finish(F.col("epoch"))).select(*ORDER, "size")
    stop = _cut(queue, budget)
    if stop is None:
        before = lambda time, epoch: F.lit(True)
    else:
        types = {f.name: f.dataType for f in queue.schema.fields}
        bound = F.struct(*(F.lit(stop[c]).cast(types[c]).alias(c) for c in ORDER))
        at = lambda time, epoch: {"finish": time, "epoch": epoch}
        before = lambda time, epoch: F.struct(*(at(time, epoch).get(c, F.col(c)).alias(c) for c in ORDER)) < bound
    takes = F.size(F.filter(epochs, lambda e: before(finish(e), e))).cast("bigint")
    return Mix(
        served.select("doc", "row", "source", "size", "source_size", "target", (takes * F.col("size")).alias("taken")),
        queue.where(before(F.col("finish"), F.col("epoch"))),
    )


def ordered(mixed: Mix) -> DataFrame:
    """What a trainer reads: the taken documents, as often as they are taken, in the order of the mix."""
    rows = mixed.entries.join(mixed.documents.select("row", "doc"), "row")
    return rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).select("doc.*", "epoch", "finish")


def report(mixed: Mix) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of each document."""
    return mixed.documents.select("doc.doc_id", "size", "source_size", "target", "taken")
