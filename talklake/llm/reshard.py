"""Resharding by a minimum-cost flow: the fewest bytes move from old shards to new capacities."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, WindowSpec, functions as F

from talklake.llm.common import written

#: Blocks per old shard and size class: a block is ordered in one task.
BLOCKS = 1024
#: Most shards on either side; the flow is solved on the driver over shard sizes only.
MAX_SHARDS = 2000


def capacities(total: int, shards: int) -> list[int]:
    """``total`` bytes dealt to ``shards`` as evenly as whole numbers allow."""
    return [total // shards + (i < total % shards) for i in range(shards)]


def min_cost_flow(
    supply: Sequence[int], demand: Sequence[int], cost: Sequence[Sequence[int]]
) -> list[list[int]]:
    """The cheapest flow that ships every supply within the demands.

    Successive shortest paths with potentials; the demands must add up to the supplies or more.
    Returns the bytes from each supply to each demand.
    """
    n, m = len(supply), len(demand)
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(demand)
    if sum(left) > sum(room):
        raise ValueError("the capacities are too small")
    potential = [0] * (n + m)
    while any(left):
        distance: list[float] = [float("inf")] * (n + m)
        came = [-1] * (n + m)
        heap = []
        for i in range(n):
            if left[i]:
                distance[i] = 0
                heap.append((0, i))
        heapq.heapify(heap)
        while heap:
            d, u = heapq.heappop(heap)
            if d > distance[u]:
                continue
            if u < n:
                edges = ((n + j, cost[u][j]) for j in range(m))
            else:
                edges = ((i, -cost[i][u - n]) for i in range(n) if flow[i][u - n])
            for v, c in edges:
                step = d + c + potential[u] - potential[v]
                if step < distance[v]:
                    distance[v], came[v] = step, u
                    heapq.heappush(heap, (step, v))
        ends = [n + j for j in range(m) if room[j] and distance[n + j] < float("inf")]
        end = min(ends, key=lambda v: (distance[v] + potential[v], v))
        far = max(d for d in distance if d < float("inf"))
        potential = [p + (d if d < float("inf") else far) for p, d in zip(potential, distance, strict=True)]
        path, v = [], end
        while came[v] >= 0:
            path.append((came[v], v))
            v = came[v]
        amount = min([left[v], room[end - n], *(flow[b][a - n] for a, b in path if a >= n)])
        for a, b in path:
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[v] -= amount
        room[end - n] -= amount
    return flow


def transfers(old: Sequence[int], new: Sequence[int]) -> list[list[int]]:
    """Bytes from each old to each new shard so that the fewest move; shard ``i`` may keep its own for nothing.

    The network has an edge of cost 0 from each old shard to its successor and edges of cost 1 to and from one hub.
    So the cheapest flow fills the free edges, and the hub deals what is left to the open capacities in order.
    """
    if sum(old) > sum(new):
        raise ValueError("the capacities are too small")
    flow = [[0] * len(new) for _ in old]
    for i, (have, room) in enumerate(zip(old, new, strict=False)):
        flow[i][i] = min(have, room)
    hub = iter([(j, room - (flow[j][j] if j < len(old) else 0)) for j, room in enumerate(new)])
    j, room = -1, 0
    for i, have in enumerate(old):
        left = have - (flow[i][i] if i < len(new) else 0)
        while left:
            while not room:
                j, room = next(hub)
            amount = min(left, room)
            flow[i][j] += amount
            left, room = left - amount, room - amount
    return flow


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text (none for null) and one for the separator."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def checksum(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def plan(rows: DataFrame, shards: int, old_shards: int, blocks: int = BLOCKS) -> DataFrame:
    """Rows ``(old, doc_id, size, text_crc32)`` with ``shard`` and ``slot``; the texts are not needed.

    Inside an old shard, rows are put into blocks by size class, largest first, and by checksum.
    A row's bytes lie at the sum of the earlier blocks and of the earlier rows of its block, so
    only blocks are summed per shard and only a block's rows are ordered together. The first
    bytes of a shard stay; what the flow sends away comes from its end, where rows are
    small, so that a boundary falls within a few bytes of where the flow puts it.
    Slots count a shard's rows from 0 in the order of old shard, block and row.

    Equal rows are ordered by all their columns; rows that agree in all of them are interchangeable.
    ``old`` must lie in ``0 .. old_shards - 1``. An empty table gives no rows.
    """
    found = _found(rows, shards, old_shards, blocks)
    # A block's rows for one shard are neighbours, so their numbers run without a gap.
    return found.join(_pieces(found).select("shard", "old", "block", "base"), ["shard", "old", "block"]).select(
        "old", "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("row")).alias("slot")
    )


def _blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with their block: by size class, largest first, and by a hash of key and checksum."""
    spread = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(blocks))
    grade = 63 - F.floor(F.log2(F.col("size").cast("double"))).cast("int")
    return rows.withColumn("block", grade * blocks + spread)


def _inside() -> WindowSpec:
    """The order of the rows of one block."""
    return W.partitionBy("old", "block").orderBy("doc_id", "text_crc32", "size")


def _found(rows: DataFrame, shards: int, old_shards: int, blocks: int) -> DataFrame:
    """A written table of each row's block, place in it and new shard."""
    if max(shards, old_shards) > MAX_SHARDS:
        raise ValueError(f"more than {MAX_SHARDS} shards")
    placed = _blocks(rows, blocks)
    per_block = written(
        placed.groupBy("old", "block").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "blocks"
    )
    sizes = {r["old"]: r["bytes"] for r in per_block.groupBy("old").agg(F.sum("bytes").alias("bytes")).collect()}
    old = [sizes.get(i, 0) for i in range(old_shards)]
    flow = transfers(old, capacities(sum(old), shards))
    before = F.sum("bytes").over(W.partitionBy("old").orderBy("block")) - F.col("bytes")
    starts = per_block.select("old", "block", before.alias("block_start"))
    at = F.sum("size").over(_inside().rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    ordered = placed.withColumn("at", at).withColumn("row", F.row_number().over(_inside()))
    # Both sides are dealt by (old, block): the windows above need no further shuffle.
    found = ordered.join(starts, ["old", "block"]).withColumn(
        "shard", _shard(F.col("old"), F.col("block_start") + F.col("at") + F.col("size") / 2, flow)
    )
    return written(found.select("old", "block", "row", "doc_id", "size", "text_crc32", "shard"), "placed")


def _pieces(found: DataFrame) -> DataFrame:
    """The runs of rows that a block sends to one shard: their first row, their number and the slot before them."""
    groups = found.groupBy("shard", "old", "block").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    earlier = F.sum("n").over(W.partitionBy("shard").orderBy("old", "block")) - F.col("n")
    return groups.select("shard", "old", "block", "first", "n", (earlier - F.col("first")).alias("base"))


def _shard(old: Column, middle: Column, flow: list[list[int]]) -> Column:
    """The new shard of the row whose middle byte lies at ``middle`` of its old shard."""
    ends, names = [], []
    for i, sent in enumerate(flow):
        # The shard's own bytes first, then what leaves.
        order = [j for j in (i, *(j for j in range(len(sent)) if j != i)) if j < len(sent) and sent[j]]
        total, own_ends = 0, []
        for j in order:
            total += sent[j]
            own_ends.append(total)
        ends.append(F.array(*(F.lit(x) for x in own_ends)) if own_ends else F.array(F.lit(0)))
        names.append(F.array(*(F.lit(j) for j in order)) if order else F.array(F.lit(0)))
    row_ends, row_names = F.array(*ends)[old], F.array(*names)[old]
    place = F.size(F.filter(row_ends, lambda e: e.cast("double") <= middle))
    return F.get(row_names, F.least(place, F.size(row_names) - 1))


def affected(planned: DataFrame) -> DataFrame:
    """Per new shard, the old shards that send rows to it; a shard fed by itself alone keeps its file."""
    return planned.groupBy("shard").agg(F.sort_array(F.collect_set("old")).alias("sources"))


def rewrite(
    docs: DataFrame,
    planned: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    old: Column | None = None,
) -> DataFrame:
    """Write the full rows of every shard that gains or loses rows, one folder ``shard=i`` each.

    Rows of ``docs`` and of the plan meet by ``key``, size and checksum of the text and their position among the
    rows that agree in these, so null and repeated keys are written as often as they are planned. ``old`` is the
    old shard of a row of ``docs``; it is needed, and asked for by an error, where rows of one key and text but
    with other columns of their own lie in several old shards. Rows that agree in key and text are numbered in one task.

    Shards that are fed by themselves alone and send nothing away are left out. Returns the names of the written
    shards and their rows.
    """
    moved = planned.where(F.col("old") != F.col("shard"))
    touched = moved.select("shard").union(moved.select(F.col("old").alias("shard"))).distinct()
    names = ["_key", "_size", "_crc"] + (["_old"] if old is not None else [])
    rows = planned.select(
        F.col(f"`{key}`").alias("_key"),
        F.col("size").alias("_size"),
        F.col("text_crc32").alias("_crc"),
        F.col("old").alias("_old"),
        "shard",
        "slot",
    )
    columns = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    plain = [f.name for f in docs.schema.fields if f.name in columns and "map<" not in f.dataType.simpleString()]
    body = F.col(f"`{text}`")
    own = docs.select(
        *(F.col(f"`{c}`") for c in columns),
        F.col(f"`{key}`").alias("_key"),
        size_of(body).alias("_size"),
        checksum(body).alias("_crc"),
        (F.lit(None) if old is None else old).cast("int").alias("_old"),
        F.xxhash64(*(F.col(f"`{c}`") for c in plain)).alias("_content"),
    )
    same = lambda a, b, by: [a[n].eqNullSafe(b[n]) for n in by]
    if old is None:
        spread = rows.groupBy(*names).agg(F.min("_old").alias("low"), F.max("_old").alias("high")).where("low < high")
        unsure = own.join(spread, same(own, spread, names), "left_semi").groupBy(*names)
        if not unsure.agg(F.min("_content").alias("low"), F.max("_content").alias("high")).where("low < high").isEmpty():
            raise ValueError("rows of one key and text lie in several old shards: give their old shard")
    # Numbered before the shards that stay are left out, on both sides alike.
    rows = rows.withColumn("_at", F.row_number().over(W.partitionBy(*names).orderBy("shard", "slot")))
    own = own.withColumn("_at", F.row_number().over(W.partitionBy(*names).orderBy("_content")))
    rows = rows.join(touched, "shard", "left_semi")
    full = own.join(rows, same(own, rows, [*names, "_at"])).select(*(own[f"`{c}`"] for c in columns), "shard", "slot")
    full.repartition("shard", F.floor(F.col("slot") / 100_000)).write.partitionBy("shard").mode("overwrite").parquet(path)
    spark: SparkSession = docs.sparkSession
    return spark.read.parquet(path).groupBy("shard").count()


def move(
    docs: DataFrame,
    old: Column,
    shards: int,
    old_shards: int,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    blocks: int = BLOCKS,
) -> DataFrame:
    """The whole job: plan, write the full rows of the affected shards below ``path``, and report from the files.

    The plan is made from key, size and checksum alone. Then the rows of the affected old shards are dealt by block,
    numbered in it as in the plan, and written from there: a piece of the plan names the shard and the slots of a
    block's run of rows, so a text is shuffled once, and a task that runs again writes the same set of rows. A shard
    that is fed by itself alone and sends nothing away is not written; its rows are reported from the plan.

    Returns ``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot`` and ``old_shard`` of every row, null and
    repeated keys included; of written shards they are read back from their files. The files hold the columns of
    ``docs`` (but for columns of the names that this adds), ``slot`` and ``old_shard``, in folders ``shard=i``.
    Rows that agree in key and text may take each other's slot. An empty table writes nothing and gives no rows.
    """
    body = F.col(f"`{text}`")
    light = [old.cast("int").alias("old"), F.col(f"`{key}`").alias("doc_id"), size_of(body).alias("size")]
    rows = written(docs.select(*light, checksum(body).alias("text_crc32")), "sizes")
    found = _found(rows, shards, old_shards, blocks)
    pieces = written(_pieces(found), "pieces")
    moved = pieces.where(F.col("old") != F.col("shard"))
    # At most MAX_SHARDS numbers.
    touched = [r[0] for r in moved.select("shard").union(moved.select("old")).distinct().collect()]
    own = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row_"), *light, checksum(body).alias("text_crc32")
    ).where(F.col("old").isin(touched))
    numbered = _blocks(own, blocks).withColumn("at", F.row_number().over(_inside()))
    in_piece = (F.col("at") >= F.col("first")) & (F.col("at") < F.col("first") + F.col("n"))
    placed = numbered.join(pieces, ["old", "block"]).where(in_piece)
    carried = [c for c in docs.columns if c.lower() not in ("shard", "slot", "old_shard")]
    full = placed.select(
        *(F.col("row_").getField(c).alias(c) for c in carried),
        (F.col("base") + F.col("at")).alias("slot"),
        F.col("old").alias("old_shard"),
        "shard",
    )
    spark: SparkSession = docs.sparkSession
    full.write.partitionBy("shard").mode("overwrite").parquet(path)
    names = ["doc_id", "size", "text_crc32", "shard", "slot", "old_shard"]
    stays = found.where(~F.col("shard").isin(touched)).join(pieces, ["shard", "old", "block"])
    report = stays.withColumn("slot", F.col("base") + F.col("row")).withColumnRenamed("old", "old_shard").select(*names)
    if not touched:
        return report
    files = spark.read.schema(full.schema).parquet(path)
    back = files.select(
        F.col(f"`{key}`").alias("doc_id"), size_of(body).alias("size"), checksum(body).alias("text_crc32"),
        "shard", "slot", "old_shard",
    )
    return back.unionByName(report)
