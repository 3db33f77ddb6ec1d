"""N-gram Jaccard join by parity sketches, a pigeonhole join per size band, and verification.

A document's set are its distinct shingles. In a size band, a shingle belongs to one of ``m`` blocks and toggles a
bit of it; the toggled bits are the sketch. A shingle in one set only changes one bit at most, so the Hamming
distance of two sketches is at most the symmetric difference ``d`` of the sets, and ``100 |A & B| >= s |A | B|``
bounds that by ``(100 - s) (|A| + |B|) / (100 + s)``. So at least ``m - d`` blocks of a linked pair
are equal, and if both documents list their blocks in one common order, heaviest first, the first ``d + 1`` blocks of
each have one in common. Only these are joined.

Blocks have many more bits than are written down: what is joined is the XOR of a random number per toggled bit. A
second, dense sketch is written bit by bit and checks candidates before their sets are compared.

Documents with one set count as one. A bucket of the join is not taken apart into pairs: its members are compared with
its smallest one first, and what is then in one component needs no further comparison. Of the members in different
components, those pairs are compared whose dense sketches are near enough: first the nearest pair of each component,
then the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from talklake.llm.common import free_name, keep_only, slices, text_buffer, text_sizes, written
from talklake.llm.graph import components
from talklake.llm.rolling import Ranges, mixed

SHINGLE = 4
SIMILARITY = 85
#: Blocks per differing shingle: more blocks are lighter, but leave more of them unlisted.
SLACK = 1.3
#: Bits of the dense sketch per differing shingle.
DENSITY = 16
#: Distinct sets a worker remembers so as to list the blocks of copies once.
SEEN = 1 << 19
#: Members of buckets a worker gathers, and pairs of them it compares at once.
ROWS, PAIRS = 20_000, 1 << 19
#: Members of a bucket in one block: a task compares two of them.
BLOCK = 8192
_BAND = np.uint64(31)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, A-Z in lower case, and the text of each."""
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins, ends = ~blank, ~blank
    before = np.concatenate(([True], blank))[:-1] if len(data) else np.zeros(0, bool)
    after = np.concatenate((blank, [True]))[1:] if len(data) else np.zeros(0, bool)
    before[inner] = True
    after[inner - 1] = True
    starts, stops = np.flatnonzero(begins & before), np.flatnonzero(ends & after) + 1
    owner = np.searchsorted(offsets, starts, side="right") - 1
    return Ranges(lower).hash(starts, stops), owner


_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, in order, and their text.

    A text of fewer words, but not none, has its words as one shingle.
    """
    words, owner = word_hashes(data, offsets)
    counts = np.bincount(owner, minlength=len(offsets) - 1)
    first = np.cumsum(counts) - counts
    place = np.arange(len(words)) - first[owner]
    value, width = np.zeros(len(words), np.uint64), np.minimum(counts[owner], size)
    for k in range(size):
        reach = np.minimum(np.arange(len(words)) + k, max(len(words) - 1, 0))
        value += np.where(k < width, words[reach] * _STEPS[k % len(_STEPS)] * np.uint64(2 * k + 1), np.uint64(0))
    value = mixed(value + width.astype(np.uint64))
    whole = place + width <= counts[owner]
    value, owner = value[whole], owner[whole]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    if not len(value):
        return value, owner
    fresh = np.concatenate(([True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])))
    return value[fresh], owner[fresh]


def furthest(a, b, similarity: int = SIMILARITY):
    """The largest symmetric difference of linked sets of these sizes."""
    return (100 - similarity) * (a + b) // (100 + similarity)


def band_of(n: np.ndarray) -> np.ndarray:
    """The size band: sizes from a power of two to the next."""
    return np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)


def blocks_of(band: np.ndarray, similarity: int) -> np.ndarray:
    most = furthest((2 << band) - 1, (2 << band) - 1, similarity)
    return np.ceil(SLACK * most).astype(np.int64) + 1


def largest_partner(n: np.ndarray, similarity: int) -> np.ndarray:
    return 100 * n // similarity


def listed_blocks(value: np.ndarray, owner: np.ndarray, n: np.ndarray, band: np.ndarray, similarity: int):
    """The blocks each text lists in a band, as keys with the band in the low bits, and their text.

    ``owner`` numbers the texts of ``n`` and ``band``. The order, heaviest first, then by key, depends on a
    block's content alone.
    """
    m = blocks_of(band, similarity)
    base = np.cumsum(m) - m
    at = base[owner] + (value % m[owner].astype(np.uint64)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    at, bits = at[order], mixed(value[order] ^ _STEPS[4])
    total = int(m.sum())
    weight = np.bincount(at, minlength=total)
    content = np.zeros(total, np.uint64)
    if len(at):
        begins = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        content[at[begins]] = np.bitwise_xor.reduceat(bits, begins)
    text = np.repeat(np.arange(len(n)), m)
    number = np.arange(total) - base[text]
    key = mixed(content ^ mixed((number + 1).astype(np.uint64) * _STEPS[5] + band[text].astype(np.uint64)))
    key = (key & ~_BAND) | band[text].astype(np.uint64)
    order = np.lexsort((key, -weight, text))
    rank = np.arange(total) - base[text]  # the texts keep their places in the order
    partner = np.minimum(largest_partner(n, similarity), (2 << band) - 1)
    kept = rank < (furthest(n, partner, similarity) + 1)[text]
    return key[order][kept], text[order][kept]


def dense_bits(band: int, similarity: int) -> int:
    """Bits of the dense sketch in a band: a power of two."""
    most = int(furthest((2 << band) - 1, (2 << band) - 1, similarity))
    return max(64, 1 << (DENSITY * (most + 1) - 1).bit_length())


def dense_sketch(value: np.ndarray, bits: int) -> np.ndarray:
    """Parities by the hash's low bits, eight to a byte; folding halves of it gives the smaller sketch."""
    odd = np.bincount((mixed(value) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def folded(sketch: np.ndarray, bits: int) -> np.ndarray:
    while len(sketch) * 8 > bits:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


_SETS = "doc bigint, tag bigint, n bigint, d1 bigint, d2 bigint, keys array<bigint>"


def _listed(batches: Iterator[pa.RecordBatch], size: int, similarity: int) -> Iterator[pa.RecordBatch]:
    """Per row: the set's size, its digest, and the listed blocks unless an earlier row has the same set."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        texts = batch.column("text")
        for begin, end in slices(text_sizes(texts)):
            rows = end - begin
            value, owner = shingles(*text_buffer(texts.slice(begin, rows)), size)
            n = np.bincount(owner, minlength=rows)
            d1, d2 = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
            begins = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, int)
            if len(begins):
                d1[owner[begins]] = np.add.reduceat(mixed(value ^ _STEPS[6]), begins)
                d2[owner[begins]] = np.add.reduceat(mixed(value ^ _STEPS[7]), begins)
            fresh = np.zeros(rows, bool)
            for i in range(rows):
                digest = (int(d1[i]), int(d2[i]))
                fresh[i] = n[i] > 0 and digest not in seen
                if fresh[i]:
                    seen.add(digest)
            if len(seen) > SEEN:
                seen.clear()
            # Number the texts that list blocks.
            number = np.cumsum(fresh) - 1
            mine = fresh[owner]
            value, owner = value[mine], number[owner[mine]]
            sizes = n[fresh]
            own = band_of(sizes)
            keys, of = listed_blocks(value, owner, sizes, own, similarity)
            # Sets whose partners may be in the next band list blocks there, too.
            wide = largest_partner(sizes, similarity) >= (2 << own)
            wide_number = np.cumsum(wide) - 1
            mine = wide[owner]
            more, more_of = listed_blocks(value[mine], wide_number[owner[mine]], sizes[wide], own[wide] + 1, similarity)
            keys = np.concatenate((keys, more))
            of = np.concatenate((of, np.flatnonzero(wide)[more_of]))
            order = np.argsort(of, kind="stable")
            per_text = np.zeros(rows, np.int64)
            per_text[fresh] = np.bincount(of, minlength=len(sizes))
            offsets = np.concatenate(([0], np.cumsum(per_text))).astype(np.int32)
            part = batch.slice(begin, rows)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc"),
                    part.column("tag"),
                    pa.array(n.astype(np.int64)),
                    pa.array(d1.view(np.int64)),
                    pa.array(d2.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[order].view(np.int64))),
                ],
                names=["doc", "tag", "n", "d1", "d2", "keys"],
            )


_STORED = "id bigint, n bigint, members binary, sketch binary"


def _stored(batches: Iterator[pa.RecordBatch], size: int, similarity: int) -> Iterator[pa.RecordBatch]:
    """The sets of candidates and their dense sketches, as wide as the next band needs; one row per id."""
    done: set[int] = set()
    for batch in batches:
        fresh = []
        for i, one in enumerate(batch.column("id").to_pylist()):
            if one not in done:
                done.add(one)
                fresh.append(i)
        batch = batch.take(pa.array(fresh, pa.int64()))
        if not batch.num_rows:
            continue
        texts = batch.column("text")
        for begin, end in slices(text_sizes(texts)):
            rows = end - begin
            value, owner = shingles(*text_buffer(texts.slice(begin, rows)), size)
            n = np.bincount(owner, minlength=rows)
            ends = np.cumsum(n)
            sets = [value[e - k : e] for e, k in zip(ends, n, strict=True)]
            sketches = [dense_sketch(s, dense_bits(int(b) + 1, similarity)) for s, b in zip(sets, band_of(n), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(begin, rows),
                    pa.array(n.astype(np.int64)),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sketches], pa.binary()),
                ],
                names=["id", "n", "members", "sketch"],
            )


def _near(batches: Iterator[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose dense sketches allow a link, with the distance."""
    for batch in batches:
        rows = {n: batch.column(n).to_pylist() for n in ("a", "b", "a_n", "b_n", "a_sketch", "b_sketch")}
        out = []
        for a, b, n, m, s, t in zip(*rows.values(), strict=True):
            s, t = np.frombuffer(s, np.uint8), np.frombuffer(t, np.uint8)
            bits = 8 * min(len(s), len(t))
            distance = int(np.bitwise_count(folded(s, bits) ^ folded(t, bits)).sum())
            if 100 * min(n, m) >= similarity * max(n, m) and distance <= furthest(n, m, similarity):
                out.append((a, b, distance))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(3)], names=["a", "b", "distance"])


def _linked(batches: Iterator[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets are similar enough, exactly."""
    for batch in batches:
        rows = {n: batch.column(n).to_pylist() for n in ("a", "b", "a_members", "b_members")}
        out = []
        for a, b, s, t in zip(*rows.values(), strict=True):
            s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
            both = np.concatenate((s, t))
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            if 100 * common >= similarity * (len(s) + len(t) - common):
                out.append((a, b))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(2)], names=["a", "b"])


def _folded_rows(ids: np.ndarray, sketches: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """One folded sketch per distinct id, and the place of each row's id among them."""
    _, first, place = np.unique(ids, return_index=True, return_inverse=True)
    matrix = np.stack([folded(np.frombuffer(sketches[i], np.uint8), bits) for i in first])
    return matrix.view(np.uint64), place


def _distances(matrix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros(len(a), np.int64)
    for k in range(matrix.shape[1]):
        out += np.bitwise_count(matrix[a, k] ^ matrix[b, k])
    return out


def _partners(fresh: np.ndarray, side: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of a group the range of the rows it is compared with.

    Rows come group by group, ``fresh`` at the first, by side and root. With two sides, a row of the first meets
    all of the second; with one, a row meets those behind its component's last. No pair is of one component.
    """
    total = len(fresh)
    place = np.arange(total)
    begins = np.flatnonzero(fresh)
    end = np.append(begins[1:], total)[np.cumsum(fresh) - 1]
    turn = np.concatenate(([True], fresh[1:] | (root[1:] != root[:-1]) | (side[1:] != side[:-1])))
    first = np.flatnonzero(turn)
    behind = np.append(first[1:], total)[np.cumsum(turn) - 1]
    seconds = np.add.reduceat(side, begins)[np.cumsum(fresh) - 1]
    start = np.where(seconds == 0, behind, np.where(side == 0, end - seconds, end))
    return np.maximum(start, place), end


def _inside(start: np.ndarray, end: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the rows ``low .. high`` with their partners."""
    count = end[low:high] - start[low:high]
    a = np.repeat(np.arange(low, high), count)
    return a, np.repeat(start[low:high] - np.cumsum(count) + count, count) + np.arange(len(a))


def _foreign(batches: Iterator[pa.RecordBatch], similarity: int, best: bool) -> Iterator[pa.RecordBatch]:
    """Near pairs of different components in each group; rows come group by group, by side, root and id.

    With ``best``, of each component in a group the nearest foreign pair only, so that no more pairs leave the task
    than there are rows. Pairs exist in blocks of bounded size, and only near ones leave the task.
    """

    def near(rows: dict[str, np.ndarray], sketches: list[bytes]) -> pa.RecordBatch | None:
        key, group, side, ids, n, root = (rows[c] for c in ("key", "group", "side", "id", "n", "root"))
        fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])))
        bucket = np.cumsum(fresh) - 1
        start, end = _partners(fresh, side, root)
        found: list[np.ndarray] = []
        for band in np.unique(key & 31):
            mine = np.flatnonzero((key & 31) == band)
            matrix, place = _folded_rows(ids[mine], [sketches[i] for i in mine], dense_bits(int(band), similarity))
            at = np.zeros(len(key), np.int64)
            at[mine] = place
            reach = np.cumsum(np.where((key & 31) == band, end - start, 0))
            low = 0
            while low < len(key):
                base = reach[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(reach, base + PAIRS, side="right")))
                a, b = _inside(start, end, low, high)
                low = high
                keep = (key[a] & 31) == band
                keep &= 100 * np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b])
                a, b = a[keep], b[keep]
                distance = _distances(matrix, at[a], at[b])
                keep = distance <= furthest(n[a], n[b], similarity)
                a, b, distance = a[keep], b[keep], distance[keep]
                if best and len(a):
                    chosen = [_nearest(bucket[x], root[x], distance, ids[x], ids[y]) for x, y in ((a, b), (b, a))]
                    keep = np.unique(np.concatenate(chosen))
                    a, b = a[keep], b[keep]
                if len(a):
                    found.append(np.unique(np.stack((np.maximum(ids[a], ids[b]), np.minimum(ids[a], ids[b])), 1), axis=0))
        if not found:
            return None
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    waiting: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        count += batch.num_rows
        if count < ROWS:
            continue
        # The last group may go on in the next batch.
        table = pa.Table.from_batches(waiting)
        key, group = table["key"].to_numpy(), table["group"].to_numpy()
        other = np.flatnonzero((key != key[-1]) | (group != group[-1]))
        cut = int(other[-1]) + 1 if len(other) else 0
        waiting = table.slice(cut).combine_chunks().to_batches()
        count = len(key) - cut
        if cut and (out := near(*_rows(table.slice(0, cut)))) is not None:
            yield out
    if waiting and (out := near(*_rows(pa.Table.from_batches(waiting)))) is not None:
        yield out


def _nearest(bucket: np.ndarray, component: np.ndarray, distance: np.ndarray, own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Places of the nearest pair of each component of a bucket; of equals that with the smallest ids."""
    order = np.lexsort((other, own, distance, component, bucket))
    b, c = bucket[order], component[order]
    return order[np.concatenate(([True], (b[1:] != b[:-1]) | (c[1:] != c[:-1])))]


def _rows(table: pa.Table) -> tuple[dict[str, np.ndarray], list[bytes]]:
    return {c: table[c].to_numpy() for c in ("key", "group", "side", "id", "n", "root")}, table["sketch"].to_pylist()


def _applied(df: DataFrame, work, schema: str, *arguments) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("rolling")
        yield from work(batches, *arguments)

    return df.mapInArrow(run, schema)


def _with_both(pairs: DataFrame, stored: DataFrame, *columns: str) -> DataFrame:
    """Pairs with columns of both sides' stored sets."""
    for side in "ab":
        own = stored.select(F.col("id").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns))
        pairs = pairs.join(own, side)
    return pairs


def _verified(pairs: DataFrame, stored: DataFrame, similarity: int) -> DataFrame:
    return _applied(_with_both(pairs, stored, "members"), _linked, "a bigint, b bigint", similarity)


def _grouped(docs: DataFrame, text: str, doc_id: str, size: int, similarity: int) -> DataFrame:
    """Per row of ``docs``: ``row, doc, tag, n, root``; the root is null without shingles.

    ``row`` numbers the rows, ``tag`` is a hash of the text, ``root`` names the component.
    """
    own = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc"),
        F.xxhash64(F.col(f"`{text}`")).alias("tag"),
        F.col(f"`{text}`").alias("text"),
    )
    # Written before the row numbers are used, so they never change.
    listed = written(
        _applied(own, _listed, _SETS, size, similarity).withColumn("row", F.monotonically_increasing_id()), "listed"
    )
    sets = listed.where("n > 0").select("row", "doc", "tag", "n", "d1", "d2")
    first = sets.groupBy("d1", "d2").agg(F.min("row").alias("id"))
    numbered = written(sets.join(first, ["d1", "d2"]).drop("d1", "d2"), "numbered")
    labels = _labels(own, listed, numbered, size, similarity)
    roots = numbered.join(labels, "id", "left").withColumn("root", F.coalesce("root", "id"))
    empty = listed.where("n = 0").withColumn("root", F.lit(None).cast("bigint"))
    columns = ("row", "doc", "tag", "n", "root")
    return written(roots.select(*columns).unionByName(empty.select(*columns)), "members")


def link_components(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    size: int = SHINGLE,
    similarity: int = SIMILARITY,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable by links, the document's own included. Links of different
    texts are all found; of a group that hangs together, only as many links are verified as it takes to know that.

    Documents without words, or without a text, have no shingles and no links. Rows with the same set are linked.
    A null id is never the smallest; a component of null ids alone has a null id. Repeated rows stay. Other columns
    do not matter.
    """
    rows = _grouped(docs, text, doc_id, size, similarity)
    least = rows.where("n > 0").groupBy("root").agg(F.min("doc").alias("least"))
    return rows.join(least, "root", "left").select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc")).alias("component_id"),
    )


def one_per_group(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    size: int = SHINGLE,
    similarity: int = SIMILARITY,
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each component, and those without shingles.

    Nulls count as the greatest id; of equal ids the first row stays. Rows with equal id and text
    become one.
    """
    rows = _grouped(docs, text, doc_id, size, similarity)
    chosen = rows.where("n > 0").groupBy("root").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "row", "tag")).alias("m"))
    kept = chosen.select("m.doc", "m.tag").unionByName(rows.where("n = 0").select("doc", "tag"))
    # Nulls are spelled out, so that the join below is an equality of plain values.
    key = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    own = [free_name(docs, name) for name in ("__key", "__tag")]
    kept = kept.select(key(F.col("doc")).alias(own[0]), F.col("tag").alias(own[1])).distinct()
    keyed = docs.withColumns(dict(zip(own, (key(F.col(f"`{doc_id}`").cast("bigint")), F.xxhash64(F.col(f"`{text}`"))))))
    # The join has dealt the rows by the same columns.
    return keyed.join(kept, own).dropDuplicates(own).select(*(F.col(f"`{c}`") for c in docs.columns))


def _labels(own: DataFrame, listed: DataFrame, numbered: DataFrame, size: int, similarity: int) -> DataFrame:
    """``(id, root)`` of the distinct sets that share a block with another: their components."""
    keys = listed.select("row", F.explode("keys").alias("key"))
    per_key = W.partitionBy("key")
    shared = keys.select("key", "row", F.min("row").over(per_key).alias("low"), F.max("row").over(per_key).alias("high"))
    shared = written(shared.where("low < high").select("key", "row"), "shared")
    # Copies meet in their first row.
    distinct = shared.join(numbered.select("row", "id"), "row").select("key", "id").distinct()
    per_key = W.partitionBy("key")
    counted = distinct.select(
        "key", "id", F.min("id").over(per_key).alias("low"), F.count("*").over(per_key).alias("size")
    )
    buckets = written(counted.where("size > 1"), "buckets")
    wanted = buckets.select("id").distinct().join(numbered.where("row = id").select("id", "doc", "tag"), "id")
    texts = wanted.join(own, wanted["doc"].eqNullSafe(own["doc"]) & (wanted["tag"] == own["tag"])).select("id", "text")
    stored = written(_applied(texts, _stored, _STORED, size, similarity), "stored")
    # Every member with its bucket's smallest one: the nearest of these is verified first, then what the
    # links found so far leave open.
    stars = buckets.where("id > low").select(F.col("id").alias("a"), F.col("low").alias("b")).distinct()
    near = written(
        _applied(_with_both(stars, stored, "n", "sketch"), _near, "a bigint, b bigint, distance bigint", similarity), "near"
    )
    nearest = near.groupBy("a").agg(F.min_by("b", F.struct("distance", "b")).alias("b"))
    labels = stored.select("id", F.col("id").alias("root")).distinct()
    labels = _joined(labels, _verified(nearest, stored, similarity))
    labels = _joined(labels, _verified(_across(near, labels).select("a", "b"), stored, similarity))
    # A bucket of two is done. In larger ones, the pairs without the smallest member are open.
    larger = buckets.where("size > 2 AND id > low").select("key", "id")
    # Each component's nearest pairs, twice, join nearly all that belongs together; then the rest is compared.
    for best in (True, True, False):
        rows = larger.join(labels, "id")
        several = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        met = _met(rows.join(several.select("key"), "key")).join(stored.select("id", "n", "sketch"), "id")
        by_group = met.repartition("key", "group").sortWithinPartitions("key", "group", "side", "root", "id")
        pairs = written(_applied(by_group, _foreign, "a bigint, b bigint", similarity, best).distinct(), "pairs")
        if pairs.isEmpty():
            break
        labels = _joined(labels, _verified(pairs, stored, similarity))
    return labels


def _met(rows: DataFrame, block: int | None = None) -> DataFrame:
    """Members ``key, id, root`` in groups of two blocks of one bucket: ``key, group, side, id, root``.

    Blocks hold about ``block`` members. A component of more than that has blocks of its own; the others share some,
    each whole in one. Two blocks of one component never meet, and only a shared block meets itself.
    """
    block = block or BLOCK
    sizes = written(rows.groupBy("key", "root").agg(F.count("*").alias("size")), "sizes")
    small = sizes.where(F.col("size") <= block).groupBy("key").agg(F.ceil(F.sum("size") / block).alias("shared"))
    parts = lambda c, count: F.pmod(F.xxhash64(c), count)
    alone = F.col("size") > block
    dealt = rows.join(sizes, ["key", "root"]).join(small, "key", "left").select(
        "key",
        "id",
        "root",
        F.when(alone, F.col("root")).otherwise(F.lit(-1)).alias("own"),
        F.when(alone, parts("id", F.ceil(F.col("size") / block))).otherwise(parts("root", F.col("shared"))).alias("part"),
    )
    dealt = written(dealt, "dealt")
    blocks = dealt.select("key", "own", "part").distinct()
    a, b = (blocks.select("key", F.struct("own", "part").alias(side)) for side in "ab")
    meet = a.join(b, "key").where("a <= b AND (a.own <> b.own OR a.own = -1)")
    meet = meet.withColumn("group", F.xxhash64("a.own", "a.part", "b.own", "b.part"))
    sides = [meet.select("key", "group", F.lit(0).cast("bigint").alias("side"), "a.own", "a.part")]
    sides.append(meet.where("a < b").select("key", "group", F.lit(1).cast("bigint").alias("side"), "b.own", "b.part"))
    return dealt.join(sides[0].unionByName(sides[1]), ["key", "own", "part"]).select("key", "group", "side", "id", "root")


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose sides are not in one component, with the components as ``a_root`` and ``b_root``."""
    for side in "ab":
        own = labels.select(F.col("id").alias(side), F.col("root").alias(f"{side}_root"))
        pairs = pairs.join(own, side)
    return pairs.where("a_root <> b_root")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after components with a link between them have become one."""
    edges = _across(links, labels).select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
    tops = components(edges).select(F.col("id").alias("root"), F.col("root").alias("top"))
    return written(labels.join(tops, "root", "left").select("id", F.coalesce("top", "root").alias("root")), "labels")
