"""Removal of repeated byte strings by a locally consistent, prefix-free parse.

Rolling hashes choose triggers: in every window of ``length`` bytes, the string of ``TRIGGER`` bytes with
the least hash, the leftmost of equals. Windows with the same trigger make up a phrase; neighbouring phrases
overlap by ``length - 1`` bytes, so every window lies in exactly one phrase, and equal windows lie in phrases
with equal triggers. The distinct phrases are the dictionary, each document's phrases in order its parse.

Two windows are equal where their suffixes of the dictionary share a prefix of ``length`` bytes. So:

1. A phrase that an earlier document has too is removed as a whole; that is decided by phrase hashes.
2. Of a trigger with several distinct phrases, those that could share a window go on, and the suffixes of
   these dictionary entries are sorted to the depth of ``length`` bytes; a run of equal prefixes belongs to
   the earliest document in it.

This replaces the suffix arrays of dictionary and parse: no suffix array of the parse is built and the corpus is not
put in order. At a depth of ``length`` bytes every window lies in one phrase, so equal prefixes, which meet by hash,
decide the law; the order beyond that depth would be sorted and never used.

Both steps first sum up what a worker has seen, so that a string in all documents is shuffled once per worker
and not once per document. What a worker holds meanwhile is packed and freed column by column, rows leave it in batches
of ``BATCH``, a worker that has ended its task gives its memory back, and no stage has two workers to a task: idle
workers count against an executor's memory like busy ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute
from pyspark.sql import DataFrame, Window, functions as F

from talklake.llm.common import keep_only, slices, text_buffer, text_sizes, trim, without, written
from talklake.llm.rolling import Ranges, sliding_min

LENGTH = 50
TRIGGER = 12
#: Greatest length: a phrase's windows are counted in six bits.
LONGEST = 74
#: Ranges of window places that are told apart when phrases are compared.
SIDES = 4
#: Phrases a worker gathers before it sums them up and passes them on; of windows, half as many.
GATHERED = 1 << 19
#: Rows of a batch that a worker passes on.
BATCH = 1 << 16
_PLACE = np.uint64((1 << 24) - 1)
#: Window starts of one go; the places of triggers must fit into 24 bits.
_PIECE = 1 << 19
#: The id that stands for null: no other is greater.
NO_ID = (1 << 63) - 1


def phrases(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """The phrases of all texts of a buffer: text, first window, number of windows, and hashes.

    The bytes of a window outside its trigger lie before and after it. By how many lie before, windows fall into
    ``SIDES`` ranges. All windows of a range hold the same stretch around the trigger, whose hash is the phrase's
    side; two phrases that share a window agree in the side of its range. A range in which the phrase has no
    window has a hash of the phrase itself. ``trigger`` has 32 bits, each side 16, and ``at`` is the trigger's place
    in the phrase.
    """
    pieces = []
    for begin in range(0, max(1, len(data) - length + 1), _PIECE):
        end = min(len(data), begin + _PIECE + length - 1)
        found = _phrases(data[begin:end], np.clip(offsets, begin, end) - begin, length)
        found["start"] += begin
        pieces.append(found)
    return {name: np.concatenate([p[name] for p in pieces]) for name in pieces[0]}


def _phrases(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    ranges = Ranges(data)
    hashes = ranges.every(TRIGGER)
    if len(hashes) < length - TRIGGER + 1:
        none = np.zeros(0, np.int64)
        found = {n: none for n in ("text", "start", "n", "at")}
        return found | {n: none.astype(np.uint64) for n in ("phrase", "trigger", *(f"side{q}" for q in range(SIDES)))}
    keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    owner = (sliding_min(keys, length - TRIGGER + 1) & _PLACE).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(owner)]
    inside = np.flatnonzero(np.arange(len(owner)) + length <= offsets[1:][text])
    owner, text = owner[inside], text[inside]
    first = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (text[1:] != text[:-1]))) if len(owner) else [])
    start, at, text = inside[first], owner[first], text[first]
    n = np.diff(np.append(first, len(owner)))
    last = start + n - 1
    phrase = ranges.hash(start, last + length)
    found = {"text": text, "start": start, "n": n, "at": at - start, "phrase": phrase, "trigger": hashes[at] >> np.uint64(32)}
    for q, (low, high) in enumerate(side_ranges(length)):
        reached = np.maximum(low, at - last) <= np.minimum(high, at - start)
        side = ranges.hash(np.where(reached, at - low, start), np.where(reached, at + length - high, last + length))
        found[f"side{q}"] = side >> np.uint64(48)
    return found


def side_ranges(length: int) -> list[tuple[int, int]]:
    """How many bytes of a window may lie before its trigger, in ``SIDES`` ranges, ends included."""
    edges = np.linspace(0, length - TRIGGER + 1, SIDES + 1).astype(int)
    return [(int(a), int(b) - 1) for a, b in zip(edges, edges[1:], strict=False)]


def earliest(groups: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each row, the least document of its group."""
    order = np.lexsort((docs, groups))
    groups = groups[order]
    begins = np.concatenate(([True], groups[1:] != groups[:-1])) if len(order) else np.zeros(0, bool)
    least = docs[order][np.flatnonzero(begins)][np.cumsum(begins) - 1]
    out = np.empty_like(docs)
    out[order] = least
    return out


def _merged(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Neighbouring or overlapping ranges of a document as one."""
    order = np.lexsort((start, tag, doc))
    doc, tag, start, end = doc[order], tag[order], start[order], end[order]
    if not len(doc):
        return doc, tag, start, end
    fresh = np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))
    # Ends grow along a document, once lifted above those of the documents before.
    lift = (np.cumsum(fresh) - 1) * (1 << 40)
    reach = np.maximum.accumulate(end + lift)
    begins = np.concatenate(([True], start[1:] + lift[1:] > reach[:-1]))
    at = np.flatnonzero(begins)
    return doc[at], tag[at], start[at], reach[np.append(at[1:], len(doc)) - 1] - lift[at]


def _packed(start: np.ndarray, n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """First byte (47 bits), number of windows and place of the trigger (6 bits each); four bits are left."""
    return (start << 12) | (n << 6) | at


def _unpacked(packed: np.ndarray) -> tuple[np.ndarray, ...]:
    return (packed >> 12) & ((1 << 47) - 1), (packed >> 6) & 63, packed & 63


#: Where the open sides of a phrase are kept in ``at``.
_OPEN = 59
_ROWS = "kind int, key bigint, sides int, phrase bigint, doc bigint, tag bigint, at bigint"
_NAMES = ("kind", "key", "sides", "phrase", "doc", "tag", "at")
_SPAN, _PHRASE = 0, 1


def _rows(kind: int, key, sides, phrase, doc, tag, at) -> Iterator[pa.RecordBatch]:
    """The rows in batches of ``BATCH``: neither side holds a larger one."""
    columns = (key, sides, phrase, doc, tag, at)
    for begin in range(0, len(doc), BATCH):
        part = [np.ascontiguousarray(x[begin : begin + BATCH]) for x in columns]
        kinds = pa.array(np.full(len(part[0]), kind, np.int32))
        arrays = [pa.array(x.view(np.int32 if x.itemsize == 4 else np.int64)) for x in part]
        yield pa.RecordBatch.from_arrays([kinds, *arrays], names=_NAMES)


def _span_batches(doc, tag, start, end) -> Iterator[pa.RecordBatch]:
    """Removed ranges: the key holds the end, ``at`` the start."""
    doc, tag, start, end = _merged(doc, tag, start, end)
    none = np.zeros(len(doc), np.int64)
    yield from _rows(_SPAN, end, none.astype(np.int32), none, doc, tag, _packed(start, none, none))


def _parse(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Phrases of the worker's documents; what an earlier document of the worker has, as removed ranges."""
    gathered: dict[str, list[np.ndarray]] = {n: [] for n in _NAMES[1:]}

    def flush() -> Iterator[pa.RecordBatch]:
        row = _joint(gathered)
        least = earliest(row["phrase"], row["doc"])
        later = row["doc"] > least
        start, n, _ = _unpacked(row["at"][later])
        yield from _span_batches(row["doc"][later], row["tag"][later], start, start + n - 1 + length)
        yield from _rows(_PHRASE, **_where(row, ~later))

    size = 0
    for batch in batches:
        texts = batch.column("text")
        docs, tags = batch.column("doc").to_numpy(), batch.column("tag").to_numpy().astype(np.int64)
        for begin, end in slices(text_sizes(texts)):
            data, offsets = text_buffer(texts.slice(begin, end - begin))
            found = phrases(data, offsets, length)
            text = found["text"]
            key = (found["trigger"] << np.uint64(32)) | (found["side0"] << np.uint64(16)) | found["side1"]
            sides = (found["side2"] << np.uint64(16)) | found["side3"]
            gathered["key"].append(key.view(np.int64))
            gathered["sides"].append(sides.astype(np.uint32).view(np.int32))
            gathered["phrase"].append(found["phrase"].view(np.int64))
            gathered["doc"].append(docs[begin:end][text])
            gathered["tag"].append(tags[begin:end][text])
            gathered["at"].append(_packed(found["start"] - offsets[text], found["n"], found["at"]))
            size += len(text)
            if size >= GATHERED:
                yield from flush()
                size = 0
    yield from flush()


def _joint(parts: dict[str, list[np.ndarray]]) -> dict[str, np.ndarray]:
    """Each column as one array; its parts are dropped before the next column is put together."""
    out = {}
    for name, arrays in parts.items():
        out[name] = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
        arrays.clear()
    return out


def _where(row: dict[str, np.ndarray], chosen: np.ndarray) -> dict[str, np.ndarray]:
    """The chosen rows; ``row`` is emptied, so that no column is held twice."""
    return {name: row.pop(name)[chosen] for name in list(row)}


def _judged(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]):
    """Passes removed ranges on, and returns the columns of the rows still to be judged."""
    parts: dict[str, list[np.ndarray]] = {n: [] for n in names}
    for batch in batches:
        spans = pa.compute.equal(batch.column("kind"), _SPAN)
        if (passed := batch.filter(spans)).num_rows:
            yield passed
        left = batch.select(names).filter(pa.compute.invert(spans))
        for name in names:
            parts[name].append(left.column(name).to_numpy())
    return _joint(parts)


def _shares(trigger: np.ndarray, side: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Whether another phrase with the same trigger agrees in this side."""
    key = (trigger << 16) | side
    order = np.lexsort((phrase, key))
    k, p = key[order], phrase[order]
    same = k[1:] == k[:-1]
    differs = same & (p[1:] != p[:-1])
    group = np.cumsum(np.concatenate(([0], ~same))) if len(k) else np.zeros(0, np.int64)
    mixed_group = np.zeros(group[-1] + 1 if len(group) else 0, bool)
    mixed_group[group[1:][differs]] = True
    out = np.zeros(len(key), bool)
    out[order] = mixed_group[group]
    return out


def _judge(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """All phrases of some triggers: whole removals, and the phrases whose windows must be compared."""
    row = yield from _judged(batches, _NAMES[1:])
    later = row["doc"] > earliest(row["phrase"], row["doc"])
    start, n, _ = _unpacked(row["at"][later])
    yield from _span_batches(row["doc"][later], row["tag"][later], start, start + n - 1 + length)
    row = _where(row, ~later)
    # Phrases of one document alone have no earlier one.
    trigger = row["key"] >> 32 & 0xFFFFFFFF
    several = earliest(trigger, row["doc"]) != -earliest(trigger, -row["doc"])
    row, trigger = _where(row, several), trigger[several]
    open_ = np.zeros(len(trigger), np.int64)
    for q, (column, shift) in enumerate((("key", 16), ("key", 0), ("sides", 16), ("sides", 0))):
        side = (row[column] >> shift).astype(np.int64) & 0xFFFF
        open_ |= _shares(trigger, side, row["phrase"]).astype(np.int64) << q
    row["at"] = row["at"] | (open_ << _OPEN)
    yield from _rows(_PHRASE, **_where(row, open_ > 0))


def _suffixes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Windows of open phrases: dictionary suffixes sorted to depth ``length``, one row per distinct prefix."""
    parts: list[tuple[np.ndarray, ...]] = []
    size = 0
    side_of = np.repeat(np.arange(SIDES), [high - low + 1 for low, high in side_ranges(length)])

    def flush() -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        prefix, value, doc, tag, start = (np.concatenate([p[i] for p in parts]) for i in range(5))
        parts.clear()
        order = np.argsort(prefix, kind="stable")  # the dictionary's suffix array, to the depth that matters
        prefix, value, doc, tag, start = prefix[order], value[order], doc[order], tag[order], start[order]
        run = np.cumsum(np.concatenate(([False], prefix[1:] != prefix[:-1])))
        later = doc > earliest(run, doc)
        yield from _span_batches(doc[later], tag[later], start[later], start[later] + length)
        kept = ~later
        one = np.ones(len(doc), np.int64)
        at = _packed(start, one, one)
        yield from _rows(_PHRASE, value[kept], one.astype(np.int32)[kept], value[kept], doc[kept], tag[kept], at[kept])

    for batch in batches:
        docs, tags = batch.column("doc").to_numpy(), batch.column("tag").to_numpy().astype(np.int64)
        texts = batch.column("text")
        for i, ats in enumerate(batch.column("ats")):
            raw = np.frombuffer(texts[i].as_buffer(), np.uint8)
            start, n, at = _unpacked(np.asarray(ats.values))
            open_ = np.asarray(ats.values) >> _OPEN
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            side = side_of[np.repeat(at, n) - place]
            begins = np.unique((np.repeat(start, n) + place)[(np.repeat(open_, n) >> side) & 1 > 0])
            if not len(begins):
                continue
            windows = np.lib.stride_tricks.sliding_window_view(raw, length)[begins]
            prefix, value = windows.view(f"V{length}").ravel(), _hashes(raw, begins, length)
            m = len(begins)
            parts.append((prefix, value, np.full(m, docs[i]), np.full(m, tags[i]), begins))
            size += m
            if size >= GATHERED // 2:
                yield from flush()
                size = 0
    yield from flush()


def _hashes(raw: np.ndarray, begins: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows at increasing places, a piece of the text at a time."""
    out = []
    for part in np.split(begins, np.flatnonzero(np.diff(begins // _PIECE)) + 1):
        low = part[0]
        out.append(Ranges(raw[low : part[-1] + length]).hash(part - low, part - low + length))
    return np.concatenate(out)


def _resolve(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """All windows of some hashes: those that an earlier document has."""
    row = yield from _judged(batches, ("phrase", "doc", "tag", "at"))
    later = row["doc"] > earliest(row["phrase"], row["doc"])
    start, _, _ = _unpacked(row["at"][later])
    yield from _span_batches(row["doc"][later], row["tag"][later], start, start + length)


def _mapped(df: DataFrame, work, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("rolling")
        yield from work(batches, length)
        trim()

    return df.mapInArrow(run, _ROWS)


def _dealt(rows: DataFrame, key) -> DataFrame:
    """Phrases dealt by ``key``; removed ranges, which need no company, by document and place."""
    return rows.repartition(F.when(F.col("kind") == _SPAN, F.xxhash64("doc", "at")).otherwise(key))


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Maximal removed byte ranges of rows ``(doc, tag, text)``, in order: ``doc, tag, spans``.

    A document's ranges are merged by a window over its rows, and meet in one row only when they are maximal.
    """
    first = _mapped(docs, _parse, length)
    judged = written(_mapped(_dealt(first, F.shiftrightunsigned("key", 32)), _judge, length), "phrases")
    open_ = judged.where(F.col("kind") == _PHRASE).groupBy("doc", "tag").agg(F.collect_list("at").alias("ats"))
    texts = docs.join(open_, ["doc", "tag"])
    windows = _mapped(_dealt(_mapped(texts, _suffixes, length), F.col("phrase")), _resolve, length)
    spans = judged.where(F.col("kind") == _SPAN).unionByName(written(windows, "windows"))
    begin = F.shiftright("at", 12).bitwiseAND(F.lit((1 << 47) - 1))
    ranges = spans.select("doc", "tag", begin.alias("start"), F.col("key").alias("end"))
    before = Window.partitionBy("doc", "tag").orderBy("start", "end")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    # Of a document's first range, nothing comes before.
    marked = ranges.withColumn("fresh", F.when(F.col("start") <= reach, 0).otherwise(1))
    number = F.sum("fresh").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = marked.withColumn("number", number).groupBy("doc", "tag", "number").agg(
        F.min("start").alias("start"), F.max("end").alias("end")
    )
    return merged.groupBy("doc", "tag").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """The columns of ``docs`` with ``removed``: maximal byte ranges, in order, that the law removes.

    The law: each byte covered by a string of ``length`` bytes that also starts in a document with a smaller
    id, judged on the input. Strings never cross documents. Null texts are empty; shorter
    texts keep everything. A null id counts as greater than all others. Rows with equal ids do not remove
    each other's bytes, whether their texts are equal or not. A column of ``docs`` named ``removed`` is replaced.

    The result holds no text twice: use ``kept_bytes`` on text and ranges for what remains.
    """
    if not TRIGGER + SIDES <= length <= LONGEST:
        raise ValueError(f"length must lie between {TRIGGER + SIDES} and {LONGEST}")
    kept = without(docs, "removed")
    # The tag tells rows with equal ids, or without one, and different texts apart.
    doc = F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(NO_ID))
    tag = F.xxhash64(F.col(f"`{text}`"))
    own = kept.select(doc.alias("doc"), tag.alias("tag"), F.col(f"`{text}`").alias("text"))
    found = repeated_ranges(own.where(F.octet_length("text") >= length), length)
    # The user's columns travel as one, so that no name can clash.
    rows = kept.select(F.struct(*(F.col(f"`{c}`") for c in kept.columns)).alias("row"), doc.alias("doc"), tag.alias("tag"))
    joined = rows.join(found, ["doc", "tag"], "left")
    removed = F.coalesce("spans", F.array()).cast("array<struct<start:bigint,end:bigint>>")
    return joined.select("row.*", removed.alias("removed"))


def kept_bytes(text: str | None, removed: list[dict]) -> bytes:
    """The bytes of the text outside the removed ranges."""
    raw, parts, at = (text or "").encode(), [], 0
    for span in removed:
        parts.append(raw[at : span["start"]])
        at = span["end"]
    return b"".join([*parts, raw[at:]])


def report(found: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: bytes, removed bytes and ranges, and the digest of what remains."""
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value, removed in zip(batch.column("text"), batch.column("removed").to_pylist(), strict=True):
                raw = value.as_py() or ""
                kept = kept_bytes(raw, removed)
                lost = sum(s["end"] - s["start"] for s in removed)
                rows.append((len(kept) + lost, lost, len(removed), hashlib.sha256(kept).hexdigest()))
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            columns.append(pa.array([r[3] for r in rows], pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )
        trim()

    own = found.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"), "removed")
    return own.mapInArrow(run, schema)
