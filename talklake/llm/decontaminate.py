"""Benchmark decontamination: one Aho-Corasick automaton over normalised items, texts scanned once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from talklake.llm.common import by_slices, extended, without

#: Words of one window.
WINDOW = 10
#: Bytes of item text whose automaton goes to the workers at once; more items take further scans.
BLOCK_BYTES = 8 << 20

SPANS = "array<struct<start:int,end:int,first_char:int,end_char:int>>"


def _table() -> dict[int, str]:
    """ASCII letters in lower case; ASCII other than digits and letters becomes a blank."""
    table = {c: " " for c in range(128) if not chr(c).isalnum()}
    table.update({c: chr(c + 32) for c in range(65, 91)})
    return table


def normalised(text: str | None) -> list[str]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text, A-Z in lower case."""
    return [w for w in text.translate(_table()).split(" ") if w] if text else []


def windows(words: list[str], size: int = WINDOW) -> list[str]:
    """Runs of ``size`` words; all words where there are fewer."""
    if not words:
        return []
    return [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def automaton(items: list[tuple[str, str | None]], size: int = WINDOW):
    """All windows, each between blanks, with its number of words and the places of its items."""
    where: dict[str, set[int]] = {}
    for place, (_, text) in enumerate(items):
        for window in windows(normalised(text), size):
            where.setdefault(window, set()).add(place)
    found = ahocorasick.Automaton()
    for window, places in where.items():
        found.add_word(f" {window} ", (window.count(" ") + 1, tuple(sorted(places))))
    if where:
        found.make_automaton()
    return found if where else None


def _word_offsets(text: str, table: dict[int, str]) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of each word of the original text."""
    flat = text.translate(table)
    blank = np.frombuffer(flat.encode("utf-32-le"), dtype=np.uint32) == 32
    edges = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True]))))
    return edges[0::2], edges[1::2]


def scan(text: str | None, found, table: dict[int, str]) -> tuple[int, list[tuple[int, int]], set[int]]:
    """The number of words, the hit runs of words, and the places of the items found."""
    if not text:
        return 0, [], set()
    words = [w for w in text.translate(table).split(" ") if w]
    if not words or found is None:
        return len(words), [], set()
    line = f" {' '.join(words)} "
    hits, places = [], set()
    for end, (n, items) in found.iter(line):
        hits.append((end, n))
        places.update(items)
    if not hits:
        return len(words), [], set()
    # The blank that ends word i is at ends[i].
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    runs: list[tuple[int, int]] = []
    for stop, n in sorted((int(np.searchsorted(ends, end)) + 1, n) for end, n in hits):
        start = stop - n
        while runs and runs[-1][1] >= start:
            start = min(start, runs.pop()[0])
        runs.append((start, stop))
    return len(words), runs, places


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """The items in blocks of bounded size, in the order of a hash of their ids.

    The number of blocks comes from the table's size, so a benchmark of any size is
    looked for in full, at the cost of one automaton per block.
    """
    total = items.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    n_blocks = 1 + ((total[0] or 0) + 64 * total[1]) // block_bytes
    for block in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block) if n_blocks > 1 else items
        yield [(r[0], r[1]) for r in part.collect()]


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The columns of ``docs`` with ``n_words``, ``hits`` and ``hit_items``.

    ``hits`` are the maximal runs of hit words: word numbers ``start`` to ``end`` and the
    characters of the original text they cover, ends exclusive. ``hit_items`` are the ids of the items found,
    sorted as strings. No row is shuffled: the automaton of a block of items of bounded size
    travels to every task, and further blocks are further passes over the same rows.

    A null or wordless text has no words and no hits; a null or wordless item is never
    found; repeated items count once; an item with a null id is found under the empty id.
    Columns of ``docs`` named like the results are replaced.
    """
    own = items.select(
        F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item_id"),
        F.col(f"`{item_text}`").alias("text"),
    )
    first, out = True, without(docs, "n_words", "hits", "hit_items")
    for block in _blocks(own, block_bytes):
        out = _scanned(out, block, text, window, first)
        first = False
    return out


def _scanned(df: DataFrame, items: list[tuple[str, str | None]], text: str, window: int, first: bool) -> DataFrame:
    schema = extended(df.schema, f"n_words bigint, hits {SPANS}, hit_items array<string>") if first else df.schema
    own_type = pa.list_(
        pa.struct([pa.field(n, pa.int32()) for n in ("start", "end", "first_char", "end_char")])
    )
    state: dict = {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            state["found"], state["table"] = automaton(items, window), _table()
        counts, hits, ids = [], [], []
        before = None if first else (batch.column("hits").to_pylist(), batch.column("hit_items").to_pylist())
        for i, value in enumerate(batch.column(text).to_pylist()):
            n, runs, places = scan(value, state["found"], state["table"])
            names = {items[p][0] for p in places}
            if before:
                runs = _merged([*runs, *((h["start"], h["end"]) for h in before[0][i])])
                names |= set(before[1][i])
            counts.append(n)
            spans = []
            if runs:
                starts, ends = _word_offsets(value, state["table"])
                spans = [
                    {"start": a, "end": b, "first_char": int(starts[a]), "end_char": int(ends[b - 1])} for a, b in runs
                ]
            hits.append(spans)
            ids.append(sorted(names))
        more = [pa.array(counts, pa.int64()), pa.array(hits, own_type), pa.array(ids, pa.list_(pa.string()))]
        old = batch.columns if first else batch.columns[:-3]
        return pa.RecordBatch.from_arrays([*old, *more], names=[f.name for f in schema.fields])

    return df.mapInArrow(by_slices(work, text), schema)


def report(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document: words, hit words, items, the digest of the item ids, and the verdict."""
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda a, h: a + h["end"] - h["start"])
    return found.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def items_digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
