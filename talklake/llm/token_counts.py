"""Token counts per section: whole documents encoded once, tokens attributed by their character spans."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from talklake.llm.bpe import parse_vocabulary, read_vocabulary
from talklake.llm.common import by_slices, extended, without, worker_state

#: What becomes of a token that crosses a boundary: it counts for the section of its first character, for that
#: of its last one, or for the one with most of its characters (the earlier of equals).
RULES = ("first", "last", "most")

SECTIONS = "array<struct<first_char:int,end_char:int,n_tokens:bigint,n_crossing:bigint>>"


class Encoder:
    """A tokenizer and the byte length of each of its tokens."""

    def __init__(self, content: bytes, pattern: str) -> None:
        ranks = parse_vocabulary(content)
        self.encoding = tiktoken.Encoding("sections", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each token; a character cut in two belongs to both."""
        ids = np.asarray(self.encoding.encode_ordinary(text), dtype=np.int64)
        ends = np.cumsum(self.lengths[ids])
        raw = np.frombuffer(text.encode(), np.uint8)
        # Characters that begin at or before each byte.
        begun = np.cumsum((raw & 0xC0) != 0x80)
        return begun[ends - self.lengths[ids]] - 1, begun[ends - 1]


def line_bounds(text: str) -> np.ndarray:
    """Where lines begin, and the end of the text; a line break belongs to the line it ends.

    A break at the very end begins no further line; an empty text has no line.
    """
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    begins = np.concatenate(([0], np.flatnonzero(points == 10) + 1))
    return np.append(begins[begins < len(points)], len(points))


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and those of them that cross a boundary.

    Both sides are ordered, so the interval join is a binary search of the tokens' ends among the boundaries.
    """
    n = len(bounds) - 1
    if not len(starts) or n < 1:
        return np.zeros(max(n, 0), np.int64), np.zeros(max(n, 0), np.int64)
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends - 1, side="right") - 1
    crosses = last > first
    chosen = last if rule == "last" else first.copy()
    if rule == "most":
        for i in np.flatnonzero(crosses):
            cuts = np.concatenate(([starts[i]], bounds[first[i] + 1 : last[i] + 1], [ends[i]]))
            chosen[i] = first[i] + int(np.argmax(np.diff(cuts)))
    return np.bincount(chosen, minlength=n), np.bincount(chosen[crosses], minlength=n)


def token_counts(
    docs: DataFrame, path: str, pattern: str, text: str = "text", bounds: str | None = None, rule: str = "first"
) -> DataFrame:
    """The columns of ``docs`` without the text, with ``n_tokens`` and ``sections``.

    Sections are the lines of the text, or lie between neighbouring numbers of the array column ``bounds``:
    increasing character places from 0 to the text's length. The counts of a text's
    sections add up to its tokens. Tokens outside all bounds are in none.

    A null or empty text has no tokens and, by lines, no sections; null bounds give no sections. Columns of
    ``docs`` named like the results are replaced. Work stays in the row; nothing is shuffled.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    results = ("n_tokens", "sections")
    kept = without(docs, *results)
    out = [f for f in kept.schema.fields if f.name != text]
    schema = extended(type(kept.schema)(out), f"n_tokens bigint, sections {SECTIONS}")
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    section_type = pa.list_(
        pa.struct(
            [
                pa.field("first_char", pa.int32()),
                pa.field("end_char", pa.int32()),
                pa.field("n_tokens", pa.int64()),
                pa.field("n_crossing", pa.int64()),
            ]
        )
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        content = vocabulary.value
        state = worker_state(f"sections {hashlib.sha256(content).hexdigest()} {pattern}")
        if "encoder" not in state:
            state["encoder"] = Encoder(content, pattern)
        given = batch.column(bounds).to_pylist() if bounds else None
        counts, parts = [], []
        for i, value in enumerate(batch.column(text).to_pylist()):
            value = value or ""
            edges = line_bounds(value) if given is None else np.array(given[i] or [0], np.int64)
            starts, ends = state["encoder"].spans(value)
            counts.append(len(starts))
            if given is not None:
                inside = (starts >= edges[0]) & (ends <= edges[-1])
                starts, ends = starts[inside], ends[inside]
            tokens, crossing = attribute(starts, ends, edges, rule)
            parts.append((edges, tokens, crossing))
        offsets = np.concatenate(([0], np.cumsum([len(p[1]) for p in parts]))).astype(np.int32)
        flat = lambda arrays, kind: pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)]).astype(kind))
        fields = [
            flat([p[0][: len(p[1])] for p in parts], np.int32),
            flat([p[0][1 : len(p[1]) + 1] for p in parts], np.int32),
            flat([p[1] for p in parts], np.int64),
            flat([p[2] for p in parts], np.int64),
        ]
        values = pa.StructArray.from_arrays(fields, fields=list(section_type.value_type))
        columns = [batch.column(f.name) for f in out]
        columns += [pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), values)]
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return kept.mapInArrow(by_slices(work, text, state="sections"), schema)


def report(counted: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document: tokens, sections, tokens over a boundary, and the counts of all sections in order."""
    return counted.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        "n_tokens",
        F.size("sections").cast("bigint").alias("n_sections"),
        F.aggregate("sections", F.lit(0).cast("bigint"), lambda a, s: a + s["n_crossing"]).alias("n_crossing"),
        F.array_join(F.transform("sections", lambda s: s["n_tokens"].cast("string")), ",").alias("section_tokens"),
    )
