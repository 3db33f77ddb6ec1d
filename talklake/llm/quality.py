"""Quality rules as a short-circuit cascade, ordered by rejections per cost on a sample."""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from talklake.llm.common import by_slices, extended, without

#: Expected number of documents on which costs and selectivities are measured.
SAMPLE = 400
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")
FIELDS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


@dataclass
class Text:
    """A text and what the rules share about it, computed when first asked for."""

    value: str
    seen: dict = field(default_factory=dict)

    def get(self, name: str):
        if name not in self.seen:
            self.seen[name] = FEATURES[name](self)
        return self.seen[name]


def _lines(text: Text) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [x for x in text.value.split("\n") if WORDS.search(x)]
    return len(lines), len(lines) - len(set(lines))


def _repeats(text: Text) -> int:
    """Words inside three-word windows that the text has twice or more."""
    words = text.get("words")
    runs = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(runs)
    if len(counts) == len(runs):
        return 0
    total, covered = 0, 0
    for i, run in enumerate(runs):
        if counts[run] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


FEATURES: dict[str, Callable[[Text], object]] = {
    "words": lambda t: WORDS.findall(t.value),
    "n_words": lambda t: len(t.get("words")),
    "word_chars": lambda t: sum(map(len, t.get("words"))),
    "n_symbols": lambda t: len(SYMBOLS.findall(t.value)),
    "lines": _lines,
    "n_repeat_words": _repeats,
    "n_digits": lambda t: sum(map(str.isdecimal, t.value)),
}


@dataclass(frozen=True)
class Rule:
    """A document is rejected where ``rejects`` is true of its text."""

    name: str
    rejects: Callable[[Text], bool]


#: Thresholds are set with room for clean texts: short notes, lists, quotations and code remain.
RULES = (
    Rule("few_words", lambda t: t.get("n_words") < 50),
    Rule("repeated_words", lambda t: 100 * t.get("n_repeat_words") > 50 * t.get("n_words")),
    Rule("symbols", lambda t: 10 * t.get("n_symbols") > t.get("word_chars")),
    Rule("repeated_lines", lambda t: t.get("lines")[0] > 3 and 2 * t.get("lines")[1] > t.get("lines")[0]),
    Rule("digits", lambda t: 2 * t.get("n_digits") > t.get("word_chars")),
    Rule("word_length", lambda t: not 2 * t.get("n_words") <= t.get("word_chars") <= 15 * t.get("n_words")),
)


def measure(texts: Sequence[str], rules: Sequence[Rule]) -> list[tuple[str, float, float]]:
    """Of each rule: its name, seconds per text when run alone, and the share of texts it rejects."""
    out = []
    for rule in rules:
        start = time.perf_counter()
        rejected = sum(rule.rejects(Text(t)) for t in texts)
        n = max(1, len(texts))
        out.append((rule.name, (time.perf_counter() - start) / n, rejected / n))
    return out


def cascade_order(measured: Sequence[tuple[str, float, float]]) -> list[str]:
    """Rules by rejections per second, best first; ties by name.

    For independent rules this order has the least expected cost.
    """
    return [m[0] for m in sorted(measured, key=lambda m: (-m[2] / max(m[1], 1e-9), m[0]))]


def estimate(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> list[str]:
    """The order of the rules, measured on about ``sample`` documents chosen by a hash of their texts.

    The sample only decides which rule is asked first, never the verdict. The measuring runs on the
    workers; each gives one row per rule.
    """
    column = F.col(f"`{text}`")
    counted = docs.select(column.alias("text"))
    n = docs.count()
    step = max(1, n // sample)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = measure(texts, rules)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows]),
                    pa.array([r[1] * len(texts) for r in rows], pa.float64()),
                    pa.array([r[2] * len(texts) for r in rows], pa.float64()),
                    pa.array([len(texts)] * len(rows), pa.int64()),
                ],
                names=["name", "cost", "rejected", "n"],
            )

    chosen = counted.where(F.pmod(F.xxhash64("text"), F.lit(step)) == 0)
    rows = (
        chosen.mapInArrow(run, "name string, cost double, rejected double, n bigint")
        .groupBy("name")
        .agg(F.sum("cost").alias("cost"), F.sum("rejected").alias("rejected"), F.sum("n").alias("n"))
        .collect()
    )
    known = {r["name"]: (r["name"], r["cost"] / r["n"], r["rejected"] / r["n"]) for r in rows if r["n"]}
    return cascade_order([known.get(r.name, (r.name, 0.0, 0.0)) for r in rules])


def assess(
    docs: DataFrame,
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    order: Sequence[str] | None = None,
    with_counts: bool = True,
) -> DataFrame:
    """The columns of ``docs`` with ``rejected_by``, ``n_asked`` and, if wanted, the counts.

    Rules are asked in ``order`` (measured by ``estimate`` if not given) until one rejects;
    ``rejected_by`` is its name, null for a kept document, and ``n_asked`` how many were
    asked. What a rule needs of a text is computed once and shared. Which rule is named
    depends on the order; whether one rejects does not.

    A null text counts as empty. Columns of ``docs`` named like the results are replaced.
    """
    ranked = list(order) if order is not None else estimate(docs, text, rules)
    by_name = {r.name: r for r in rules}
    cascade = [by_name[n] for n in ranked]
    more = "rejected_by string, n_asked int" + (f", {FIELDS}" if with_counts else "")
    names = [p.split()[0] for p in more.split(", ")]
    kept = without(docs, *names)
    schema = extended(kept.schema, more)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in names]
        for value in batch.column(text).to_pylist():
            seen, verdict, asked = Text(value or ""), None, 0
            for rule in cascade:
                asked += 1
                if rule.rejects(seen):
                    verdict = rule.name
                    break
            row = [verdict, asked]
            if with_counts:
                row += [seen.get("n_words"), seen.get("word_chars"), seen.get("n_symbols"), seen.get("lines")[1], seen.get("n_repeat_words")]
            for column, x in zip(columns, row, strict=True):
                column.append(x)
        types = [pa.string(), pa.int32(), *[pa.int64()] * (len(names) - 2)]
        more_columns = [pa.array(c, kind) for c, kind in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays([*batch.columns, *more_columns], names=[f.name for f in schema.fields])

    return kept.mapInArrow(by_slices(work, text), schema)


def report(assessed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document: the counts, whether the base rules fail, and the verdict."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return assessed.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("rejected_by").isNull()).alias("kept"),
    )
