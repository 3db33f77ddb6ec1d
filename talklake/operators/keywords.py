"""Topics of documents."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from talklake.functions.arrays import exploded
from talklake.functions.terms import DOMAIN_STOP_WORDS, is_stop_phrase, words_of_sentences
from talklake.functions.text import has_words
from talklake.functions.topics import CANDIDATES_PER_TOPIC, MIN_WORDS, TOP_K, ranked_terms

# --- fixed values --------------------------------------------------------------------
MAX_DF = 0.95
MANY_SENTENCES = 5
# -------------------------------------------------------------------------------------

#: Texts that a worker takes at once.
TEXTS_AT_ONCE = 64


def topic_names(text: Column, **options) -> Column:
    """The topics of a text, best first."""
    return F.transform(ranked_terms(text, **options), lambda t: t["term"])


def topics(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """Every document with its topics; a short text has none."""
    return docs.withColumn("topics", topic_names(F.col(text), **options))


def topic_scores(docs: DataFrame, key: str = "video_id", text: str = "text", **options) -> DataFrame:
    """One row per document and topic, ``rank`` counting from 1."""
    terms = F.transform(
        ranked_terms(F.col(text), **options), lambda t, i: F.struct((i + 1).alias("rank"), t.alias("t"))
    )
    rows = docs.select(key, exploded(terms).alias("topic")).where("topic is not null")
    return rows.select(key, "topic.rank", "topic.t.term", "topic.t.tf", "topic.t.score")


def _sentence_terms(found: list[list[str]], size: int) -> list[dict]:
    """The weighted terms of a text, from the content words of each of its sentences: its ``size`` most frequent ones."""
    sentences = [[*own, *map(" ".join, zip(own, own[1:]))] for own in found]
    n, total = len(sentences), Counter(chain.from_iterable(sentences))
    df = Counter(chain.from_iterable(map(set, sentences)))
    usual = total if n <= MANY_SENTENCES else [t for t in total if df[t] <= n * MAX_DF]
    # Of equal counts the first by name: the second sort leaves their order.
    frequent = sorted(sorted(usual), key=total.__getitem__, reverse=True)[:size]
    idf = {t: math.log((n + 1) / (df[t] + 1)) + 1 for t in frequent}
    scores = dict.fromkeys(idf, 0.0)
    for own in sentences:
        counts: dict[str, int] = {}
        for term in own:
            if term in idf:
                counts[term] = counts.get(term, 0) + 1
        weights = {t: c * idf[t] for t, c in counts.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        for term, weight in weights.items():
            scores[term] += weight / norm
    return [{"term": t, "score": s} for t, s in scores.items()]


def _weighted(rows: DataFrame, size: int, stop_words: Iterable[str] | None) -> DataFrame:
    """``(key, terms)`` from ``(key, lower)``, texts in lower case; a worker takes a few texts at once."""
    kind = pa.list_(pa.struct([("term", pa.string()), ("score", pa.float64())]))
    words = words_of_sentences(stop_words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(start, TEXTS_AT_ONCE)
                terms = [_sentence_terms(words(lower), size) for lower in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(terms, kind)], names=["key", "terms"])

    schema = StructType([rows.schema["key"], *StructType.fromDDL("terms array<struct<term:string,score:double>>").fields])
    return rows.mapInArrow(work, schema)


def sentence_topic_scores(
    docs: DataFrame,
    key: str = "video_id",
    text: str = "text",
    top_k: int = TOP_K,
    stop_words: Iterable[str] | None = None,
    domain_stop_words: Iterable[str] = DOMAIN_STOP_WORDS,
) -> DataFrame:
    """Topics by TF-IDF over the sentences of each document.

    Sentences end at ``.`` or a line break. Terms in more than 95 % of the sentences
    are dropped when there are more than five sentences. The ``3 * top_k`` most
    frequent terms are weighted by smoothed IDF, scaled to unit length per sentence and
    summed. A text's words are counted in one pass in its worker; nothing is shuffled.
    """
    rows = docs.where(has_words(F.col(text), MIN_WORDS)).select(F.col(key).alias("key"), F.lower(text).alias("lower"))
    scored = F.transform(
        "terms", lambda t: F.struct((-F.round(t["score"], 12)).alias("least"), t["term"].alias("term"))
    )
    kept = F.filter(scored, lambda t: ~is_stop_phrase(t["term"], domain_stop_words))
    placed = F.transform(F.slice(F.sort_array(kept), 1, top_k), lambda t, i: F.struct((i + 1).alias("rank"), t.alias("t")))
    found = _weighted(rows, top_k * CANDIDATES_PER_TOPIC, stop_words)
    named = found.select(F.col("key").alias(key), exploded(placed).alias("topic")).where("topic is not null")
    return named.select(key, "topic.rank", "topic.t.term", (-F.col("topic.t.least")).alias("score"))
