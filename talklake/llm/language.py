"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from talklake.llm.common import by_slices, extended, keep_only, slices, text_sizes, without

#: Expected number of training documents per language: a larger corpus is sampled by a hash of the id.
TRAIN_PER_LANGUAGE = 3000
#: Most languages a model may have, the most frequent ones; bounds the broadcast matrix at this many rows of
#: ``BUCKETS`` floats.
MAX_LANGUAGES = 200
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
UNKNOWN = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    """Log probabilities by bucket and language; priors as logarithms."""

    languages: tuple[str, ...]
    prior: np.ndarray
    matrix: np.ndarray


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts and their ``n + 1`` offsets; null is empty."""
    parts = [np.frombuffer((t or "").lower().encode("utf-32-le"), dtype=np.uint32) for t in texts.to_pylist()]
    offsets = np.zeros(len(parts) + 1, np.int64)
    offsets[1:] = np.cumsum([len(p) for p in parts])
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), offsets


def grams(points: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams and the text of each, text by text for each order.

    White space and digits count as one blank each, so an n-gram tells where words begin.
    """
    flat = points.astype(np.uint64)
    flat[(points <= 32) | ((points >= 48) & (points <= 57))] = 32
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ids, of = [], []
    for n in ORDERS:
        if len(flat) < n:
            break
        value = np.full(len(flat) - n + 1, np.uint64(n))
        for k in range(n):
            value = (value * np.uint64(1_000_003)) ^ flat[k : len(flat) - n + 1 + k]
        value *= _MIX
        inside = owner[: len(value)] == owner[n - 1 :]
        ids.append((value >> np.uint64(64 - buckets.bit_length() + 1))[inside].astype(np.int64))
        of.append(owner[: len(value)][inside])
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(ids), np.concatenate(of)


def held_out(doc_id: Column) -> Column:
    """Documents kept from training: the remainder of the id's checksum by four is two."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    per_language: int = TRAIN_PER_LANGUAGE,
    buckets: int = BUCKETS,
) -> Model:
    """Counts of hashed n-grams per language, with add-one smoothing.

    The sample is bounded: of a language with more than ``per_language`` documents, those
    whose id hash is divisible by ``ceil(count / per_language)`` are taken. Only rows with a
    text and a language are used. The counts of a task are summed per
    language and bucket before the shuffle, and the driver receives at most
    ``MAX_LANGUAGES * buckets`` numbers. Of more languages, the most frequent are learned, of equally
    frequent ones the first by name. Without rows to learn from, the model has no language.
    """
    own = docs.select(
        F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{doc_id}`").alias("doc_id")
    )
    counts = own.where("lang is not null").groupBy("lang").count()
    found = sorted(counts.orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect(), key=lambda r: r["lang"])
    languages = tuple(r["lang"] for r in found)
    if not languages:
        return Model((), np.zeros(0), np.zeros((buckets, 0), np.float32))
    step = F.create_map(*(F.lit(x) for r in found for x in (r["lang"], max(1, -(-r["count"] // per_language)))))
    hashed = F.xxhash64(F.lit("train"), "doc_id")
    sample = own.where(F.col("lang").isin(*languages) & F.col("text").isNotNull()).where(
        F.pmod(hashed, step[F.col("lang")]) == 0
    )

    place = {name: i for i, name in enumerate(languages)}

    def count(batches):
        keep_only("")
        total = np.zeros((len(place), buckets), np.int64)
        for batch in batches:
            texts, names = batch.column("text"), np.array([place[x] for x in batch.column("lang").to_pylist()])
            for start, stop in slices(text_sizes(texts)):
                ids, of = grams(*code_points(texts.slice(start, stop - start)), buckets)
                for i in np.unique(names[start:stop]):
                    total[i] += np.bincount(ids[names[start:stop][of] == i], minlength=buckets)
        at, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(bucket, pa.int32()), pa.array(total[at, bucket], pa.int64())],
            names=["at", "bucket", "n"],
        )

    summed = (
        sample.select("text", "lang")
        .mapInArrow(count, "at int, bucket int, n bigint")
        .groupBy("at", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    total = np.zeros((buckets, len(languages)))
    total[summed["bucket"].to_numpy(), summed["at"].to_numpy()] = summed["n"].to_numpy()
    seen = np.array([r["count"] for r in found], float)
    matrix = np.log(total + 1) - np.log(total.sum(0) + buckets)
    return Model(languages, np.log(seen / seen.sum()), matrix.astype(np.float32))


def has_letter(text: Column) -> Column:
    """Whether a text has a letter; what has none, or is null, has no language."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def score_texts(texts: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; the score is the posterior probability of the language."""
    n = len(texts)
    letters = np.array([any(map(str.isalpha, t)) if t else False for t in texts.to_pylist()], dtype=bool)
    names, scores = [UNKNOWN] * n, np.zeros(n)
    if not model.languages or not letters.any():
        return names, scores
    sums = np.zeros((n, len(model.languages)))
    points, offsets = code_points(texts)
    # A very long text is scored in pieces; their sums add up, with the n-grams across the cut.
    for start in range(0, len(points), 1 << 20):
        stop = min(len(points), start + (1 << 20))
        reach = min(len(points), stop + ORDERS[-1] - 1)
        local = np.clip(offsets, start, reach) - start
        ids, of = grams(points[start:reach], local, model.matrix.shape[0])
        if reach > stop:  # n-grams that start in the overlap belong to the next piece
            ids, of = _starting_before(points[start:reach], local, stop - start, model.matrix.shape[0])
        for k in range(len(model.languages)):
            sums[:, k] += np.bincount(of, weights=model.matrix[:, k][ids], minlength=n)
    sums += model.prior
    best = sums.argmax(1)
    chance = np.exp(sums - sums.max(1, keepdims=True))
    top = 1 / chance.sum(1)
    for i in np.flatnonzero(letters):
        names[i], scores[i] = model.languages[best[i]], min(1.0, float(top[i]))
    return names, scores


def _starting_before(points, offsets, stop: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of ``points`` without those that start at ``stop`` or later."""
    ids, of = grams(points, offsets, buckets)
    keep = np.ones(len(ids), bool)
    # Orders follow each other, and within an order the later n-grams come last.
    at = 0
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for n in ORDERS:
        if len(points) < n:
            break
        inside = owner[: len(points) - n + 1] == owner[n - 1 :]
        keep[at : at + inside.sum()] = np.flatnonzero(inside) < stop
        at += int(inside.sum())
    return ids[keep], of[keep]


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The columns of ``docs`` with ``lang_pred`` and ``score``.

    A null text and one without a letter are ``und`` with score 0. Equal scores go to the
    language that comes first by name. The matrix is bounded by ``MAX_LANGUAGES`` and the
    number of buckets, and is broadcast. Columns of ``docs`` with these names are replaced.
    """
    kept = without(docs, "lang_pred", "score")
    schema = extended(kept.schema, "lang_pred string, score double")
    # Plain values: a broadcast object would need its class on the workers.
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.prior, model.matrix))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores = score_texts(batch.column(text), Model(*shared.value))
        more = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
        return pa.RecordBatch.from_arrays([*batch.columns, *more], names=[f.name for f in schema.fields])

    return kept.mapInArrow(by_slices(work, text), schema)
