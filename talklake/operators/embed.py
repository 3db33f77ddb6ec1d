"""Vectors for texts.

An embedder has a ``vector_size`` and turns a text column into a vector column; NULL
where the text is empty.

``HashedTerms`` is the built-in default: deterministic and made of Spark expressions,
but *not* semantically equal to a neural sentence model. ``BatchModel`` runs any callable
that encodes lists of texts; the user brings it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from talklake.functions.arrays import let, runs
from talklake.functions.terms import words

# --- fixed values: vector sizes of known models --------------------------------------
VECTOR_SIZES = {
    "all-MiniLM-L6-v2": 384,
    "all-MiniLM-L12-v2": 384,
    "all-mpnet-base-v2": 768,
    "paraphrase-MiniLM-L6-v2": 384,
}
DEFAULT_VECTOR_SIZE = 384
MODEL_BATCH = 32
# -------------------------------------------------------------------------------------


def vector_size(model: str) -> int:
    return VECTOR_SIZES.get(model, DEFAULT_VECTOR_SIZE)


@dataclass(frozen=True)
class HashedTerms:
    """Word counts in ``vector_size`` hash buckets, scaled to unit length."""

    vector_size: int = DEFAULT_VECTOR_SIZE

    def column(self, text: Column) -> Column:
        size = self.vector_size
        place = lambda w: F.pmod(F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint"), F.lit(size))
        # One extra item per bucket makes every bucket a run; it is taken off again.
        places = F.concat(
            F.transform(words(text), place), F.sequence(F.lit(0), F.lit(size - 1)).cast("array<bigint>")
        )
        counts = F.transform(runs(F.sort_array(places)), lambda r: (r["n"] - 1).cast("double"))

        def unit(vector: Column) -> Column:
            norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
            return let(
                norm,
                lambda n: F.when(
                    n > 0, F.transform(vector, lambda x: (x / n).cast("float"))
                ).otherwise(F.transform(vector, lambda x: x.cast("float"))),
            )

        return F.when(F.length(text) > 0, let(counts, unit))


@dataclass(frozen=True)
class BatchModel:
    """A model that encodes lists of texts, run on Arrow batches.

    ``load`` is called in the Python worker before its first batch and should cache.
    """

    load: Callable[[], Callable[[list[str]], list]]
    vector_size: int = DEFAULT_VECTOR_SIZE
    batch: int = MODEL_BATCH

    def column(self, text: Column) -> Column:
        load, batch = self.load, self.batch

        @F.pandas_udf("array<float>")
        def encode(pieces: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for texts in pieces:
                vectors = pd.Series([None] * len(texts), index=texts.index, dtype=object)
                full = texts[texts.notna() & (texts != "")]
                for at in range(0, len(full), batch):
                    some = full.iloc[at : at + batch]
                    for place, vector in zip(some.index, model(some.tolist())):
                        vectors.at[place] = [float(x) for x in vector]
                yield vectors

        return encode(text)


def embed(rows: DataFrame, embedder, text: str = "transcript", name: str = "embedding") -> DataFrame:
    """Attach vectors. Filter first: a Python model is not moved across a join."""
    return rows.withColumn(name, embedder.column(F.col(text)))
