"""Models on batches of like length, loaded once per worker process, and a small encoder to run so.

Everything that workers run is made inside functions, so that they get it by value and need not import this package.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, functions as F

from talklake.operators.embed import DEFAULT_VECTOR_SIZE

#: Characters of a batch, each text counted as long as the batch's longest.
BUDGET = 1 << 16


@dataclass(frozen=True)
class BudgetModel:
    """A model that encodes lists of texts into rows of numbers, asked by batches of a budget.

    The texts of an Arrow batch are sorted by length and cut where texts times the longest would exceed ``budget``,
    which is what a model that pads its input pays; a longer text is a batch of its own. Vectors go back to their
    rows. ``load`` is called once per Python worker process and ``key``; give two models of one key only if they are
    the same. Null and empty texts have a null vector; a model that gives another size than ``vector_size`` is an error.
    """

    load: Callable[[], Callable[[list[str]], object]]
    vector_size: int = DEFAULT_VECTOR_SIZE
    budget: int = BUDGET
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def column(self, text: Column) -> Column:
        load, size, budget, key = self.load, self.vector_size, self.budget, self.key

        @F.arrow_udf("array<float>")
        def encode(pieces: Iterator[pa.Array]) -> Iterator[pa.Array]:
            import sys
            import types

            import numpy as np
            import pyarrow.compute as pc

            kept = sys.modules.setdefault("_talklake_models", types.ModuleType("_talklake_models")).__dict__
            if key not in kept:
                kept[key] = load()
            model = kept[key]
            for texts in pieces:
                lengths = np.asarray(pc.fill_null(pc.utf8_length(texts), 0), np.int64)
                full = lengths > 0
                order = np.flatnonzero(full)
                order = order[np.argsort(lengths[order], kind="stable")]
                row = np.cumsum(full) - 1
                vectors = np.zeros((len(order), size), np.float32)
                start = 0
                while start < len(order):
                    # Lengths rise, so the last text of a batch is its longest, and its cost rises with every text.
                    cost = lengths[order[start : start + budget]]
                    cost = cost * np.arange(1, len(cost) + 1)
                    stop = start + max(1, int(np.searchsorted(cost, budget, side="right")))
                    some = order[start:stop]
                    found = np.asarray(model(texts.take(pa.array(some)).to_pylist()), np.float32)
                    if found.shape != (len(some), size):
                        raise ValueError(f"the model gave {found.shape} for {len(some)} texts of vectors of {size}")
                    vectors[row[some]] = found
                    start = stop
                offsets = np.concatenate([[0], np.cumsum(full)]).astype(np.int32) * size
                yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(vectors.ravel()), mask=pa.array(~full))

        return encode(text)


def ngram_encoder(vector_size: int = DEFAULT_VECTOR_SIZE, buckets: int = 1 << 13, seed: int = 0) -> Callable:
    """A loader for ``BudgetModel``: hashed byte 1- to 4-grams through a seeded network of two layers.

    Damped counts are projected at random, squashed, projected again and scaled to unit length, so texts that share
    many n-grams are near each other. The weights depend on the parameters alone; it was never trained.
    """

    def load():
        import numpy as np

        draw = np.random.default_rng(seed)
        first = draw.standard_normal((buckets, vector_size), dtype=np.float32)
        second = draw.standard_normal((vector_size, vector_size), dtype=np.float32) / np.float32(vector_size**0.5)

        def counts(text: str):
            data = np.frombuffer(text.encode(), np.uint8).astype(np.uint64)
            code, total = np.zeros(len(data), np.uint64), np.zeros(buckets, np.int64)
            for n in range(1, 5):
                if len(data) < n:
                    break
                code = code[: len(data) - n + 1] * np.uint64(1_000_003) + data[n - 1 :] + np.uint64(n)
                mixed = (code ^ (code >> np.uint64(15))) * np.uint64(0x9E3779B97F4A7C15)
                total += np.bincount((mixed >> np.uint64(40)).astype(np.int64) % buckets, minlength=buckets)
            return np.log1p(total).astype(np.float32)

        def encode(texts: list[str]):
            # Counts of many short texts at once would take far more memory than the texts.
            return np.concatenate([some(texts[at : at + 128]) for at in range(0, len(texts), 128)])

        def some(texts: list[str]):
            found = np.stack([counts(t) for t in texts])
            found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
            hidden = np.tanh(found @ first) @ second
            return hidden / np.maximum(np.linalg.norm(hidden, axis=1, keepdims=True), 1e-12)

        return encode

    return load
