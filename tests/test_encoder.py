"""Models on batches of like length."""

import numpy as np
from pyspark.sql import functions as F

from talklake.operators import embed, encoder

TEXTS = [None, "", "a", "ab", "the cat sat on the mat", "the cat sat on a mat", "völlig anders: 123", "x" * 5000] + ["word " * n for n in range(1, 60)]


def rows(spark, parts=4):
    return spark.createDataFrame(list(enumerate(TEXTS)), "n int, text string").repartition(parts, "n")


def vectors(spark, model):
    return {r["n"]: r["embedding"] for r in embed.embed(rows(spark), model, "text").collect()}


def test_vectors_do_not_depend_on_the_budget(spark):
    load = encoder.ngram_encoder(16, 512)
    alone = load()
    for budget in (1, 100, 1 << 20):
        found = vectors(spark, encoder.BudgetModel(load, 16, budget))
        for n, text in enumerate(TEXTS):
            if not text:
                assert found[n] is None
            else:
                np.testing.assert_allclose(found[n], alone([text])[0], atol=1e-5)


def test_like_texts_are_near(spark):
    found = vectors(spark, encoder.BudgetModel(encoder.ngram_encoder(64), 64))
    dot = lambda a, b: float(np.dot(found[a], found[b]))
    assert abs(dot(4, 4) - 1) < 1e-5 and dot(4, 5) > 0.5 > dot(4, 6)


def test_batches_keep_the_budget_and_hold_like_lengths(spark):
    def load():
        def model(texts):
            longest = max(map(len, texts))
            return [[len(texts), longest, len(texts) * longest, len(t)] for t in texts]

        return model

    found = {n: v for n, v in vectors(spark, encoder.BudgetModel(load, 4, 300)).items() if v}
    assert all(cost <= 300 or size == 1 for size, _, cost, _ in found.values())
    assert any(size > 1 for size, *_ in found.values())
    assert all(own == len(TEXTS[n]) for n, (_, _, _, own) in found.items())


def test_one_load_per_worker_process(spark):
    def load():
        import os
        import sys
        import types

        own = sys.modules.setdefault("_loads_of_a_test", types.ModuleType("_loads_of_a_test")).__dict__
        own["n"] = own.get("n", 0) + 1
        return lambda texts: [[os.getpid(), own["n"]] for _ in texts]

    model = encoder.BudgetModel(load, 2)
    for _ in range(3):
        found = embed.embed(rows(spark, 16), model, "text").where(F.col("embedding").isNotNull())
        assert {r["n"] for r in found.select(F.col("embedding")[1].cast("int").alias("n")).collect()} == {1}


def test_a_model_of_another_size_is_an_error(spark):
    model = encoder.BudgetModel(lambda: lambda texts: [[1.0] for _ in texts], 2)
    try:
        vectors(spark, model)
    except Exception as error:
        assert "texts of vectors of 2" in str(error)
    else:
        raise AssertionError("no error")
