"""Columns of the user whose names differ from an operator's own by case alone, or not at all."""

import pytest
from pyspark.sql import functions as F

from talklake.llm import bpe, decontaminate, language, ngram_join, privacy, quality, reshard, suffix_dedup, token_counts
from talklake.llm.queries import tokenizer

TEXT = "one two three four five six seven eight nine ten eleven twelve, write to a.b@c.de"
ROWS = [(1, TEXT), (2, TEXT), (3, "something else altogether"), (4, None), (None, "")]


def run(work, docs, *names):
    """The operator's rows over documents with columns of these names; columns it does not replace keep their values."""
    plain = docs(ROWS)
    clashing = docs(ROWS, **dict.fromkeys(names, "mine"))
    a, b = work(plain), work(clashing)
    kept = [c for c in b.columns if c in names]
    assert all(r[c] == "mine" for r in b.select(*kept).collect() for c in kept)
    assert len({c.lower() for c in b.columns}) == len(b.columns)
    strip = lambda f: sorted(map(repr, f.select(*(F.col(c) for c in a.columns)).collect()))
    assert strip(b) == strip(a)
    return b


def test_near_duplicates_keep_the_users_columns(docs):
    names = ("__key", "__tag", "__DOC", "Row", "root", "N")
    found = run(lambda d: ngram_join.one_per_group(d), docs, *names)
    assert set(names) <= set(found.columns)
    run(lambda d: ngram_join.link_components(d), docs, "N_shingles", "component_ID")


def test_hits(spark, docs):
    items = spark.createDataFrame([("i", TEXT)], "item_id string, text string")
    for block in (100, 1 << 20):
        run(lambda d: decontaminate.contamination(d, items, block_bytes=block), docs, "Hits", "N_WORDS", "hit_Items")


def test_removed(docs):
    run(lambda d: suffix_dedup.deduplicate(d), docs, "Removed")


def test_tokens(docs):
    run(lambda d: token_counts.token_counts(d, *tokenizer()), docs, "N_tokens", "Sections")
    run(lambda d: bpe.round_trip(d, *tokenizer()), docs, "N_tokens", "IDS_sha256", "Decoded_sha256")


def test_languages(docs):
    model = language.train(docs([(i, t) for i, t in ROWS]).withColumn("lang", F.lit("en")))
    run(lambda d: language.identify(d, model), docs, "Lang_Pred", "SCORE")


def test_rules(docs):
    run(lambda d: quality.assess(d, order=[r.name for r in quality.RULES]), docs, "Rejected_By", "N_asked", "N_words")


def test_spans(docs):
    found = run(lambda d: privacy.personal_data(d), docs, "Spans", "__doc", "__Marks", "term")
    assert {"__doc", "__Marks", "term"} <= set(found.columns) and "Spans" not in found.columns
    assert "Spans" not in privacy.sanitised(found).columns


@pytest.mark.parametrize("name", ["Slot", "SHARD", "Old_shard"])
def test_shards(spark, docs, tmp_path, name):
    path = str(tmp_path / name)
    frame = docs(ROWS, **{name: "mine"}).withColumn("o", F.lit(0))
    assert reshard.move(frame, F.col("o"), 2, 1, path).count() == len(ROWS)
    assert name not in spark.read.parquet(path).columns
