import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from talklake.llm import language as lg
from talklake.llm.queries import op7_language


def test_held_out_accuracy(spark, sf_dir):
    """The bound is far above the largest language's share."""
    rows = op7_language(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    own = [r["lang_pred"] == r["lang"] for r in rows if r["held_out"] and r["lang"]]
    assert len(own) > 20 and sum(own) / len(own) > 0.95


def test_model_equals_counting_by_hand(spark):
    rows = [(1, "ab b1", "x"), (2, "Ba", "y"), (3, "bb", "x"), (4, None, "x"), (5, "zz", None)]
    model = lg.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), buckets=64)
    assert model.languages == ("x", "y")
    counts = np.zeros((64, 2))
    for _, text, lang in rows:
        if text and lang:
            ids, _ = lg.grams(*lg.code_points(pa.array([text])), 64)
            np.add.at(counts, (ids, "xy".index(lang)), 1)
    want = np.log(counts + 1) - np.log(counts.sum(0) + 64)
    assert np.allclose(model.matrix, want, atol=1e-6)
    assert np.allclose(np.exp(model.prior), [0.75, 0.25])
    # Lengths: one to three characters, digits and blanks alike.
    assert len(lg.grams(*lg.code_points(pa.array(["ab b1", None, "", "q"])), 64)[0]) == 5 + 4 + 3 + 1


def test_scores_are_posteriors_whatever_the_slices(spark, monkeypatch):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 4)]
    model = lg.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    text = "the hund and der dog " * 3
    (name,), (score,) = lg.score_texts(pa.array([text]), model)
    ids, _ = lg.grams(*lg.code_points(pa.array([text])), lg.BUCKETS)
    sums = [float(model.matrix[ids, k].astype(float).sum() + model.prior[k]) for k in (0, 1)]
    assert name == model.languages[int(np.argmax(sums))]
    assert math.isclose(score, 1 / (1 + math.exp(min(sums) - max(sums))), rel_tol=1e-6)


def test_cut_pieces_hold_each_gram_once():
    points, offsets = lg.code_points(pa.array(["abcdefgh", "", "xyz", "q"]))
    whole = np.zeros((4, 64))
    np.add.at(whole, tuple(reversed(lg.grams(points, offsets, 64))), 1)
    cut = np.zeros((4, 64))
    for start in range(0, len(points), 5):
        stop = min(len(points), start + 5)
        reach = min(len(points), stop + 2)
        local = np.clip(offsets, start, reach) - start
        ids, of = lg.grams(points[start:reach], local, 64) if reach == stop else lg._starting_before(points[start:reach], local, stop - start, 64)
        np.add.at(cut, (of, ids), 1)
    assert (whole == cut).all()


def test_und_nulls_and_no_rows(spark, docs):
    train = spark.createDataFrame([(1, "hello there", "en"), (2, "guten tag", "de")], "doc_id bigint, text string, lang string")
    model = lg.train(train)
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "guten"), (4, "guten"), (None, "hello")]
    found = lg.identify(docs(rows, lang_pred="x", score="y", lang="z"), model)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = [(r["text"], r["lang_pred"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted([(None, "und"), ("", "und"), ("123 !?", "und"), ("guten", "de"), ("guten", "de"), ("hello", "en")], key=repr)
    empty = lg.train(train.where("doc_id > 5"))
    assert empty.languages == ()
    assert lg.identify(docs([(1, "a")]), empty).select("lang_pred").first()[0] == "und"
    assert lg.identify(docs([(1, "a")]).where("doc_id > 1"), model).collect() == []


def test_sample_is_bounded(spark):
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("word").alias("text"), F.lit("en").alias("lang"))
    small = lg.train(many, per_language=100)
    # 13 n-grams a text: the expected sample, not all rows, is behind the counts.
    ids, _ = lg.grams(*lg.code_points(pa.array(["word"])), lg.BUCKETS)
    share = np.exp(small.matrix[ids[0], 0])
    n = (share * lg.BUCKETS - 1) / (1 - share * len(ids))
    assert 30 < n < 250


def test_more_languages_than_a_model_may_have(spark, monkeypatch):
    """The most frequent ones are learned; nothing fails."""
    rows = [(i, f"text {chr(97 + i % 5) * 4}", f"l{i % 250:03}") for i in range(500)] + [(900 + i, "zz yy", "l249") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = lg.train(df)
    assert len(model.languages) == lg.MAX_LANGUAGES and "l249" in model.languages and "l000" in model.languages
    assert lg.identify(df.select("doc_id", "text"), model).count() == len(rows)


def test_letters_decide_what_has_no_language(spark):
    rows = [(1, None), (2, ""), (3, " 12 !"), (4, "é"), (5, "1a"), (6, "一")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("found", lg.has_letter(F.col("text")))
    assert [r["found"] for r in df.orderBy("doc_id").collect()] == [False, False, False, True, True, True]
