import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from talklake.functions.terms import DOMAIN_STOP_WORDS, content_words, english_stop_words, words_of_sentences
from talklake.functions.text import is_blank
from talklake.operators import keywords
from tests.conftest import TALK

LONG = [
    TALK,
    "x " * 9,
    "Go go go. Go home! really just really just really just really just https://a.b/c go",
    "one",
    "",
    "Ünïcode straße naïve café. " * 4,
    "alpha beta. alpha gamma. alpha delta. alpha beta gamma. alpha omega zeta. alpha eta theta. zeta",
]


def tokens(text):
    text = re.sub(r"https?://\S+", "", text.lower())
    return [w for w in re.findall("[a-z]+", text) if len(w) > 1 and w not in english_stop_words()]


def grams(words):
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def is_domain(term):
    return all(w in DOMAIN_STOP_WORDS for w in term.split())


def expected_scores(text, k):
    if len(text.split()) < 10:
        return []
    kept = sorted(Counter(grams(tokens(text))).items(), key=lambda x: (-x[1], x[0]))[: 3 * k]
    norm = math.sqrt(sum(n * n for _, n in kept))
    return [(t, n, n / norm) for t, n in kept if not is_domain(t)][:k]


def expected_sentences(text, k):
    if len(text.split()) < 10:
        return []
    counts = [Counter(grams(tokens(s))) for s in re.split(r"[.\n]", text) if s.strip()]
    n, df, total = len(counts), Counter(), Counter()
    for c in counts:
        df.update(c.keys())
        total.update(c)
    vocabulary = sorted((t for t in df if n <= 5 or df[t] <= n * 0.95), key=lambda t: (-total[t], t))[: 3 * k]
    score = Counter()
    for c in counts:
        weights = {t: c[t] * (math.log((1 + n) / (1 + df[t])) + 1) for t in vocabulary if c[t]}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        for t, w in weights.items():
            score[t] += w / norm
    ranked = sorted((t for t in score if not is_domain(t)), key=lambda t: (-round(score[t], 12), t))
    return [(t, score[t]) for t in ranked[:k]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(LONG)), "video_id int, text string")


@pytest.mark.parametrize("k", [3, 10])
def test_scores(docs, k):
    rows = keywords.topic_scores(docs, top_k=k).orderBy("video_id", "rank").collect()
    for i, text in enumerate(LONG):
        got = [(r["term"], r["tf"], round(r["score"], 9)) for r in rows if r["video_id"] == i]
        assert got == [(t, n, round(s, 9)) for t, n, s in expected_scores(text, k)]


def test_sentence_scores(docs):
    rows = keywords.sentence_topic_scores(docs).orderBy("video_id", "rank").collect()
    for i, text in enumerate(LONG):
        got = [(r["term"], round(r["score"], 6)) for r in rows if r["video_id"] == i]
        assert got == [(t, round(s, 6)) for t, s in expected_sentences(text, 10)]


def test_common_terms_are_cut(docs):
    terms = [r["term"] for r in keywords.sentence_topic_scores(docs.where("video_id = 6")).collect()]
    assert "zeta" in terms
    assert "alpha beta" in terms


def test_topics_of_a_talk(docs):
    first = keywords.topics(docs).where("video_id = 0").first()["topics"]
    again = keywords.topics(docs).where("video_id = 0").first()["topics"]
    assert first == again and 0 < len(first) <= 10
    assert {"tomatoes", "soil", "warm soil"} <= set(first)
    assert not {"like", "just", "really", "know"} & set(first)


def test_short_texts_have_none(docs):
    rows = {r["video_id"]: r["topics"] for r in keywords.topics(docs).collect()}
    assert len(rows) == len(LONG)
    assert rows[1] == rows[3] == rows[4] == []


def test_no_shuffle(docs, plan):
    assert "Exchange" not in plan(keywords.topics(docs))
    assert "Exchange" not in plan(keywords.topic_scores(docs))
    assert "Python" not in plan(keywords.topics(docs))


def test_sentence_words_are_counted_in_one_pass(docs, plan):
    # The nested column functions searched every sentence for every term; words now leave the row's expression for one pass of a worker.
    found = plan(keywords.sentence_topic_scores(docs))
    assert found.count("MapInArrow") == 1 and "array_contains" not in found and "Exchange" not in found


def test_sentence_words_equal_the_columns(spark):
    texts = [*LONG, "See https://a.b/c?d. HTTP://X.y z more Kelvin İstanbul the.  \n　\nI'm x yz_q 9ab"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select(
        "i", F.lower("text").alias("lower"),
        F.transform(
            F.filter(F.split("text", "[.\n]"), lambda s: ~is_blank(s)), lambda s: content_words(s)
        ).alias("words"),
    )
    of = words_of_sentences()
    for r in rows.collect():
        assert of(r["lower"]) == r["words"]


def test_sentence_scores_keep_the_key_and_drop_null_texts(spark):
    rows = spark.createDataFrame([(None, TALK, 1), ("a", None, 2), ("a", TALK, 3)], "`My Key` string, Body string, text int")
    found = keywords.sentence_topic_scores(rows, "My Key", "Body", top_k=2).collect()
    assert sorted(((r["My Key"], r["rank"]) for r in found), key=repr) == [("a", 1), ("a", 2), (None, 1), (None, 2)]
