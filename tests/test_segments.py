import random
import re

import pytest
from pyspark.sql import functions as F

from talklake.operators import segments as seg

SCHEMA = "video_id string, seq long, text string"


def expected(texts):
    kept = []
    for raw in texts:
        text = re.sub(r"\[.*?\]", "", re.sub("<[^>]+>", "", (raw or "").strip())).strip()
        if text and (not kept or kept[-1] != text):
            kept.append(text)
    return kept


CASES = {
    "repeat": ["Hello world", "Hello world", "Something new"],
    "tags": ["<font color='#fff'>Hello</font>"],
    "notes": ["[Music]", "Real content", "[Applause]", "Real content"],
    "blank": ["", "  ", None, "[x]"],
    "spaces": ["  Hello   world  ", "  Foo   bar  "],
    "again": ["a", "b", "a", "a", "", "a", "b", "b"],
    "inner": ["a  b", "a b", "a b"],
    "same": ["x"] * 9,
    "gap": ["x", "", "", "", "", "x", "y", "", "", "", "y", "z"],
}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    cases = dict(CASES)
    for i in range(30):
        cases[f"r{i}"] = [rng.choice(["a", "b", "<i>a</i>", " ", "[n]", "b [n]", "c\nd"]) for _ in range(rng.randint(1, 25))]
    data = [(v, s, t) for v, texts in cases.items() for s, t in enumerate(texts)]
    rng.shuffle(data)
    return cases, spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.mark.parametrize("block", [1, 2, 3, 2048])
def test_segments_and_texts(rows, block):
    cases, df = rows
    kept = {}
    for r in seg.clean_segments(df, block).orderBy("video_id", "seq").collect():
        kept.setdefault(r["video_id"], []).append(r["text"])
    texts = {r["video_id"]: r["transcript"] for r in seg.transcripts(df, block).collect()}
    for video, raw in cases.items():
        want = expected(raw)
        assert kept.get(video, []) == want, video
        assert texts.get(video, "") == re.sub(r"\s+", " ", " ".join(want)).strip(), video


def test_no_segments(spark):
    assert seg.transcripts(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_video_is_split(rows, plan):
    _, df = rows
    text = plan(seg.clean_segments(df))
    assert re.search(r"hashpartitioning\(video_id#\d+, block#\d+L", text)


def test_texts_are_shuffled_once(rows):
    _, df = rows
    cleaned = seg.clean_segments(df)
    cleaned.collect()
    final = cleaned._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final


TRACKS = [
    ("v1", "g-en", "en", True),
    ("v1", "m-fr", "fr", False),
    ("v1", "m-en", "en", False),
    ("v2", "g-fr", "fr", True),
    ("v2", "g-en", "en", True),
    ("v3", "m-de", "de", False),
    ("v4", "m-fr", "fr", False),
    ("v4", "g-en", "en", True),
]


@pytest.mark.parametrize(
    "languages, best",
    [
        (["en"], {"v1": "m-en", "v2": "g-en", "v4": "g-en"}),
        (["fr", "en"], {"v1": "m-fr", "v2": "g-fr", "v4": "m-fr"}),
        (["en", "fr", "de"], {"v1": "m-en", "v2": "g-en", "v3": "m-de", "v4": "m-fr"}),
    ],
)
def test_best_track(spark, languages, best):
    tracks = spark.createDataFrame(TRACKS, "video_id string, track_id string, lang string, is_generated boolean")
    assert {r["video_id"]: r["track_id"] for r in seg.best_track(tracks, languages).collect()} == best


def test_chosen_segments(spark):
    tracks = spark.createDataFrame(TRACKS, "video_id string, track_id string, lang string, is_generated boolean")
    segments = tracks.select("video_id", "track_id", F.lit(0).alias("seq"), F.col("track_id").alias("text"))
    rows = seg.transcripts(seg.chosen_segments(segments, seg.best_track(tracks)))
    assert {r["video_id"]: r["transcript"] for r in rows.collect()} == {"v1": "m-en", "v2": "g-en", "v4": "g-en"}


def test_segments_without_a_place_are_told(spark):
    rows = spark.createDataFrame([("a", 1, "x"), (None, 2, "y"), ("a", None, "z")], "video_id string, seq long, text string")
    assert sorted(r["text"] for r in seg.unplaced(rows).collect()) == ["y", "z"]
    assert [r["transcript"] for r in seg.transcripts(rows).collect()] == ["x"]
