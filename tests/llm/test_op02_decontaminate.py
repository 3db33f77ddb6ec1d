import random
import re

from pyspark.sql import functions as F

from talklake.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    own, hit, ids = words(text), set(), set()
    for name, item in items:
        w = words(item)
        for window in {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else ():
            for i in range(len(own) - len(window) + 1):
                if tuple(own[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    ids.add(str(name))
    return len(own), len(hit), sorted(ids)


def make_items():
    rng = random.Random(4)
    vocabulary = ["alpha", "beta", "über", "x1", "gamma", "漢字", "delta", "7"]
    items = [(f"i{k}", " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 10, 11, 18])))) for k in range(12)]
    return [*items, items[0], ("none", None), ("blank", " .,"), ("i10b", items[3][1])], vocabulary


def test_equals_brute_force_in_one_block_or_many(spark, docs):
    items, vocabulary = make_items()
    rng = random.Random(9)
    texts = []
    for _ in range(60):
        parts = [rng.choice(vocabulary).upper() if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            parts[3:3] = [(items[rng.randrange(12)][1] or "")]
        texts.append(rng.choice([" ", ", ", "\n-- "]).join(parts))
    rows = [*enumerate(texts), (100, None), (101, ""), (102, "?!"), (3, texts[3])]
    table = spark.createDataFrame(items, "item_id string, text string")
    frame = docs(rows, hits="mine", n_words="mine", item_id="mine")
    for block_bytes in (1 << 20, 150):
        found = dc.contamination(frame, table, block_bytes=block_bytes)
        assert found.columns == ["doc_id", "text", "item_id", "n_words", "hits", "hit_items"]
        for row in found.collect():
            n, n_hit, ids = brute(row["text"], items)
            spans = [(h["start"], h["end"]) for h in row["hits"]]
            assert row["n_words"] == n and row["hit_items"] == ids
            assert sum(b - a for a, b in spans) == n_hit
            assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
            for h in row["hits"]:
                piece = row["text"][h["first_char"] : h["end_char"]]
                assert words(piece) == words(row["text"])[h["start"] : h["end"]]
        report = {r["doc_id"]: r for r in dc.report(found).collect()}
        assert report[100]["items_sha256"] == dc.items_digest([]) and not report[100]["contaminated"]


def test_no_items_and_no_rows(spark, docs):
    items = spark.createDataFrame([], "item_id string, text string")
    assert dc.contamination(docs([(1, "a b")]), items).select(F.size("hits")).first()[0] == 0
    assert dc.contamination(docs([(1, "a")]).where("doc_id > 1"), items).collect() == []
