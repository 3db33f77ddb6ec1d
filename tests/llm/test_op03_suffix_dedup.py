import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from talklake.llm import suffix_dedup as sd
from talklake.llm.rolling import Ranges, sliding_min


def brute(rows, length=50):
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            first[s] = min(first.get(s, doc), doc)
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - length + 1):
            if first[raw[p : p + length]] < doc:
                gone[p : p + length] = True
        gone = gone[: len(raw)]
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        starts = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(raw) else 0
        out.append((doc, len(raw), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    letters = "abc é漢 \n" if seed % 2 else "ab"
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [make(n) for n in (49, 50, 51, 60, 130, 400)]
    texts = []
    for _ in range(40):
        parts = [make(rng.randint(0, 90)) if rng.random() < 0.6 else rng.choice(passages) for _ in range(rng.randint(0, 6))]
        texts.append("".join(parts))
    return [*texts, "z" * 500, "z" * 49, "z" * 60, "xy" * 200, "", None, texts[0], texts[1], passages[5] * 3]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(docs, seed):
    rows = [((i * 37) % 101, t) for i, t in enumerate(corpus(seed))]
    frame = docs(rows, removed="x", doc="y", tag="z", spans="w").repartition(4)
    found = sd.deduplicate(frame)
    assert found.columns == ["doc_id", "text", "doc", "tag", "spans", "removed"]
    assert sorted(map(tuple, sd.report(found).collect())) == brute(rows)


def test_rows_with_equal_ids_and_null_ids(docs):
    text, other = "p" * 20 + "q" * 40, "r" * 70
    rows = [(5, text), (5, text), (5, other), (None, other), (None, text + "!"), (9, other)]
    got = sorted((tuple(r) for r in sd.report(sd.deduplicate(docs(rows))).collect()), key=repr)
    removed = sorted(((r[0], r[1], r[2]) for r in got), key=repr)
    assert removed == sorted([(5, 60, 0), (5, 60, 0), (5, 70, 0), (9, 70, 70), (None, 70, 70), (None, 61, 60)], key=repr)


def test_no_rows(docs):
    assert sd.deduplicate(docs([(1, "a")]).where("doc_id > 1")).collect() == []


def test_every_window_lies_in_one_phrase_and_pieces_do_not_matter(monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    offsets = np.array([0, 30, 30, 900, 949, 3000])
    monkeypatch.setattr(sd, "_PIECE", 700)
    found = sd.phrases(data, offsets)
    covered = [s + k for s, n in zip(found["start"], found["n"]) for k in range(n)]
    want = [p for a, b in zip(offsets, offsets[1:]) for p in range(a, b - 49)]
    assert sorted(covered) == want


def test_hashes_depend_on_content_alone():
    data = np.frombuffer(b"abcabcabdabc", np.uint8)
    ranges = Ranges(data)
    starts = np.array([0, 3, 6, 9])
    found = ranges.hash(starts, starts + 3)
    assert found[0] == found[1] == found[3] != found[2]
    assert (ranges.every(3)[starts] == found).all()
    values = np.array([5, 3, 9, 1, 7, 2], np.uint64)
    for width in range(1, 8):
        assert sliding_min(values, width).tolist() == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


def test_many_rows_without_an_id_and_with_one_id(spark):
    """Rows of one id are told apart however many there are: 20,000 null ids and 5,000 equal ones share a passage."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(120))
    make = lambda i: f"{i} " + "".join(rng.choice("klmnop") for _ in range(rng.randint(5, 60))) + passage[: 60 + i % 60] + str(i * 7)
    rows = [(None, make(i)) for i in range(20_000)] + [(7, make(i)) for i in range(20_000, 25_000)] + [(3, "x" + passage[:90])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = sorted((tuple(r) for r in sd.report(sd.deduplicate(frame)).collect()), key=repr)
    assert got == sorted(((None if d == sd.NO_ID else d, *r) for d, *r in brute([(sd.NO_ID if d is None else d, t) for d, t in rows])), key=repr)


def test_clashing_names_in_other_cases(spark):
    rows = spark.createDataFrame([(1, "a" * 80, "r", "d", "s")], "doc_id bigint, text string, Removed string, Doc string, SPANS string")
    found = sd.deduplicate(rows)
    assert found.columns == ["doc_id", "text", "Doc", "SPANS", "removed"]
    assert found.first()["removed"] == []


@pytest.mark.parametrize("power", [10, 12])
def test_hashes_tell_alternating_words_apart(power):
    """Under a polynomial modulo a power of two, such a word and its complement are equal."""
    bits = np.array([bin(i).count("1") & 1 for i in range(1 << power)], np.uint8)
    data = np.concatenate([bits + 97, (1 - bits) + 97])
    n = 1 << power
    ranges = Ranges(data)
    one, two = ranges.hash(np.array([0, n]), np.array([n, 2 * n]))
    assert one != two
    again = Ranges(np.concatenate([np.zeros(1000, np.uint8), data]))
    assert again.hash(np.array([1000]), np.array([1000 + n]))[0] == one
    assert len(np.unique(ranges.every(64))) == len({bytes(data[i : i + 64]) for i in range(2 * n - 63)})


def test_a_stage_has_one_python_worker_to_a_task(docs, plan):
    """Ranges are merged and joined to the texts by Spark; only the digests are Python's."""
    frame = docs([(1, "a" * 80), (2, "a" * 80)])
    assert "MapInArrow" not in plan(sd.deduplicate(frame))
    assert plan(sd.report(sd.deduplicate(frame))).count("MapInArrow") == 1


def peak_and_rows(batches):
    """The most MB that numpy held while ``batches`` ran, and the size of each batch."""
    tracemalloc.start()
    try:
        sizes = [b.num_rows for b in batches]
        return tracemalloc.get_traced_memory()[1] / 1e6, sizes
    finally:
        tracemalloc.stop()


def test_a_worker_holds_few_phrases_and_passes_them_on_in_small_batches():
    rng = np.random.default_rng(4)
    text = rng.integers(97, 123, 24_000_000).astype(np.uint8).tobytes().decode()
    texts = [text[i : i + 4000] for i in range(0, len(text), 4000)]
    n = len(texts)
    batch = pa.RecordBatch.from_pydict({"doc": np.arange(n), "tag": np.arange(n), "text": texts})
    peak, sizes = peak_and_rows(sd._parse(iter([batch]), 50))
    assert sum(sizes) > 1 << 20 and max(sizes) <= 1 << 16
    assert peak < 130


def test_all_phrases_of_a_partition_are_held_once():
    n, step = 1 << 20, 1 << 14
    rng = np.random.default_rng(5)
    # Two phrases of different documents to a trigger, with one side in common.
    key, ids = np.repeat(rng.integers(0, 1 << 47, n // 2) << 16, 2), np.arange(n)
    whole = pa.RecordBatch.from_pydict(
        {
            "kind": np.ones(n, np.int32), "key": key, "sides": rng.integers(0, 1 << 31, n).astype(np.int32),
            "phrase": rng.integers(0, 1 << 62, n), "doc": ids, "tag": ids, "at": sd._packed(ids * 0, ids * 0 + 20, ids * 0 + 19),
        }
    )
    # Each batch has buffers of its own, as from Spark.
    batches = (whole.take(pa.array(np.arange(a, a + step))) for a in range(0, n, step))
    peak, sizes = peak_and_rows(sd._judge(batches, 50))
    assert sum(sizes) == n and max(sizes) <= 1 << 16
    assert peak < 150


def test_ranges_of_a_document_are_merged_across_workers(spark):
    """Ranges that touch, overlap or hold one another become one, and come in order."""
    rng = random.Random(12)
    make = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    parts = [make(k) for k in (50, 60, 200, 55, 90)]
    rows = [(i, f"<{i}>{p}({i})") for i, p in enumerate(parts)]
    rows += [(50, parts[2][20:150]), (60, "k" * 30 + parts[0] + parts[1] + "l" * 80 + parts[2] + parts[2][10:90] + "mn" + parts[4])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    found = {r["doc_id"]: [tuple(s) for s in r["removed"]] for r in sd.deduplicate(frame).collect()}
    text = dict(rows)[60]
    last = text.index(parts[4])
    assert found[60] == [(30, 140), (220, 500), (last, last + 90)]
    assert sorted(map(tuple, sd.report(sd.deduplicate(frame)).collect())) == brute(rows)
