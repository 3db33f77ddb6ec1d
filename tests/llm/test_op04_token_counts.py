import random

import numpy as np
import pytest
import tiktoken

from talklake.llm import token_counts as tc
from talklake.llm.bpe import parse_vocabulary, read_vocabulary
from talklake.llm.queries import tokenizer


@pytest.fixture(scope="module")
def encoding():
    path, pattern = tokenizer()
    ranks = parse_vocabulary(read_vocabulary(path))
    return tiktoken.Encoding("test", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def brute(encoding, text, edges, rule):
    """Character spans by decoding every prefix byte by byte."""
    char_of = [i for i, c in enumerate(text) for _ in c.encode()]
    at, counts, crossing = 0, [0] * (len(edges) - 1), [0] * (len(edges) - 1)
    tokens = encoding.encode_ordinary(text)
    for token in tokens:
        size = len(encoding.decode_single_token_bytes(token))
        chars = sorted(set(char_of[at : at + size]))
        at += size
        parts = [sum(a <= c < b for c in chars) for a, b in zip(edges, edges[1:])]
        held = [i for i, n in enumerate(parts) if n]
        chosen = held[0] if rule == "first" else held[-1] if rule == "last" else parts.index(max(parts))
        counts[chosen] += 1
        crossing[chosen] += len(held) > 1
    return len(tokens), counts, crossing


def lines(text):
    edges = [0] + [i + 1 for i, c in enumerate(text) if c == "\n"]
    return [e for e in edges if e < len(text)] + [len(text)]


@pytest.mark.parametrize("rule", tc.RULES)
def test_lines_equal_brute_force(docs, encoding, rule):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a word", " ", "\n", "\n\n", "  \n ", "é漢😀", "12", "!"]) for _ in range(rng.randint(0, 40))) for _ in range(40)]
    rows = [*enumerate(texts), (90, None), (91, ""), (92, "\n"), (0, texts[0])]
    found = tc.token_counts(docs(rows, sections="x", n_tokens="y", extra="z"), *tokenizer(), rule=rule)
    assert found.columns == ["doc_id", "extra", "n_tokens", "sections"]
    by_id = {r["doc_id"]: r for r in found.collect()}
    for i, text in rows:
        edges = lines(text or "") if text else [0]
        n, counts, crossing = brute(encoding, text or "", edges, rule)
        assert by_id[i]["n_tokens"] == n == sum(counts)
        assert [s["n_tokens"] for s in by_id[i]["sections"]] == counts
        assert [s["n_crossing"] for s in by_id[i]["sections"]] == crossing


def test_given_bounds(spark, encoding):
    text = "alpha beta gamma delta"
    rows = [(1, text, [0, 8, 13, len(text)]), (2, text, None), (3, None, [0, 0]), (4, text, [0, 5])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, edges array<int>")
    found = {r["doc_id"]: r for r in tc.token_counts(frame, *tokenizer(), bounds="edges", rule="most").collect()}
    assert [s["n_tokens"] for s in found[1]["sections"]] == brute(encoding, text, rows[0][2], "most")[1]
    assert found[2]["sections"] == [] and found[3]["n_tokens"] == 0
    assert sum(s["n_tokens"] for s in found[4]["sections"]) < found[4]["n_tokens"]


def test_no_rows_and_bad_rule(docs):
    frame = docs([(1, "a")])
    assert tc.token_counts(frame.where("doc_id > 1"), *tokenizer()).collect() == []
    with pytest.raises(ValueError):
        tc.token_counts(frame, *tokenizer(), rule="half")


def test_attribution_by_most_takes_the_earlier_of_equals():
    bounds = np.array([0, 4, 8])
    assert tc.attribute(np.array([2]), np.array([6]), bounds, "most")[0].tolist() == [1, 0]
    assert tc.attribute(np.array([3]), np.array([6]), bounds, "most")[0].tolist() == [0, 1]
