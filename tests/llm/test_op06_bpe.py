import hashlib
import random

import numpy as np
import pytest
import tiktoken

from talklake.llm import bpe
from talklake.llm.queries import op6_bpe, tokenizer


@pytest.fixture(scope="module")
def codec():
    path, pattern = tokenizer()
    return bpe.Codec(bpe.read_vocabulary(path), pattern)


@pytest.fixture(scope="module")
def encoding(codec):
    return tiktoken.Encoding("test", pat_str=tokenizer()[1], mergeable_ranks=codec.ranks, special_tokens={})


def odd_texts():
    alphabet = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u2003", "\u200b", "a", "Bc", "word", "1", "²", "Ⅷ", "一", "é", "e\u0301", "'s", "'ll", "!", "😀", "_", "\x00", "ß", "<|endoftext|>"]
    rng = random.Random(1)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(1500)]


def encoded(codec, texts):
    """Ids and decoded bytes of each text."""
    ids, raw = codec.encode(texts)
    cut = lambda lists: [lists.values[a:b] for a, b in zip(lists.offsets, lists.offsets[1:])]
    return list(zip([x.tolist() for x in cut(ids)], [x.tobytes() for x in cut(raw)], strict=True))


def test_ids_equal_the_library_and_decode(codec, encoding):
    texts = [*odd_texts(), "ab" * 3000 + "é" * 500, " " * 400, "x" * 97]
    for text, (ids, decoded) in zip(texts, encoded(codec, texts), strict=True):
        assert ids == encoding.encode_ordinary(text)
        assert decoded == text.encode()


def test_long_words_equal_the_library(codec, encoding):
    """Words of 90 to 5,000 bytes: chains of one character, of two, and random ones, near and far beyond the switch."""
    rng = random.Random(3)
    words = ["a" * n for n in (95, 96, 97, 98, 1001, 5000)] + ["ab" * 700, "aab" * 400, "=" * 3001, "0" * 2500, "é" * 2000, "哈" * 1500]
    words += ["".join(rng.choice(letters) for _ in range(n)) for letters in ("ab", "etaoinshrdlu", "aeé一二三") for n in (60, 96, 97, 200, 1500)]
    words += ["".join(rng.choice("etaoinshrdlucmfwyp") for _ in range(5000))]
    for word, (ids, decoded) in zip(words, encoded(codec, words), strict=True):
        assert ids == encoding.encode_ordinary(word), word[:40]
        assert decoded == word.encode()


def test_blanks_are_cut_only_where_the_pattern_allows_it(codec):
    """Another pattern, which gives a blank to the word before it: texts are matched whole."""
    path, _ = tokenizer()
    pattern = r"\p{L}+ ?|\p{N}+ ?|[^\s\p{L}\p{N}]+ ?|\s+"
    other = bpe.Codec(bpe.read_vocabulary(path), pattern)
    library = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=other.ranks, special_tokens={})
    texts = [*odd_texts()[:300], "warm soil needs time"]
    for text, (ids, _) in zip(texts, encoded(other, texts), strict=True):
        assert ids == library.encode_ordinary(text)


def test_forgetting_words_changes_nothing(codec, encoding, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 60)
    for text in ("some new words here", "and some others", "some new words here"):
        assert encoded(codec, [text])[0][0] == encoding.encode_ordinary(text)
        assert len(codec.known) <= 8


def test_both_recursions_agree(codec):
    rng = random.Random(2)
    raws = [bytes(rng.choice(b"abcdehilnorst ") for _ in range(rng.randint(2, 60))) for _ in range(200)]
    raws = [r for r in raws if r not in codec.ranks] + [b"aaaaaaaaaaaaaaaaaaa", b"abababababab abab"]
    plain, keyed = codec.contract(raws, bpe.CONTRACT, 8), codec.contract(raws, bpe.CONTRACT_KEYED, 32)
    assert [x.tolist() for x in plain] == [x.tolist() for x in keyed]
    assert len(plain[0]) == len(raws) and plain[0].sum() == len(plain[1])


def test_every_token_encodes_to_itself(codec):
    """What lets a step contract all places of a rank: no merge makes a pair of lower rank than its own."""
    raws = [t for t in codec.ranks if len(t) > 1]
    for start in range(0, len(raws), bpe.WORDS_PER_QUERY):
        part = raws[start : start + bpe.WORDS_PER_QUERY]
        sizes, ids = codec.contract(part, bpe.CONTRACT, 8)
        assert set(sizes.tolist()) == {1} and ids.tolist() == [codec.ranks[r] for r in part]


def test_frames_round_trip(docs, encoding):
    texts = odd_texts()[:40]
    rows = [*enumerate(texts), (90, None), (91, ""), (0, texts[0])]
    frame = docs(rows, ids="x", decoded="y", n_tokens="z")
    path, pattern = tokenizer()
    with_ids = bpe.encode(frame, path, pattern)
    assert with_ids.columns == ["doc_id", "text", "decoded", "n_tokens", "ids"]
    for row in bpe.decode(with_ids, path).collect():
        assert row["ids"] == encoding.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
    assert bpe.encode(frame.where("doc_id > 1000"), path, pattern).collect() == []


def test_query_over_the_table(spark, sf_dir, encoding):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = op6_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = np.array(encoding.encode_ordinary(texts[r["doc_id"]]), "<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
