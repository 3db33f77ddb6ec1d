import random
import re

import numpy as np
import pytest

from talklake.llm import ngram_join as nj
from talklake.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, size=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size=4, similarity=85):
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= similarity * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(
        ((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr
    )


def corpus(seed, n_bases=6, copies=25):
    """Bases of several sizes with copies that differ by a few words, so that similarities lie around the limit."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(n_bases):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 8, 15, 31, 33, 64, 120, 300]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 22))):
                kind, at = rng.random(), rng.randrange(len(words))
                if kind < 0.6:
                    words[at] = rng.choice(vocabulary)
                elif kind < 0.8:
                    words.insert(at, rng.choice(vocabulary))
                elif len(words) > 1:
                    del words[at]
            texts.append(rng.choice([" ", "\n", "\t "]).join(words))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(docs, seed):
    texts = corpus(seed)
    random.Random(seed).shuffle(texts)
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)]
    rows += [(5000, None), (5001, ""), (5002, " \n"), (None, texts[0]), (None, "all alone here"), (rows[0][0], rows[0][1]), (rows[0][0], "other words altogether now")]
    got = nj.link_components(docs(rows, key="x", id="y", row="z").repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_one_document_of_each_group_stays(docs):
    rows = [(7, "A b c d e f g h"), (3, "a b c d e f G h"), (9, "x y z"), (9, "x y z"), (4, None), (None, "q r s t"), (5, "q r s t")]
    kept = nj.one_per_group(docs(rows, tag="t", n="n"))
    assert kept.columns == ["doc_id", "text", "tag", "n"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 9]


def test_no_rows(docs):
    empty = docs([(1, "a b")]).where("doc_id > 1")
    assert nj.link_components(empty).collect() == []
    assert nj.one_per_group(empty).collect() == []


def test_linked_sets_list_a_common_block():
    rng = np.random.default_rng(5)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = rng.integers(1, 1 << 62, n, dtype=np.uint64)
        drop = int(rng.integers(0, max(1, n // 8) + 1))
        b = np.concatenate((a[drop:], rng.integers(1, 1 << 62, int(rng.integers(0, max(1, n // 8) + 1)), dtype=np.uint64)))
        common, union = n - drop, n + len(b) - (n - drop)
        if not len(b) or 100 * common < 85 * union:
            continue
        listed = []
        for s in (a, b):
            size, zero = np.array([len(s)]), np.zeros(len(s), np.int64)
            band = nj.band_of(size)
            keys = set(nj.listed_blocks(s, zero, size, band, 85)[0].tolist())
            if nj.largest_partner(size, 85)[0] >= 2 << band[0]:
                keys |= set(nj.listed_blocks(s, zero, size, band + 1, 85)[0].tolist())
            listed.append(keys)
        assert listed[0] & listed[1]


def test_dense_distance_is_a_lower_bound():
    rng = np.random.default_rng(6)
    a = rng.integers(1, 1 << 62, 200, dtype=np.uint64)
    b = np.concatenate((a[15:], rng.integers(1, 1 << 62, 9, dtype=np.uint64)))
    wide, narrow = nj.dense_sketch(a, 4096), nj.dense_sketch(b, 1024)
    distance = int(np.bitwise_count(nj.folded(wide, 1024) ^ narrow).sum())
    assert distance <= 24 and distance % 2 == 0
    assert (nj.folded(wide, 1024) == nj.dense_sketch(a, 1024)).all()


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert {found[i] for i in range(61)} == {0} and {found[i] for i in range(100, 140)} == {100} and 200 not in found


def test_long_alternating_words_are_not_equal(spark):
    """A word of two letters and its complement, which polynomials modulo a power of two cannot tell apart."""
    for power in (10, 12):
        word = "".join("ab"[bin(i).count("1") & 1] for i in range(1 << power))
        rows = [(1, word), (2, word.translate(str.maketrans("ab", "ba")))]
        found = nj.link_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
        assert sorted(tuple(r)[:3] for r in found.select("doc_id", "n_shingles", "component_id").collect()) == [(1, 1, 1), (2, 1, 2)]
