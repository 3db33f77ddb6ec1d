"""Terms are marked wherever they occur, not only near the entity that they disclose."""

import math
import re

from talklake.llm import privacy as pv
from tests.llm.test_op10_privacy import brute_base

FAR = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def corpus():
    rows = [(i, f"please call the zorbline office at zed@corp.example.com {FAR} room zk42b and quux") for i in range(6)]
    rows += [(10 + i, f"{FAR} then zorbline again, Zorbline and zk42b") for i in range(2)]
    rows += [(100 + i, f"please call the office at one and the room {FAR}") for i in range(60)]
    return rows + [(200, "other@once.example.com rareword"), (201, None), (202, ""), (0, rows[0][1]), (None, "quux")]


def brute(rows):
    """Terms that disclose any entity, counted row by row, whole documents."""
    word = re.compile(r"[^\W_]{3,}")
    n_e, n_et, n_t = {}, {}, {}
    for _, text in rows:
        text = text or ""
        base = brute_base(text)
        terms = {m.group().lower() for m in word.finditer(text) if not any(m.start() < y and x < m.end() for _, x, y in base)}
        for t in terms:
            n_t[t] = n_t.get(t, 0) + 1
        for e in {pv.entity_key(k, text[a:b]) for k, a, b in base}:
            n_e[e] = n_e.get(e, 0) + 1
            for t in terms:
                n_et[e, t] = n_et.get((e, t), 0) + 1
    n = len(rows)
    return {
        t
        for (e, t), c in n_et.items()
        if c >= pv.SUPPORT and math.log2(n * c / (n_e[e] * n_t[t])) >= pv.DISCLOSURE * math.log2(n / n_e[e])
    }


def test_every_occurrence_in_every_document_is_marked(docs):
    rows = corpus()
    want = brute(rows)
    assert {"zorbline", "zk42b", "quux"} <= want and "please" not in want
    got = pv.personal_data(docs(rows, row="x", spans="y", doc="z", term="t"))
    assert got.columns == ["doc_id", "text", "row", "doc", "term", "spans"]
    found = got.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in found), key=repr) == sorted(rows, key=repr)
    for r in found:
        spans = [(s["kind"], s["start"], s["end"]) for s in r["spans"]]
        base = brute_base(r["text"])
        terms = [
            ("term", *m.span())
            for m in re.finditer(r"[^\W_]{3,}", r["text"] or "")
            if m.group().lower() in want and not any(m.start() < y and x < m.end() for _, x, y in base)
        ]
        assert spans == sorted([*base, *terms], key=lambda s: (s[1], pv.KINDS.index(s[0])))
    clean = [r["text"] or "" for r in pv.sanitised(got).collect()]
    assert not any(t in pv.terms_of(text, []) for text in clean for t in want - {"term", "email"})


def test_whole_without_rows_or_entities(docs):
    empty = docs([(1, "a")]).where("doc_id > 1")
    assert pv.personal_data(empty).collect() == []
    assert [r["spans"] for r in pv.personal_data(docs([(1, "no entity here"), (2, None)])).collect()] == [[], []]


def test_words_are_lowered_as_one_by_one():
    texts = ["ΟΔΟΣ Οδός ΟΔΟΣ'α İstanbul ISTANBUL", "Straße ÄÖÜ_abc 12ab x1 éÉé", "Plain_ASCII words_AND 123 ab", "Ελλάδα ελλάδα", "", None]
    for text in texts:
        assert pv.terms_of(text, []) == {w.lower() for w in re.findall(r"[^\W_]{3,}", text or "")}
        for marked in ({"straße"}, {"ascii", "words"}, {"οδος", "οδός"}, {"ist", "istanbul"}):
            want = [("term", *m.span()) for m in re.finditer(r"[^\W_]{3,}", text or "") if m.group().lower() in marked]
            if text:
                assert pv.all_spans(text, marked) == want
    odd = {chr(c) for c in range(0x110000) if len(chr(c).lower()) != 1 or chr(c).isalnum() != chr(c).lower().isalnum()}
    assert odd == {"İ"} and pv.lowered("İ") is pv.lowered("Σ") is None


def test_only_terms_on_the_map_are_counted(docs):
    rows = [(i, f"common word{i} pair{i // 2}") for i in range(6)]
    some = docs(rows).selectExpr("'common' AS term").unionByName(docs(rows).selectExpr("'pair1' AS term"))
    counted = pv.document_frequency(docs(rows), among=pv._map_of(some, "term")).collect()
    assert {(r["term"], r["n"]) for r in counted} == {("common", 6), ("pair1", 2)}


def test_each_text_is_passed_to_the_workers_once_to_be_marked(docs, plan):
    # Texts without marks in one pass; those with marks are told apart and marked after their join.
    assert plan(pv.personal_data(docs(corpus()))).count("MapInArrow") == 3
