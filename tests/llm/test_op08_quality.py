import re
from collections import Counter

from talklake.llm import quality as q

TEXTS = [
    "one two three four " * 30,
    " ".join(f"word{i}" for i in range(80)),
    " ".join(f"word{i} ###" for i in range(60)),
    "short text",
    "\n".join(["same line here", "other line"] * 4 + [f"line number {i} has words" for i in range(30)]),
    "\n".join(["again and again"] * 30 + [f"w{i}" for i in range(60)]),
    " ".join(str(i) * 5 for i in range(100, 200)),
    "x" * 4000,
    " ".join("abcdefghijklmnopqrstuvwxyz" + str(i) for i in range(60)),
    "a\u00a0b\x1cc \x0b d",
    "\n\n \n",
    "",
    None,
]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {r for r, n in Counter(runs).items() if n > 1}
    repeated = {i + k for i, r in enumerate(runs) if r in twice for k in range(3)}
    lines, seen, dup, n_lines = text.split("\n"), set(), 0, 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            n_lines += 1
            dup += line in seen
            seen.add(line)
    chars, symbols = sum(map(len, words)), sum(c in "#*$%&|<>" for c in text)
    digits = sum(c.isdecimal() for c in text)
    n = len(words)
    base = n < 50 or 100 * len(repeated) > 50 * n
    bad = 10 * symbols > chars or (n_lines > 3 and 2 * dup > n_lines) or 2 * digits > chars or not 2 * n <= chars <= 15 * n
    return n, chars, symbols, dup, len(repeated), base, not base and not bad


def test_counts_and_verdicts_whatever_the_order(docs):
    rows = [*enumerate(TEXTS), (1, TEXTS[1]), (None, TEXTS[1])]
    frame = docs(rows, n_words="x", kept="y", rejected_by="z")
    names = [r.name for r in q.RULES]
    for order in (None, names, names[::-1]):
        found = q.assess(frame, order=order)
        assert found.columns[:3] == ["doc_id", "text", "kept"]
        got = {(r["doc_id"]): tuple(r)[1:] for r in q.report(found).collect()}
        assert got == {i: brute(t) for i, t in rows}
    kept = [i for i, t in enumerate(TEXTS) if brute(t)[-1]]
    assert kept == [1]


def test_cascade_asks_the_best_rule_first_and_stops(docs):
    assert q.cascade_order([("dear", 1.0, 0.9), ("cheap", 0.1, 0.5), ("idle", 0.1, 0.0), ("also idle", 9.0, 0.0)]) == ["cheap", "dear", "also idle", "idle"]
    frame = docs([*enumerate(TEXTS)])
    order = ["symbols", "few_words", "digits", "repeated_words", "repeated_lines", "word_length"]
    rows = {r["doc_id"]: r for r in q.assess(frame, order=order, with_counts=False).collect()}
    assert rows[2]["rejected_by"] == "symbols" and rows[2]["n_asked"] == 1
    assert rows[3]["rejected_by"] == "few_words" and rows[3]["n_asked"] == 2
    assert rows[1]["rejected_by"] is None and rows[1]["n_asked"] == 6


def test_estimate_orders_all_rules_and_stands_no_rows(docs):
    names = sorted(r.name for r in q.RULES)
    frame = docs([(i, t) for i in range(40) for t in TEXTS])
    assert sorted(q.estimate(frame, sample=50)) == names
    empty = docs([(1, "a")]).where("doc_id > 1")
    assert sorted(q.estimate(empty)) == names
    assert q.assess(empty).collect() == []


def test_features_are_computed_once():
    text = q.Text("a b c")
    first = text.get("words")
    text.get("n_words"), text.get("word_chars")
    assert text.get("words") is first
