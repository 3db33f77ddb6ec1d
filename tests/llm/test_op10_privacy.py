import random
import re

from talklake.llm import privacy as pv


def brute_base(text):
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        double = [d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(double) % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], pv.KINDS.index(s[0])))


def test_base_matches_equal_the_plain_patterns():
    rng = random.Random(1)
    parts = ["a", "b.c", "@", "@x.de", ".", "-", "%", "+1", "192.168.0.1", "1.2.3.4.5.6.7.8", "256.1.1.1", "0255.01.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 123-456 78", "+1", "12", " ", "  ", "é", "٣", "(", ")", "jo@ex-a.co.uk", "\n", "00000000000000"]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert pv.base_spans(text) == brute_base(text), text
    assert pv.base_spans(None) == pv.base_spans("") == []
    assert pv.base_spans("1" * 5000 + "." + "2" * 5000) == []


def test_sanitised_texts_hold_no_base_match(docs):
    rows = [(1, "write to a.b@c.de or +49 30 1234567, from 10.0.0.1"), (2, "nothing here"), (3, None), (4, "4111 1111 1111 1111")]
    clean = pv.sanitised(pv.personal_data(docs(rows)))
    got = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert got == {1: "write to [EMAIL] or [PHONE], from [IP]", 2: "nothing here", 3: None, 4: "[CARD]"}
    assert pv.replaced("abcdefgh", [{"kind": "ip", "start": 1, "end": 4}, {"kind": "card", "start": 3, "end": 6}]) == "a[IP]gh"


def test_no_rows(docs):
    empty = docs([(1, "a")]).where("doc_id > 1")
    assert pv.personal_data(empty).collect() == []
    assert pv.report(pv.personal_data(empty)).collect() == []

