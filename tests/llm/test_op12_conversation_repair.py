import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from talklake.llm import conversation_repair as repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, Audit string, PLACE int"
LEGAL = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain(rows):
    """Dijkstra-free brute force: all states after each row with their least (cost, audit), by sets of prefixes.

    A state is the last kept initial, empty at the start. ``rows``: (initial, truncated, must go, role, text).
    """

    def with_inserts(states):
        best = dict(states)
        for _ in range(4):
            for last, (cost, audit, lines) in list(best.items()):
                role = "assistant" if last == "u" else "user"
                way = cost + 3, audit + "I", lines + [f"{role}:"]
                if role[0] not in best or way < best[role[0]]:
                    best[role[0]] = way
        return best

    states = {"": (0, "", [])}
    for initial, truncated, gone, role, text in rows:
        after = {}

        def offer(last, way):
            if last not in after or way < after[last]:
                after[last] = way

        # Every number of inserted turns is tried, not only the cheapest way to a state.
        for last, (cost, audit, lines) in states.items():
            now = last
            for k in range(4):
                extra = 3 if truncated else 0
                offer(now, (cost + 4, audit + "D", lines))
                if not gone:
                    other = "assistant" if now == "u" else "user"
                    offer(other[0], (cost + 3 + extra, audit + "R", lines + [f"{other}:{text}"]))
                    if (now, initial) in LEGAL:
                        offer(LEGAL[now, initial], (cost + extra, audit + "K", lines + [f"{role}:{text}"]))
                role_in = "assistant" if now == "u" else "user"
                cost, audit, lines, now = cost + 3, audit + "I", lines + [f"{role_in}:"], role_in[0]
        states = after
    ends = [way for last, way in with_inserts(states).items() if last in ("", "a")]
    return min(ends)


def plain_report(rows):
    """Faults, audit and digest of one conversation's sorted rows (turn, role, text)."""
    seen, marked, counts = set(), [], Counter()
    for turn, role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1] not in ".!?":
            fault = "truncated"
        else:
            fault = ""
        seen.add((role, text))
        counts[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        marked.append((initial, fault == "truncated", fault in ("blank", "duplicate"), role, text))
    cost, audit, lines = plain(marked)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def in_order(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest())
    return sorted(rows, key=key)


def reports(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[n] for n in names) for r in df.collect()}


def test_audits_equal_brute_force():
    dice = random.Random(4)
    for _ in range(1500):
        codes = "".join(dice.choice("suaoSUAOxuaua") for _ in range(dice.randrange(12)))
        found, tail = repair.audit(codes)
        rows = [(c.lower(), c.isupper(), c == "x", "r", "t") for c in codes]
        want_cost, want, _ = plain(rows)
        assert "".join(found) + tail == want, codes
        assert sum({"K": 0, "R": 3, "D": 4, "I": 3}[e] for e in want) + sum(3 for c, e in zip(codes, found) if c.isupper() and not e.endswith("D")) == want_cost


def test_blocks_give_the_same_audit():
    dice = random.Random(5)
    for _ in range(300):
        codes = "".join(dice.choice("suaSUAox") for _ in range(1 + dice.randrange(60)))
        parts = [codes[i : i + 7] for i in range(0, len(codes), 7)]
        tables = [repair.combined([repair.ROW_TABLES[c] for c in p]) for p in parts]
        states = [repair.START, *repair.crossings(tables, repair.START, repair.ENDS)]
        pieces = ["".join(repair.edits_between(p, a, b)) for p, a, b in zip(parts, states, states[1:])]
        found, tail = repair.audit(codes)
        assert "".join(pieces) + repair.TAIL[states[-1]] == "".join(found) + tail


def some_rows(dice, conv, n):
    texts = ["Yes.", "no", "", " \t", "Why?", "Go!\n", "a ", "x. y", "é."]
    return [
        (conv, dice.choice([None, i // 2, i, i]), dice.choice(["user", "assistant", "system", "tool", "", None]), dice.choice([*texts, f"{i}.", None]))
        for i in range(n)
    ]


@pytest.mark.parametrize("block", [3, 4096])
def test_report_equals_plain_python(spark, block):
    """Null ids, turns, roles and texts, repeated and equal rows, one conversation with a third of all rows."""
    dice = random.Random(6)
    rows = [r for conv in [*range(40), None] for r in some_rows(dice, conv, dice.randrange(1, 9))] + some_rows(dice, 99, 150)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    want = {conv: plain_report(in_order(own)) for conv, own in groups.items()}
    assert reports(repair.report(df, block=block)) == want


def test_repaired_turns_have_the_structure(spark):
    dice = random.Random(7)
    rows = [r for conv in range(30) for r in some_rows(dice, conv, dice.randrange(1, 12))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = defaultdict(list)
    for r in repair.repaired(df, block=5).collect():
        got[r.conv_id].append((r.seq, r.role, r.text, r.edit))
    digests = {conv: f[-1] for conv, f in reports(repair.report(df)).items()}
    for conv in range(30):
        turns = sorted(got[conv])
        assert [t[0] for t in turns] == list(range(len(turns)))
        assert re.fullmatch("(s?(ua)+)?", "".join(t[1][:1] for t in turns))
        assert hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text, _ in turns).encode()).hexdigest() == digests[conv]


def test_damage_follows_the_checksum(spark):
    rows = [(i, t, r, "A. b! c?") for i in range(60) for t, r in ((0, "user"), (1, "assistant"))] + [(None, None, None, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    want = Counter()
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate, role, text = zlib.crc32(name.encode()) % 20, " " if role is None else role, " " if text is None else text
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            want[conv, turn, "user" if fate == 4 else role, text] += 2 if fate == 3 else 1
    found = repair.damaged(df)
    assert found.columns == ["conv_id", "turn", "role", "text"]
    assert Counter(tuple(r) for r in found.collect()) == want


def test_conversations_without_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", "x", 1), (2, 0, "user", "Hi.", "x", 1)], SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    got = reports(repair.report(df, df.where("conv_id = 1")))
    assert got[2] == (0, 0, 0, 0, 0, 0, "", nothing)
    assert got[1][5:7] == (3, "KI")
    assert repair.report(df.limit(0)).collect() == [] and repair.repaired(df.limit(0)).collect() == []


def test_long_texts_and_many_equal_rows(spark):
    rows = [(1, 0, "user", "x" * 3_000_000 + "."), (1, 1, "assistant", "Fine.")] + [(1, 2, "user", "Again.")] * 5000
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    [found] = repair.report(df.repartition(8), block=100).collect()
    assert (found.duplicate, found.cost, found.audit) == (4999, 4 * 4999 + 3, "KKK" + "D" * 4999 + "I")
