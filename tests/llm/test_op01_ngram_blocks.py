"""Buckets are compared in blocks, and only rows of different components."""

from collections import Counter

import numpy as np
import pytest

from talklake.llm import ngram_join as nj
from tests.llm.test_op01_ngram_join import brute, corpus


def test_a_large_component_meets_only_the_others(spark):
    rows = [(7, i, 1) for i in range(900)] + [(7, 1000 + i, 1000 + i // 2) for i in range(30)] + [(8, 1, 1), (8, 1000, 1000)]
    met = nj._met(spark.createDataFrame(rows, "key bigint, id bigint, root bigint"), 100).collect()
    groups = {}
    for r in sorted(met, key=lambda r: (r["key"], r["group"], r["side"], r["root"], r["id"])):
        groups.setdefault((r["key"], r["group"]), []).append(r)
    pairs = Counter()
    for (key, _), members in groups.items():
        assert len(members) < 300
        side, root = (np.array([m[c] for m in members]) for c in ("side", "root"))
        start, end = nj._partners(np.arange(len(members)) == 0, side, root)
        a, b = nj._inside(start, end, 0, len(members))
        pairs.update((key, *sorted((members[i]["id"], members[j]["id"]))) for i, j in zip(a, b))
    want = {(k, *sorted((i, j))) for k, i, r in rows for l, j, s in rows if k == l and r != s}
    assert set(pairs) == want and set(pairs.values()) == {1}


@pytest.mark.parametrize("block", [3, 40])
def test_components_do_not_depend_on_the_blocks(docs, monkeypatch, block):
    monkeypatch.setattr(nj, "BLOCK", block)
    rows = list(enumerate(corpus(3, 4, 15)))
    got = nj.link_components(docs(rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
