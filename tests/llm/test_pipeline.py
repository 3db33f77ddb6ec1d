import hashlib

import numpy as np
import pytest
import tiktoken

import corpus_pipeline as cp
from talklake.llm import decontaminate as dc, privacy as pv
from talklake.llm.bpe import parse_vocabulary, read_vocabulary
from talklake.llm.common import written
from talklake.llm.queries import tokenizer
from tests.llm.test_op01_ngram_join import brute, shingle_set
from tests.llm.test_op10_privacy_whole import brute as brute_marked


def rows_of(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_stages_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = rows_of(docs)
    for name, stage in cp.STAGES[:-1]:
        after_frame = written(stage(spark, docs, sf_dir), f"test-{name}")
        assert after_frame.columns == docs.columns
        after = rows_of(after_frame)
        if name == "language":
            assert set(after) == {i for i, r in before.items() if r["text"] and any(c.isalpha() for c in r["text"])}
        elif name == "near_duplicates":
            groups = brute([(i, r["text"]) for i, r in before.items()], 5, 80)
            assert set(after) == {i for i, n, least in groups if least is None or least == i}
        elif name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            windows = {w for _, t in items for w in dc.windows(dc.normalised(t))}
            hit = lambda t: any(f" {w} " in f" {' '.join(dc.normalised(t))} " for w in windows)
            assert set(after) == {i for i, r in before.items() if not hit(r["text"])}
        else:
            assert set(after) == set(before)
            marked = brute_marked([(i, r["text"]) for i, r in before.items()])
            for i, r in before.items():
                spans = [dict(zip(("kind", "start", "end"), s)) for s in pv.all_spans(r["text"], marked)]
                assert after[i]["text"] == pv.replaced(r["text"], spans)
                assert not pv.base_spans(after[i]["text"])
        if name != "personal_data":
            assert all(after[i] == before[i] for i in after)
        docs, before = after_frame, after
    path, pattern = tokenizer()
    ranks = parse_vocabulary(read_vocabulary(path))
    encoding = tiktoken.Encoding("test", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    final = rows_of(cp.STAGES[-1][1](spark, docs, sf_dir))
    assert set(final) == set(before)
    for i, r in before.items():
        ids = np.array(encoding.encode_ordinary(r["text"]), "<u4")
        assert final[i]["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()


def test_run_gives_one_row_per_kept_document(spark, sf_dir):
    got = cp.run(spark, sf_dir).collect()
    assert 0 < len(got) == len({r["doc_id"] for r in got})


@pytest.mark.parametrize("text", [None, "", "12"])
def test_rows_without_letters_go(spark, sf_dir, text):
    docs = spark.createDataFrame(
        [(1, text, "en", "s", 1), (2, "good words", None, None, None), (None, "more good words", "en", "s", 3)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    assert sorted(r["text"] for r in cp.identify_language(spark, docs, sf_dir).collect()) == ["good words", "more good words"]
    assert shingle_set("a b") == {("a", "b")}


def test_a_task_has_one_python_worker_at_a_time(spark, sf_dir, plan):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    assert plan(cp.sanitise(spark, docs, sf_dir)).count("MapInArrow") == 1
