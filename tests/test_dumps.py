"""Listing dumps as a Python data source, as a table and as a stream."""

import json
import os

import pytest
from pyspark.sql import functions as F

from talklake.session import scratch_path
from talklake.sources import dumps


def lay(root, run, channel, lines, done=True, name="a.json"):
    folder = f"{root}/{run}/channel_id={channel}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as file:
        file.write("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))
    if done:
        open(f"{root}/{run}/_SUCCESS", "w").close()


@pytest.fixture
def root(spark):
    return scratch_path(spark, "dump")


def ids(frame):
    return sorted(r["id"] for r in frame.select("id").collect() if r["id"] is not None)


def test_bad_lines_become_rows(spark, root):
    good = {"id": "x", "title": "Ü", "position": 1, "duration": 5, "extra": [1]}
    bad = ["{", "[]", "null", '{"id": 5}', '{"position": "1"}', '{"position": true}', '{"position": 1e3}', '{"duration": 99999999999999999999}', '{"title": "\\ud800"}', "[" * 5000]
    lay(root, "r1", "%40a%2Fb", [good, "", "  ", *bad, {}])
    lay(root, "r1", "__HIVE_DEFAULT_PARTITION__", [{"id": "n", "position": 2}])
    lay(root, "r1", "c", [{"id": "y", "position": 1}])
    dump = dumps.read_dump(spark, root)
    rows = dump.collect()
    assert sorted(r["bad"] for r in rows if r["bad"] is not None) == sorted(bad)
    assert [r["channel_id"] for r in rows if r["id"] == "x"] == ["@a/b"] and [r["title"] for r in rows if r["id"] == "x"] == ["Ü"]
    assert [r["channel_id"] for r in rows if r["id"] == "n"] == [None]
    assert [r["channel_id"] for r in dumps.failed_channels(dump).collect()] == ["@a/b"]
    assert dumps.entries(dump).count() == 4 and ids(dumps.entries(dump)) == ["n", "x", "y"]


def test_pieces_of_any_size_give_each_line_once(spark, root):
    lines = [{"id": f"v{n}", "title": "t" * (n * 7 % 50), "position": n} for n in range(60)]
    lay(root, "r1", "a", lines)
    lay(root, "r1", "a", [{"id": "w", "title": "long" * 500}], name="b.json")
    lay(root, "r1", "a", [], name="empty.json")
    want = sorted([f"v{n}" for n in range(60)] + ["w"])
    for size in (37, 100, 1 << 20):
        assert ids(dumps.read_dump(spark, root, split_bytes=size)) == want


def test_bounds_are_kept_by_the_reader(spark, root):
    for channel in "abc":
        lay(root, "r1", channel, [{"id": f"{channel}{n}", "position": n or None, "upload_date": f"2026020{n}" if n % 2 else None} for n in range(8)] + ["bad"])
    plain = dumps.read_dump(spark, root).collect()
    cases = [
        ([("position", "<=", 3)], lambda r: r["position"] is not None and r["position"] <= 3),
        ([("channel_id", "=", "b"), ("position", ">", 2)], lambda r: r["channel_id"] == "b" and (r["position"] or 0) > 2),
        ([("channel_id", "in", ["a", "c"]), ("upload_date", ">=", "20260203")], lambda r: r["channel_id"] in "ac" and (r["upload_date"] or "") >= "20260203"),
        ([("position", "<", 2), ("upload_date", "=", "20260201")], lambda r: r["position"] == 1),
    ]
    for bounds, holds in cases:
        got = dumps.read_dump(spark, root, bounds=bounds)
        assert sorted(map(repr, got.collect())) == sorted(repr(r) for r in plain if holds(r)), bounds
    assert dumps.read_dump(spark, root, bounds=[("channel_id", "=", "b")]).rdd.getNumPartitions() == 1
    for wrong in (("title", "=", "x"), ("position", "<>", 1)):
        with pytest.raises(ValueError):
            dumps.read_dump(spark, root, bounds=[wrong])


def test_a_filter_of_one_query_does_not_reach_another(spark, root):
    for channel in "abc":
        lay(root, "r1", channel, [{"id": f"{channel}{n}", "position": n} for n in range(5)])
    dump = dumps.read_dump(spark, root)
    assert dump.where("channel_id = 'b'").count() == 5 and dump.count() == 15
    assert dump.where("position <= 1").union(dump.where("channel_id = 'a'")).count() == 11


def test_unfinished_runs_wait_and_none_is_read_twice(spark, root):
    out, checkpoint = scratch_path(spark, "entries"), scratch_path(spark, "check")

    def go():
        found = []
        query = dumps.stream_dump(spark, root).writeStream.foreachBatch(lambda b, _: found.extend(ids(b)))
        query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return found

    assert go() == [] and dumps.read_dump(spark, root).count() == 0
    lay(root, "r1", "a", [{"id": "x"}])
    assert go() == ["x"] and go() == []
    lay(root, "r2", "a", [{"id": "y"}], done=False)
    lay(root, "r3", "a", [{"id": "z"}])
    assert go() == [] and ids(dumps.read_dump(spark, root)) == ["x"]
    lay(root, "r2", "b", [{"id": "y2"}])
    assert sorted(go()) == ["y", "y2", "z"] and go() == []
    assert out and ids(dumps.read_dump(spark, root)) == ["x", "y", "y2", "z"]


def test_written_runs_are_named(spark, root):
    rows = spark.createDataFrame([("a", "x", 1)], "channel_id string, id string, position long")
    dumps.write_dump(rows, root, "r1")
    assert ids(dumps.read_dump(spark, root)) == ["x"]
    for name in ("", "_r", ".r", "a/b"):
        with pytest.raises(ValueError):
            dumps.write_dump(rows, root, name)
    assert dumps.read_dump(spark, root).where(F.col("channel_id") == "none").count() == 0
