from datetime import datetime

from pyspark.sql import functions as F

from talklake.functions.markdown import GENERATOR
from talklake.operators import documents as docs
from talklake.plans.push import push
from talklake.plans.validate import validate
from talklake.schemas import CHANNELS
from talklake.session import scratch_path
from talklake.sources import documents as files
from talklake.sources.store import Store

AS_OF = datetime(2026, 3, 2, 4, 5, 6)
MARK = "array<struct<timestamp:string,title:string,start_seconds:double>>"


def videos(spark):
    rows = [
        (1, "abc123", "What is 50% {title}?", "IBM Technology", 600, ["kubernetes", "pods"], [("0:00", "Intro", 0.0), ("5:00", "Rest", 300.0)], "Some {text}\n100%"),
        (2, "x", "Y", "Z!", 0, [], [], ""),
    ]
    schema = f"number long, video_id string, title string, channel string, duration_seconds long, topics array<string>, chapter_marks {MARK}, transcript string"
    return spark.createDataFrame(rows, schema).withColumns(
        {"published": F.lit("2026-03-01").cast("timestamp_ntz"), "url": F.concat(F.lit("https://e.org/"), "video_id")}
    )


FIRST = f"""# TRANSCRIPT-001: What is 50% {{title}}?

## Status: Raw Transcript
## Date: 2026-03-02

## Source

- **Channel:** IBM Technology
- **Published:** 2026-03-01
- **Duration:** 10m 0s
- **Video URL:** https://e.org/abc123
- **Video ID:** `abc123`
- **Batch ID:** `batch-test`

---

## Topics Detected

- kubernetes
- pods

---

## Chapter Markers

- **0:00** — Intro
- **5:00** — Rest

---

## Transcript

Some {{text}}
100%

---

*Generated by {GENERATOR} on 2026-03-02T04:05:06*
"""


def test_rendered(spark):
    rows = docs.rendered(videos(spark), AS_OF, "batch-test").orderBy("number").collect()
    assert rows[0]["filename"] == "TRANSCRIPT-001-ibm-technology.md" and rows[0]["content"] == FIRST
    assert rows[1]["filename"] == "TRANSCRIPT-002-z.md"
    for part in ("*(No topics detected)*", "*(No chapter markers found)*", "**Duration:** Unknown"):
        assert part in rows[1]["content"]
    named = docs.rendered(videos(spark), AS_OF, prefix="TALK").orderBy("number").first()
    assert named["filename"].startswith("TALK-001-") and named["batch_id"] == "batch-2026-03-02T04-05-06"


def test_files_round_trip(spark):
    rendered = docs.rendered(videos(spark), AS_OF, "batch-test")
    want = {(r["filename"], r["content"]) for r in rendered.collect()}
    plain = scratch_path(spark, "plain")
    assert files.write_plain(rendered, plain) == 2
    assert files.write_plain(rendered, plain) == 2
    assert {tuple(r) for r in files.read_plain(spark, plain).collect()} == want
    assert files.read_plain(spark, plain, "OTHER").count() == 0
    names = [r["filename"] for r in files.by_name(files.read_plain(spark, plain)).collect()]
    assert names == sorted(names)
    table = scratch_path(spark, "table")
    for _ in range(2):
        files.write_table(rendered, table)
    files.write_table(docs.rendered(videos(spark), AS_OF, "batch-next"), table)
    assert spark.read.parquet(table).count() == 4


def test_files_are_opened_once_and_many_by_a_task(spark):
    root, key = scratch_path(spark, "many"), files.OPEN_COST_KEY
    rows = spark.range(2000).select(F.format_string("TRANSCRIPT-%04d-x.md", "id").alias("filename"), F.lit("text").alias("content"))
    assert files.write_plain(rows, root) == 2000
    before = spark.conf.get(key)
    ordered = files.by_name(files.read_plain(spark, root))
    # The sort and its sampling run over a table of a few files, not over 2,000 of them in 63 tasks.
    inputs = ordered.inputFiles()
    assert all(f.endswith(".parquet") for f in inputs) and len(inputs) <= 16
    assert [r["filename"] for r in ordered.collect()] == [f"TRANSCRIPT-{i:04d}-x.md" for i in range(2000)]
    assert spark.conf.get(key) == before


MANIFEST = f"""## Transcript Batch: `batch-test`

Auto-generated by **{GENERATOR}**.

### Files
- `TRANSCRIPT-001-ibm-technology.md`
- `TRANSCRIPT-002-z.md`

---
*Review and merge to add these transcripts to the document corpus.*"""


def body_of(rows):
    text = {r["section"]: r["text"] for r in rows if r["section"] != "file"}
    lines = [r["text"] for r in sorted((r for r in rows if r["section"] == "file"), key=lambda r: r["filename"])]
    return text, text["body_head"] + "\n".join(lines) + text["body_tail"]


def test_manifest(spark):
    rendered = docs.rendered(videos(spark), AS_OF, "batch-test")
    text, body = body_of(docs.manifest(rendered).collect())
    assert text["title"] == "docs(transcripts): batch batch-test"
    assert text["message"] == f"docs(transcripts): add batch batch-test\n\nAuto-generated by {GENERATOR}\nFiles: 2 transcript(s)"
    assert body == MANIFEST


def test_push_lists_every_file_numbered_or_not(spark):
    names = spark.range(1, 2501).select(F.format_string("T-%03d-x.md", "id").alias("filename"))
    odd = spark.createDataFrame([("TRANSCRIPT-notes.md",)], "filename string")
    rows = push(names.unionByName(odd), "b").collect()
    assert len([r for r in rows if r["section"] == "file"]) == 2501
    text, body = body_of(rows)
    assert text["message"].endswith("Files: 2501 transcript(s)") and "- `TRANSCRIPT-notes.md`" in body


def test_validate(spark):
    channels = spark.createDataFrame([(0, "@a", "A", True, None, None, None)], CHANNELS)
    root = scratch_path(spark, "validate")
    lines = [r["line"] for r in validate(spark, channels, root).orderBy("section", "ord").collect()]
    assert lines[:2] == ["  Channels: 1 configured", "    - A (@a) [enabled]"] and "FAILED" in lines[2]
    Store.ensure(spark, root, 8)
    assert validate(spark, channels, root).where("section = 1").first()["line"] == "  Store: OK (8 dimensions)"
