"""The registered queries: each takes a session and a table folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from catalog import tables as t
from talklake.functions import chapters, ids, markdown, text, times
from talklake.functions.arrays import exploded
from talklake.operators import candidates as cand
from talklake.operators import documents as docs
from talklake.operators import embed, encoder, enrich, keywords, quantise, registry, segments as seg, vectors
from talklake.plans.fetch import Landing, fetch
from talklake.plans.push import push
from talklake.plans.search import search
from talklake.plans.validate import validate
from talklake.schemas import STORE
from talklake.session import scratch_path, staged
from talklake.sources import documents as files
from talklake.sources import dumps, landing, published, results
from talklake.sources.store import Store, last_write, points
from talklake.streaming import incremental, numbered

Query = Callable[[SparkSession, str], DataFrame]
EMBED_SIZE = 64
BUCKETS = 64
#: The first second of March 2026, when the first landing of the bounded stream begins.
FIRST_SECOND = 1772323200


def six(value: Column) -> Column:
    return F.round(value, 6)


def joined(values: Column) -> Column:
    return F.array_join(values, "|")


def chapter_text(marks: Column) -> Column:
    line = lambda c: F.concat(
        c["timestamp"], F.lit("~"), c["title"], F.lit("~"), F.round(c["start_seconds"] * 100).cast("bigint").cast("string")
    )
    return joined(F.transform(marks, line))


# --- topics ----------------------------------------------------------------------------


def doc_topics(spark, sf_dir):
    found = keywords.topics(t.wide(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", joined(F.col("topics")).alias("topics"), F.size("topics").cast("bigint").alias("n_topics"))


def topic_scores(spark, sf_dir):
    found = keywords.topic_scores(t.wide(spark, sf_dir, "documents", "doc_id", "text"), "doc_id")
    return found.select(
        "doc_id", F.col("rank").cast("bigint").alias("rank"), "term", F.col("tf").cast("bigint").alias("tf"), six(F.col("score")).alias("score")
    )


def topics_sentence(spark, sf_dir):
    found = keywords.sentence_topic_scores(t.wide(spark, sf_dir, "documents", "doc_id", "text"), "doc_id")
    return found.select("doc_id", F.col("rank").cast("bigint").alias("rank"), "term", six(F.col("score")).alias("score"))


# --- candidates ------------------------------------------------------------------------


def recent(spark, sf_dir):
    return cand.recent_videos(t.listing(spark, sf_dir), t.channels(spark, sf_dir), t.AS_OF)


def recent_per_channel(spark, sf_dir):
    return recent(spark, sf_dir).select(
        "channel_id",
        "position",
        "video_id",
        "title",
        "channel",
        times.iso_text(F.col("published")).alias("published"),
        "url",
        "duration_seconds",
    )


def recent_counts(spark, sf_dir):
    return cand.recent_counts(recent(spark, sf_dir))


def unprocessed(spark, sf_dir):
    found = staged(cand.with_point(recent(spark, sf_dir), BUCKETS), "recent")
    todo = cand.unprocessed(found, cand.with_point(t.stored_ids(spark, sf_dir), BUCKETS))
    return cand.dry_run(cand.first_in_run(todo)).select(F.col("ord").cast("bigint").alias("ord"), "position", "video_id", "line")


def young_orders(spark, sf_dir):
    as_of = datetime(2001, 8, 1, 12)
    age = F.when(F.col("o_orderstatus") == "O", 90).otherwise(30)
    orders = t.table(spark, sf_dir, "orders").where(
        cand.young_enough(F.col("o_orderdate").cast("timestamp_ntz"), as_of, age)
    )
    return orders.select("o_orderkey", "o_orderstatus", times.day_text(F.col("o_orderdate").cast("timestamp_ntz")).alias("day"))


# --- details, tags, tracks, segments ---------------------------------------------------


def videos(spark, sf_dir) -> DataFrame:
    """All listed documents with the order of their channel."""
    order = t.channels(spark, sf_dir).select("ord", "channel_id")
    return cand.parse_listing(t.listing(spark, sf_dir), t.AS_OF).join(order, "channel_id")


def details_fallback(spark, sf_dir):
    listed = cand.parse_listing(t.listing(spark, sf_dir), t.AS_OF)
    found = enrich.with_details(listed, t.details(spark, sf_dir), t.AS_OF)
    return found.select(
        "video_id",
        "title",
        "channel",
        times.day_text(F.col("published")).alias("published"),
        "url",
        "duration_seconds",
        "description",
        F.size("chapters").cast("bigint").alias("n_chapters"),
    )


def video_tags(spark, sf_dir):
    listed = cand.parse_listing(t.listing(spark, sf_dir), t.AS_OF)
    tagged = enrich.with_tags(listed, t.channels(spark, sf_dir))
    return tagged.select("video_id", joined(F.col("metadata_tags")).alias("tags"))


def best_track(spark, sf_dir):
    return seg.best_track(t.tracks(spark, sf_dir), t.LANGUAGES)


def clean_segments(spark, sf_dir):
    return seg.clean_segments(t.lines(spark, sf_dir))


def transcript_text(spark, sf_dir):
    chosen = seg.chosen_segments(t.segments(spark, sf_dir), seg.best_track(t.tracks(spark, sf_dir), t.LANGUAGES))
    return seg.transcripts(chosen)


def conversation_text(spark, sf_dir):
    return seg.transcripts(t.conversation_segments(spark, sf_dir))


def page_text_strip(spark, sf_dir):
    pages = t.wide(spark, sf_dir, "pages", "page_id", "html")
    return pages.select("page_id", text.squeeze(text.strip_tags(F.col("html"))).alias("text"))


# --- chapters --------------------------------------------------------------------------


def chapters_from_text(spark, sf_dir):
    marks = t.descriptions(spark, sf_dir).select("event_id", chapters.from_text(F.col("description")).alias("marks"))
    return marks.select("event_id", chapter_text(F.col("marks")).alias("chapters"))


def chapters_native(spark, sf_dir):
    marks = t.descriptions(spark, sf_dir).select("event_id", chapters.from_native(F.col("chapters")).alias("marks"))
    return marks.select("event_id", chapter_text(F.col("marks")).alias("chapters"))


def chapters_pick(spark, sf_dir):
    pick = chapters.pick(F.col("chapters"), F.col("description"))
    return t.descriptions(spark, sf_dir).select("event_id", pick.alias("marks")).select(
        "event_id", chapter_text(F.col("marks")).alias("chapters")
    )


# --- store -----------------------------------------------------------------------------


def point_ids(spark, sf_dir):
    key = F.col("doc_id").cast("string")
    return t.table(spark, sf_dir, "documents").select(
        "doc_id", ids.point_id(key).alias("point_id"), ids.bucket(ids.point_id(key), 64).cast("bigint").alias("bucket")
    )


def doc_points(
    spark, sf_dir, channels: DataFrame, batch: str, number: Column, order: Column | None = None
) -> DataFrame:
    """Documents as store points with a small vector; texts in German get one of the wrong size."""
    registry_tags = channels.select(F.col("channel_id").alias("source"), "metadata_tags")
    size = F.col("n_chars").cast("float")
    rows = t.table(spark, sf_dir, "documents").join(registry_tags, "source").select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.concat(F.lit("Doc "), "doc_id").alias("title"),
        F.col("source").alias("channel"),
        times.moment(t.AS_OF).alias("published"),
        F.concat(F.lit(cand.WATCH_URL), "doc_id").alias("url"),
        F.col("n_chars").alias("duration_seconds"),
        F.col("text").alias("transcript"),
        F.array("lang").alias("topics"),
        "metadata_tags",
        F.when(F.col("lang") == "de", F.array(size)).otherwise(F.array(size, F.lit(1.0).cast("float"))).alias("embedding"),
        number.cast("bigint").alias("number"),
    )
    return points(rows, t.AS_OF, batch, order)


def store_rows(store: Store) -> DataFrame:
    return store.read().select(
        "point_id",
        "video_id",
        "title",
        "channel",
        times.iso_text(F.col("published_date")).alias("published_date"),
        "url",
        "duration_seconds",
        "transcript_text",
        joined(F.col("topics")).alias("topics"),
        joined(F.col("metadata_tags")).alias("metadata_tags"),
        "transcript_number",
        "batch_id",
        six(F.get("embedding", F.lit(0)).cast("double")).alias("first_value"),
    )


def new_store(spark, label: str, vector_size: int) -> Store:
    return Store.ensure(spark, scratch_path(spark, label), vector_size, buckets=8)


def earlier_points(spark, sf_dir, channels: DataFrame) -> DataFrame:
    stored = t.stored_ids(spark, sf_dir)
    return doc_points(spark, sf_dir, channels, "batch-old", F.lit(1)).join(stored, "video_id", "left_semi")


def store_upsert(spark, sf_dir):
    """Old points, then every document written twice; the later write of the batch stays."""
    store, channels = new_store(spark, "upsert-store", 2), t.channels(spark, sf_dir)
    store.upsert(earlier_points(spark, sf_dir, channels))
    first = doc_points(spark, sf_dir, channels, "batch-new", F.col("doc_id") + 2, F.lit(1))
    again = doc_points(spark, sf_dir, channels, "batch-new", F.col("doc_id") + 3, F.lit(2))
    store.upsert(first.unionByName(again))
    return store_rows(store)


def store_insert(spark, sf_dir):
    """Old points stay as they are; running the insert a second time adds nothing."""
    store, channels = new_store(spark, "insert-store", 2), t.channels(spark, sf_dir)
    store.insert_if_absent(earlier_points(spark, sf_dir, channels))
    new = doc_points(spark, sf_dir, channels, "batch-new", F.col("doc_id") + 2)
    store.insert_if_absent(new)
    store.insert_if_absent(new)
    return store_rows(store)


def last_writes(spark, sf_dir):
    """The last turn of each conversation, as the last write of its key."""
    turns = t.table(spark, sf_dir, "conversations")
    return last_write(turns, "conv_id", "turn").select("conv_id", "turn", "role", "text")


# --- search ----------------------------------------------------------------------------


def label_queries(spark, sf_dir) -> DataFrame:
    """One query vector per label: the mean of its vectors."""
    places = F.posexplode("embedding").alias("place", "x")
    means = (
        t.table(spark, sf_dir, "embeddings")
        .select("label", places)
        .groupBy("label", "place")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    # As many places as a vector has, whatever the number of rows.
    vector = F.transform(F.sort_array(F.collect_list(F.struct("place", "x"))), lambda p: p["x"])
    return means.groupBy("label").agg(vector.alias("embedding")).select(F.col("label").alias("query_id"), "embedding")


def vector_store(spark, sf_dir) -> DataFrame:
    label = F.col("label").cast("string")
    return t.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("video_id"),
        "embedding",
        F.concat(F.lit("Vector "), "vec_id").alias("title"),
        F.concat(F.lit("Label "), label).alias("channel"),
        times.moment(t.AS_OF).alias("published_date"),
        F.concat(F.lit(cand.WATCH_URL), "vec_id").alias("url"),
        F.when(F.col("label") > 0, F.array(label, F.lit("vector"))).alias("topics"),
        "label",
    )


def ranked(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("query_id").cast("bigint").alias("query_id"),
        F.col("rank").cast("bigint").alias("rank"),
        "video_id",
        six(F.col("score")).alias("score"),
    )


def search_topk(spark, sf_dir):
    return ranked(vectors.top_k(vector_store(spark, sf_dir), label_queries(spark, sf_dir)))


def row_queries(spark, sf_dir) -> DataFrame:
    """Every stored vector whose id is divisible by fifty, as a query for its neighbours."""
    rows = t.table(spark, sf_dir, "embeddings").where(F.col("vec_id") % 50 == 0)
    return rows.select(F.col("vec_id").alias("query_id"), "embedding", F.concat(F.lit("Label "), F.col("label").cast("string")).alias("label"))


def indexed_store(spark, sf_dir) -> Store:
    """All vectors in an indexed store: two thirds before the index is made, the rest, and some once more, after."""
    store = Store.ensure(spark, scratch_path(spark, "indexed-store"), 64, buckets=8)
    rows = vector_store(spark, sf_dir).withColumn("metadata_tags", F.array().cast("array<string>"))
    rows = rows.select("*", F.col("published_date").alias("published"), F.lit(0).alias("duration_seconds"), F.lit("").alias("transcript"), F.col("video_id").cast("bigint").alias("number"))
    made = staged(points(rows, t.AS_OF, "batch-index"), "vectors")
    turn = F.col("transcript_number") % 3
    store.upsert(made.where(turn < 2))
    store.build_index()
    store.upsert(made.where(turn == 1))
    store.insert_if_absent(made)
    return store


def without_itself(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` hits other than the query's own row, counted anew."""
    other = found.where(F.col("video_id") != F.col("query_id").cast("string"))
    place = F.row_number().over(W.partitionBy("query_id").orderBy("rank"))
    return other.withColumn("rank", place).where(F.col("rank") <= k)


def search_rows(spark, sf_dir):
    """The five nearest other vectors of every fiftieth, exactly, by a full scan."""
    return ranked(without_itself(vectors.top_k(vector_store(spark, sf_dir), row_queries(spark, sf_dir).drop("label"), 6), 5))


def search_pruned(spark, sf_dir):
    """The same through an index's lists: those that cannot hold a hit are skipped."""
    rows, model = indexed_store(spark, sf_dir).index_rows()
    found, _ = quantise.exact_top_k(rows, row_queries(spark, sf_dir).drop("label"), model, 6)
    return ranked(without_itself(found, 5))


#: Shares of the rows whose lists a query asks. The given vectors have hardly any near neighbours, so much is asked.
INDEX_SHARE, LABEL_SHARE = 0.6, 0.7


def recall_of(found: DataFrame, exact: DataFrame, scored: DataFrame) -> DataFrame:
    """Per query: exact hits, those found, and the share of rows whose codes or vectors were scored."""
    pairs = exact.select("query_id", "video_id").join(found.select("query_id", "video_id", F.lit(1).alias("hit")), ["query_id", "video_id"], "left")
    counts = pairs.groupBy("query_id").agg(F.count("*").alias("exact"), F.count("hit").alias("found"))
    return counts.join(scored, "query_id").select(
        F.col("query_id").cast("bigint").alias("query_id"), "exact", "found", (F.col("found") / F.col("exact")).alias("recall"), six(F.col("scored") / F.col("total")).alias("scored_share")
    )


def search_index(spark, sf_dir):
    """Recall of approximate search over the inverted lists, against the exact search."""
    rows, model = indexed_store(spark, sf_dir).index_rows()
    queries = staged(row_queries(spark, sf_dir).drop("label"), "asked")
    found, scored = quantise.near_lists(rows, queries, model, INDEX_SHARE, 6)
    exact = vectors.top_k(vector_store(spark, sf_dir), queries, 6)
    return recall_of(without_itself(found, 5), without_itself(exact, 5), scored)


def search_index_filtered(spark, sf_dir):
    """The same among the rows of each query's own label, whose counts per list order the lists."""
    rows, model = indexed_store(spark, sf_dir).index_rows()
    queries = staged(row_queries(spark, sf_dir), "asked")
    found, scored = quantise.near_lists(rows, queries, model, LABEL_SHARE, 6, label="label")
    store = vector_store(spark, sf_dir)
    labels = [r["label"] for r in queries.select("label").distinct().collect()]
    parts = [vectors.top_k(store.where(F.col("channel") == x), queries.where(F.col("label") == x).drop("label"), 6) for x in labels]
    exact = parts[0]
    for part in parts[1:]:
        exact = exact.unionByName(part)
    return recall_of(without_itself(found, 5), without_itself(exact, 5), scored)


def search_topk_filtered(spark, sf_dir):
    part = vector_store(spark, sf_dir).where(F.col("channel") != "Label 3")
    return ranked(vectors.top_k(part, label_queries(spark, sf_dir), 7))


def search_hits(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    store, queries = vector_store(spark, sf_dir), label_queries(spark, sf_dir)
    return vectors.hits(vectors.top_k(store, queries), store), queries


def search_json(spark, sf_dir):
    hits, _ = search_hits(spark, sf_dir)
    return results.as_json(hits.withColumn("score", F.round("score", 4))).select(
        F.col("query_id").cast("bigint").alias("query_id"), F.col("rank").cast("bigint").alias("rank"), "json"
    )


def search_text(spark, sf_dir):
    """Hits as text, and the notice for a query that has no vector."""
    store = vector_store(spark, sf_dir)
    empty = spark.range(1).select((F.col("id") - 1).alias("query_id"), F.lit(None).cast("array<double>").alias("embedding"))
    queries = label_queries(spark, sf_dir).unionByName(empty)
    shown = results.as_text(vectors.hits(vectors.top_k(store, queries), store), queries)
    return shown.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("rank").cast("bigint").alias("rank"), "text")


def search_nearest(spark, sf_dir):
    """The five rows nearest to one fixed vector."""
    vector = [((7 * i) % 11 - 5) / 5 for i in range(EMBED_SIZE)]
    found = vectors.nearest(vector_store(spark, sf_dir), vector)
    return found.select("video_id", "title", "channel", six(F.col("score")).alias("score"))


def search_ann_recall(spark, sf_dir):
    """Share of the exact best five that the approximate search finds, and of the rows it scores, per query."""
    planes = vectors.SignPlanes(tables=96, bits=8)
    store = staged(planes.with_keys(vector_store(spark, sf_dir).select("video_id", "embedding")), "keys")
    queries = staged(planes.with_keys(label_queries(spark, sf_dir)), "queries")
    near = vectors.near_top_k(store, queries)
    exact = vectors.top_k(store, queries)
    found = exact.join(near.select("query_id", "video_id", F.lit(1).alias("hit")), ["query_id", "video_id"], "left")
    scored = vectors.sharing_keys(store, queries).groupBy("query_id").agg(F.count("*").alias("scored"))
    recall = found.groupBy("query_id").agg(
        F.count("*").alias("exact"), F.count("hit").alias("found"), (F.count("hit") / F.count("*")).alias("recall")
    )
    share = F.coalesce("scored", F.lit(0)) / F.lit(store.select(F.count("*")).scalar())
    return recall.join(scored, "query_id", "left").select(
        F.col("query_id").cast("bigint").alias("query_id"), "exact", "found", "recall", six(share).alias("scored_share")
    )


def search_ann(spark, sf_dir):
    """The approximate search itself: hits among rows that share a key."""
    planes = vectors.SignPlanes(tables=96, bits=8)
    store = staged(planes.with_keys(vector_store(spark, sf_dir).select("video_id", "embedding")), "keys")
    return ranked(vectors.near_top_k(store, staged(planes.with_keys(label_queries(spark, sf_dir)), "queries")))


def embed_hash(spark, sf_dir):
    docs_in = t.wide(spark, sf_dir, "documents", "doc_id", "text")
    weights = exploded(
        F.transform(embed.HashedTerms(EMBED_SIZE).column(F.col("text")), lambda w, i: F.struct(i.alias("place"), w.alias("weight")))
    )
    return docs_in.select("doc_id", weights.alias("v")).where("v.weight > 0").select(
        "doc_id", F.col("v.place").cast("bigint").alias("place"), six(F.col("v.weight").cast("double")).alias("weight")
    )


def embed_model(spark, sf_dir):
    """A model given as a callable, run on batches of whole texts."""

    def load():
        return lambda texts: [[float(len(t)), float(t.count("\n")), float(len(t.encode()) - len(t))] for t in texts]

    model = embed.BatchModel(load, vector_size=3)
    rows = embed.embed(t.wide(spark, sf_dir, "documents", "doc_id", "text"), model, "text")
    part = lambda i: F.get("embedding", F.lit(i)).cast("bigint")
    return rows.select("doc_id", part(0).alias("chars"), part(1).alias("breaks"), part(2).alias("wide_bytes"))


def embed_ngrams(spark, sf_dir):
    """A seeded n-gram network on whole texts, in batches of like length."""
    model = encoder.BudgetModel(encoder.ngram_encoder(EMBED_SIZE), EMBED_SIZE, key=f"ngrams-{EMBED_SIZE}")
    rows = embed.embed(t.wide(spark, sf_dir, "documents", "doc_id", "text"), model, "text")
    # Rounded so that the sum's order, which depends on the batch, does not show.
    return rows.select("doc_id", F.transform("embedding", lambda x: F.round(x.cast("double"), 4)).alias("embedding"))


def doc_search(spark, sf_dir):
    """Texts as queries against all documents, by the built-in vectors."""
    embedder = embed.HashedTerms(EMBED_SIZE)
    docs_in = t.wide(spark, sf_dir, "documents", "doc_id", "source", "text")
    store = embed.embed(docs_in, embedder, "text").select(
        F.col("doc_id").cast("string").alias("video_id"),
        "embedding",
        F.concat(F.lit("Doc "), "doc_id").alias("title"),
        F.col("source").alias("channel"),
        times.moment(t.AS_OF).alias("published_date"),
        F.concat(F.lit(cand.WATCH_URL), "doc_id").alias("url"),
        F.array("source").alias("topics"),
    )
    texts = t.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    hits = search(staged(store, "vectors"), texts, embedder)
    return hits.select("query_id", F.col("rank").cast("bigint").alias("rank"), "channel", F.round("score", 5).alias("score"), "video_id")


# --- documents -------------------------------------------------------------------------


def document_videos(spark, sf_dir) -> DataFrame:
    """All listed documents, with details, text, topics and chapters, numbered."""
    detailed = enrich.with_details(docs.numbered(videos(spark, sf_dir)), t.details(spark, sf_dir), t.AS_OF)
    texts = t.wide(spark, sf_dir, "documents", "doc_id", "text").select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.col("text").alias("transcript"),
        keywords.topic_names(F.col("text")).alias("topics"),
    )
    complete = enrich.with_text(detailed, texts)
    return complete.withColumn("chapter_marks", chapters.pick(F.col("chapters"), F.col("description")))


def rendered_docs(spark, sf_dir):
    return docs.rendered(document_videos(spark, sf_dir), t.AS_OF)


def file_rows(spark, sf_dir) -> DataFrame:
    """Names of all documents' files; no text is read."""
    numbered = enrich.with_details(docs.numbered(videos(spark, sf_dir)), t.details(spark, sf_dir), t.AS_OF)
    return numbered.select(
        F.lit(times.batch_name(t.AS_OF)).alias("batch_id"),
        "video_id",
        "number",
        markdown.file_name(F.col("number"), F.col("channel")).alias("filename"),
        times.duration_text(F.col("duration_seconds")).alias("duration"),
    )


def file_names(spark, sf_dir):
    return file_rows(spark, sf_dir)


def slugs(spark, sf_dir):
    pages = t.wide(spark, sf_dir, "pages", "page_id", "url", "html")
    return pages.select("page_id", text.slug(F.col("url")).alias("url_slug"), text.slug(F.col("html")).alias("html_slug"))


def rendered_roundtrip(spark, sf_dir):
    """All documents written as text files and read back by name."""
    path = scratch_path(spark, "files")
    files.write_plain(rendered_docs(spark, sf_dir), path)
    return files.by_name(files.read_plain(spark, path))


def rendered_published(spark, sf_dir):
    """All documents published as one batch, shown by its commit, and read back by name."""
    path = scratch_path(spark, "published")
    published.publish(rendered_docs(spark, sf_dir), path, times.batch_name(t.AS_OF))
    return files.by_name(published.read_published(spark, path))


def batch_manifest(spark, sf_dir):
    return docs.manifest(staged(file_rows(spark, sf_dir).select("batch_id", "filename"), "files"))


def push_manifest(spark, sf_dir):
    """All files, and one whose name has no number."""
    notes = spark.range(1).select(F.lit("TRANSCRIPT-notes.md").alias("filename"))
    return push(staged(file_rows(spark, sf_dir).select("filename").unionByName(notes), "files"), "batch-push")


# --- reports and whole runs ------------------------------------------------------------


def registry_report(spark, sf_dir):
    return validate(spark, t.channels(spark, sf_dir)).select(F.col("ord").cast("bigint").alias("ord"), "line")


def validate_report(spark, sf_dir):
    """Registry and store, and the state of a store that is missing."""
    store, channels = new_store(spark, "validated-store", EMBED_SIZE), t.channels(spark, sf_dir)
    found = validate(spark, channels, store.root)
    missing = validate(spark, channels, scratch_path(spark, "no-store")).where("section = 1").withColumn("section", F.lit(2))
    return found.unionByName(missing).select(
        F.col("section").cast("bigint").alias("section"), F.col("ord").cast("bigint").alias("ord"), "line"
    )


def store_rejected(spark, sf_dir):
    """Points whose vector has the wrong size are kept apart."""
    store, channels = new_store(spark, "rejecting-store", 2), t.channels(spark, sf_dir)
    store.insert_if_absent(doc_points(spark, sf_dir, channels, "batch-new", F.col("doc_id") + 2))
    return store.rejected().select("video_id", "batch_id", F.size("embedding").cast("bigint").alias("vector_size"))


def store_compacted(spark, sf_dir):
    """Two upserts and a compaction: the same rows, without the superseded ones."""
    store, channels = new_store(spark, "compacted-store", 2), t.channels(spark, sf_dir)
    for write, batch in enumerate(("batch-one", "batch-two")):
        store.upsert(doc_points(spark, sf_dir, channels, batch, F.col("doc_id") + write))
    compacted = store.compact()
    rows = spark.read.schema(STORE).parquet(store.path)
    return rows.select("video_id", "transcript_number", "batch_id", F.lit(compacted > 0).alias("compacted"))


def listing_urls(spark, sf_dir):
    """Page addresses of all sources and page names, as ids, handles and plain names."""
    names = t.table(spark, sf_dir, "documents").select(F.col("source").alias("name")).unionByName(
        t.table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^https?://([^/.]+)", 1).alias("name"))
    )
    forms = F.array(F.concat(F.lit("UC"), "name"), F.concat(F.lit("@"), "name"), F.col("name"))
    return names.distinct().select(F.explode(forms).alias("channel_id")).select(
        "channel_id", registry.listing_url(F.col("channel_id")).alias("url")
    )


class SizedByLength:
    """Vectors from the text's length; every seventh length gets one of the wrong size."""

    def column(self, text):
        size = F.char_length(text).cast("float")
        wrong = F.char_length(text) % 7 == 0
        return F.when(F.length(text) > 0, F.when(wrong, F.array(size)).otherwise(F.array(size, F.lit(1.0).cast("float"))))


def run_once(spark, sf_dir):
    store, tables = new_store(spark, "run-store", 2), t.landing_tables(spark, sf_dir)
    store.insert_if_absent(earlier_points(spark, sf_dir, tables.channels))
    return fetch(tables, t.AS_OF, store=store, embedder=SizedByLength(), languages=t.LANGUAGES)


def outcomes_without_store(spark, sf_dir):
    """The same run without a store: nothing is skipped, further listings are processed again."""
    run = fetch(t.landing_tables(spark, sf_dir), t.AS_OF, embedder=SizedByLength(), languages=t.LANGUAGES)
    return run.outcomes


def ingest_outcomes(spark, sf_dir):
    return run_once(spark, sf_dir).outcomes


def run_summary(spark, sf_dir):
    return run_once(spark, sf_dir).summary


def run_counts(spark, sf_dir):
    """Outcomes by status, as the run's own writes counted them."""
    run = run_once(spark, sf_dir)
    rows = [(run.batch_id, status, n) for status, n in run.counts.items()]
    return spark.createDataFrame(rows, "batch_id string, status string, n long")


def ingest_documents(spark, sf_dir):
    return run_once(spark, sf_dir).documents


def stream_ingest(spark, sf_dir):
    """The run as a stream over landed listing files, started twice."""
    tables = t.landing_tables(spark, sf_dir)
    landed, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "stream")
    tables.listing.write.parquet(landed)
    store = new_store(spark, "stream-store", EMBED_SIZE)
    for _ in range(2):
        query = incremental.start(tables, landed, store, checkpoint, t.AS_OF, languages=t.LANGUAGES)
        query.awaitTermination()
    return store.read().select("video_id", "title", "channel", "transcript_number", "batch_id", "transcript_text")


def landings(spark, sf_dir) -> list[DataFrame]:
    """What four runs land of the listing: two days of it, some entries after a week, then new and late ones.

    The second landing repeats the first; the odd entries of the last come days after their time.
    """
    doc = F.col("id").try_cast("bigint")
    seen = lambda day: F.timestamp_seconds(F.lit(FIRST_SECOND + day * 86400) + doc % 86400)
    rows = staged(t.listing(spark, sf_dir), "listing")
    parts = [
        (doc % 3 != 0, seen(0)),
        (F.lit(True), seen(1)),
        (doc % 5 == 0, seen(9)),
        (F.lit(True), F.when(doc % 2 == 0, seen(10)).otherwise(seen(3))),
    ]
    return [rows.where(chosen).withColumn("seen_at", time) for chosen, time in parts]


def stream_ingest_bounded(spark, sf_dir):
    """Fresh entries of each run, remembered for three days, and the state that the run left behind."""
    landed, checkpoint, out = (scratch_path(spark, n) for n in ("landed", "stream", "fresh"))
    reports = []
    for run, rows in enumerate(landings(spark, sf_dir), 1):
        rows.write.mode("append").parquet(landed)
        found = incremental.fresh(landing.stream(spark, "listing", landed, more=incremental.SEEN_AT), "3 days")
        keep = found.select(F.col("id").alias("video_id"), F.unix_seconds("seen_at").alias("seen_second"))

        def save(batch: DataFrame, epoch: int, run: int = run) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/run={run}/epoch={epoch}")

        query = keep.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        reports.append((run, *incremental.state_report(query).values()))
    runs = spark.createDataFrame(reports, "run long, state_rows long, expired long, late long")
    admitted = spark.read.schema("video_id string, seen_second long, run int, epoch int").parquet(out).drop("epoch")
    return runs.join(admitted.withColumn("run", F.col("run").cast("bigint")), "run", "left")


def stream_numbers(spark, sf_dir):
    """The entries that four runs find new, numbered by state alone; the stream is started anew for each."""
    landed, checkpoint, out = (scratch_path(spark, n) for n in ("landed", "stream", "numbers"))
    for run, rows in enumerate(landings(spark, sf_dir), 1):
        rows.write.mode("append").parquet(landed)
        listing = landing.stream(spark, "listing", landed, more=incremental.SEEN_AT)

        def save(batch: DataFrame, epoch: int, run: int = run) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/run={run}/epoch={epoch}")

        with numbered.state_in_rocksdb(spark):
            query = numbered.fresh_numbered(listing, 3).writeStream.foreachBatch(save)
            query = query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    rows = spark.read.schema(f"{numbered.OUT}, run int, epoch int").parquet(out)
    return rows.select(
        F.col("run").cast("bigint").alias("run"), "channel_id", "video_id", F.unix_seconds("seen_at").alias("seen_second"), "number"
    )


def dumped(spark, sf_dir) -> tuple[str, Landing]:
    """The listing as a dump of three runs; the third holds a line that is cut off, of the channel that failed."""
    root, tables = scratch_path(spark, "dump"), t.landing_tables(spark, sf_dir)
    rows = staged(tables.listing, "listing")
    for run, part in (("run-1", F.col("position") % 3 != 0), ("run-2", F.col("position") % 3 == 0)):
        dumps.write_dump(rows.where(part), root, run)
    cut = tables.failed_channels.select("channel_id", F.lit('{"id": "cut').alias("value"))
    cut.write.partitionBy("channel_id").text(f"{root}/run-3")
    return root, tables


def dump_outcomes(spark, sf_dir):
    """A run without a store over a dump, whose bad lines tell which channel failed."""
    root, tables = dumped(spark, sf_dir)
    dump = dumps.read_dump(spark, root)
    tables = replace(tables, listing=dumps.entries(dump), failed_channels=dumps.failed_channels(dump))
    return fetch(tables, t.AS_OF, embedder=SizedByLength(), languages=t.LANGUAGES).outcomes


def dump_stream(spark, sf_dir):
    """The dump's entries as a stream, started once before the last two runs have landed and once after."""
    root, out, checkpoint = (scratch_path(spark, n) for n in ("dump", "entries", "stream"))
    rows = staged(t.listing(spark, sf_dir), "listing")

    def save(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    for runs in ((0,), (1, 2)):
        for run in runs:
            dumps.write_dump(rows.where(F.col("position") % 3 == run), root, f"run-{run}")
        query = dumps.stream_dump(spark, root).writeStream.foreachBatch(save)
        query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    entries = dumps.entries(spark.read.schema(dumps.SCHEMA).parquet(out))
    return cand.parse_listing(entries, t.AS_OF).select(
        "channel_id", "position", "video_id", "title", "channel", times.iso_text(F.col("published")).alias("published"), "url", "duration_seconds"
    )


ALL: dict[str, Query] = {
    f.__name__: f
    for f in (
        doc_topics,
        topic_scores,
        topics_sentence,
        recent_per_channel,
        recent_counts,
        unprocessed,
        young_orders,
        details_fallback,
        video_tags,
        best_track,
        clean_segments,
        transcript_text,
        conversation_text,
        page_text_strip,
        chapters_from_text,
        chapters_native,
        chapters_pick,
        point_ids,
        store_upsert,
        store_insert,
        last_writes,
        search_topk,
        search_topk_filtered,
        search_rows,
        search_pruned,
        search_index,
        search_index_filtered,
        search_json,
        search_text,
        search_nearest,
        search_ann,
        search_ann_recall,
        embed_hash,
        embed_model,
        embed_ngrams,
        doc_search,
        rendered_docs,
        file_names,
        slugs,
        rendered_roundtrip,
        rendered_published,
        batch_manifest,
        push_manifest,
        registry_report,
        validate_report,
        store_rejected,
        store_compacted,
        listing_urls,
        ingest_outcomes,
        outcomes_without_store,
        run_summary,
        run_counts,
        ingest_documents,
        stream_ingest,
        stream_ingest_bounded,
        stream_numbers,
        dump_outcomes,
        dump_stream,
    )
}
