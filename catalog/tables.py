"""The given tables seen as landing tables: documents are videos, sources channels."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from talklake.operators.numbering import number_rows
from talklake.operators.registry import enabled
from talklake.plans.fetch import Landing
from talklake.session import spread, staged
from talklake.sources import landing

AS_OF = datetime(2026, 3, 1, 6, 30)
LANGUAGES = ("en", "fr")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table for work on long texts, spread as the session says."""
    return spread(table(spark, sf_dir, name).select(*columns))


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One channel per source; those with many toxic labels are disabled."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    toxic = F.coalesce(F.sum("toxic"), F.lit(0))
    per_source = (
        table(spark, sf_dir, "documents")
        .select("doc_id", "source", "lang")
        .join(labels, "doc_id", "left")
        .groupBy("source")
        .agg(
            toxic.alias("toxic"),
            F.count("toxic").alias("labelled"),
            F.count("*").alias("n"),
            F.sort_array(F.collect_set("lang")).alias("tags"),
        )
    )
    rows = per_source.select(
        (F.row_number().over(W.orderBy("source")) - 1).alias("ord"),
        F.col("source").alias("channel_id"),
        F.concat(F.lit("Channel "), "source").alias("name"),
        F.when(F.col("toxic") * 5 > F.col("labelled"), False).alias("enabled"),
        F.when(F.col("labelled") % 2 == 0, 20 + F.col("n") % 20).cast("int").alias("max_age_days"),
        F.when(F.col("toxic") > 0, 8 + F.col("toxic") % 8).cast("int").alias("max_videos_per_run"),
        F.when(F.size("tags") > 3, F.col("tags")).alias("metadata_tags"),
    )
    return staged(landing.conform(rows, "channels"), "channels")


def upload_date():
    day = F.date_format(F.date_sub(F.lit("2026-03-01").cast("date"), (F.col("n_chars") % 60).cast("int")), "yyyyMMdd")
    return F.when(F.col("lang") == "es", "soon").when(F.col("lang") != "de", day)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an entry of its source's page; some entries have no id."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "lang",
        "n_chars",
        F.substring_index("text", "\n", 1).alias("head"),
    )
    placed = number_rows(docs, "source", "doc_id", "position")
    video_id = F.col("doc_id").cast("string")
    rows = placed.select(
        F.col("source").alias("channel_id"),
        F.when(F.col("lang") == "en", F.concat(F.lit("Channel "), "source")).alias("channel_name"),
        "position",
        F.when(F.col("n_chars") % 13 == 0, F.lit(None))
        .when(F.col("n_chars") % 11 == 0, F.lit(""))
        .otherwise(video_id)
        .alias("id"),
        F.when(F.col("lang") != "fr", F.col("head")).alias("title"),
        F.when(F.col("lang") == "fr", F.concat(F.lit("https://example.org/w/"), video_id)).alias("url"),
        F.when(F.col("n_chars") % 5 != 0, F.col("n_chars")).alias("duration"),
        upload_date().alias("upload_date"),
    )
    return landing.conform(rows, "listing")


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as detail records; a page and a document share their number."""
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    native = F.array(
        F.struct(F.lit(0.0).alias("start_time"), F.lit(95.5).alias("end_time"), F.lit("Start").alias("title")),
        F.struct(
            F.length("html").cast("double").alias("start_time"),
            F.lit(None).cast("double").alias("end_time"),
            F.lit(None).cast("string").alias("title"),
        ),
    )
    rows = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("video_id"),
        F.nullif(title, F.lit("")).alias("title"),
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("channel"),
        F.lit(None).cast("string").alias("upload_date"),
        F.when(~F.col("url").contains("#"), F.col("url")).alias("webpage_url"),
        F.length("html").cast("bigint").alias("duration"),
        F.concat(F.lit("About\n0:00 Intro\n1:30 "), title, F.lit("\n see 2:00 no\n01:05:30 End")).alias("description"),
        F.when(F.col("url").contains("?"), native).alias("chapters"),
    )
    return landing.conform(rows, "details")


def with_tracks(docs: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generated track per document, a manual one for good labels, English ones for long texts."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id", F.lit(True).alias("good"))

    def track(name: str, lang, is_generated: bool):
        return F.struct(F.lit(name).alias("track_id"), lang.alias("lang"), F.lit(is_generated).alias("is_generated"))

    kinds = F.array(
        track("generated", F.col("lang"), True),
        F.when(F.col("good"), track("manual", F.col("lang"), False)),
        F.when(F.col("n_chars") > 2000, track("english", F.lit("en"), True)),
    )
    return docs.join(good, "doc_id", "left").select("*", F.explode(kinds).alias("t")).where("t is not null")


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    rows = with_tracks(docs, spark, sf_dir)
    return landing.conform(rows.select(F.col("doc_id").cast("string").alias("video_id"), "t.*"), "tracks")


def marked_up(line, seq):
    """Caption text as players deliver it: tags, notes and blanks around the line."""
    return (
        F.when(seq % 3 == 0, F.concat(F.lit("<i>"), line, F.lit("</i>")))
        .when(seq % 3 == 1, F.concat(line, F.lit(" [Music]")))
        .otherwise(F.concat(F.lit("  "), line, F.lit(" ")))
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document as a caption segment."""
    docs = wide(spark, sf_dir, "documents", "doc_id", "text")
    exploded = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("seq", "line"))
    return exploded.select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.col("seq").cast("bigint").alias("seq"),
        marked_up(F.col("line"), F.col("seq")).alias("text"),
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines on each of a document's tracks."""
    docs = wide(spark, sf_dir, "documents", "doc_id", "text", "lang", "n_chars")
    rows = with_tracks(docs, spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.col("t.track_id").alias("track_id"),
        F.posexplode(F.split("text", "\n")).alias("seq", "line"),
    )
    raw = marked_up(F.col("line"), F.col("seq"))
    text = F.when(F.col("track_id") == "manual", F.concat(F.lit("<b>"), raw, F.lit("</b>"))).otherwise(raw)
    timed = rows.select(
        "video_id",
        "track_id",
        F.col("seq").cast("bigint").alias("seq"),
        F.col("seq").cast("double").alias("start"),
        F.lit(1.0).alias("duration"),
        text.alias("text"),
    )
    return landing.conform(timed, "segments")


def conversation_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation as a caption segment."""
    return wide(spark, sf_dir, "conversations", "conv_id", "turn", "text").select(
        F.col("conv_id").cast("string").alias("video_id"),
        F.col("turn").alias("seq"),
        marked_up(F.col("text"), F.col("turn")).alias("text"),
    )


def stored_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a bad label count as stored by an earlier run."""
    return table(spark, sf_dir, "labels").where("quality = 0").select(
        F.col("doc_id").cast("string").alias("video_id")
    )


def failed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a toxic label count as videos whose captions could not be read."""
    return table(spark, sf_dir, "labels").where("toxic = 1").select(
        F.col("doc_id").cast("string").alias("video_id")
    )


def shared_listing(spark: SparkSession, sf_dir: str, registry: DataFrame) -> DataFrame:
    """The listing, with the first three entries of each channel on the next channel's page, too.

    Own entries have odd positions, those of the channel before even ones.
    """
    own = listing(spark, sf_dir)
    order = registry.select("ord", "channel_id")
    after = order.select((F.col("ord") - 1).alias("ord"), F.col("channel_id").alias("next_id"))
    first = own.where("position <= 3").join(order.join(after, "ord").select("channel_id", "next_id"), "channel_id")
    copies = first.withColumns({"channel_id": F.col("next_id"), "position": F.col("position") * 2}).drop("next_id")
    return own.withColumn("position", F.col("position") * 2 - 1).unionByName(copies)


def landing_tables(spark: SparkSession, sf_dir: str) -> Landing:
    registry = channels(spark, sf_dir)
    # The last enabled channel cannot be read.
    last = enabled(registry).select(F.max("ord")).scalar()
    return Landing(
        channels=registry,
        listing=shared_listing(spark, sf_dir, registry),
        details=details(spark, sf_dir),
        tracks=tracks(spark, sf_dir),
        segments=segments(spark, sf_dir),
        failed_channels=registry.where(F.col("ord") == last).select("channel_id"),
        failed_texts=failed_texts(spark, sf_dir),
    )


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a video description with chapter lines and a native chapter list."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    second = F.floor("value").cast("bigint")
    pad = lambda n: F.lpad(n.cast("string"), 2, "0")
    odd = (
        F.when(F.col("event_type") == "error", "no chapters here")
        .when(F.col("event_type") == "click", F.concat(F.lit(" 3:00 indented\n99:99 odd "), k.cast("string")))
        .when(F.col("event_type") == "view", F.lit("2:00\nNext line"))
        .otherwise(F.concat(F.lit("01:"), pad(k % 60), F.lit(":30   "), F.col("event_type"), F.lit("  ")))
    )
    start = F.concat((second % 60).cast("string"), F.lit(":"), pad(k % 60), F.lit(" Part "), k.cast("string"))
    native = F.array(
        F.struct(F.lit(0.0).alias("start_time"), F.col("value").alias("end_time"), F.lit("Intro").alias("title")),
        F.struct(
            (F.col("value") * 60).alias("start_time"),
            F.lit(None).cast("double").alias("end_time"),
            F.when(F.col("event_type") != "view", F.col("event_type")).alias("title"),
        ),
    )
    empty = F.array().cast("array<struct<start_time:double,end_time:double,title:string>>")
    return wide(spark, sf_dir, "events", "event_id", "event_type", "value", "props").select(
        "event_id",
        F.concat(F.lit("About\n"), start, F.lit("\n"), odd).alias("description"),
        F.when(F.col("event_type").isin("purchase", "view"), native).otherwise(empty).alias("chapters"),
    )
