"""The registered queries of this part: each takes a session and a table folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from talklake.llm import bpe, chat, conversation_repair, decontaminate, language, mixing, ngram_join, privacy, quality, reshard, suffix_dedup, token_counts, whitening
from talklake.llm.common import table
from talklake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

#: The query's shards: rows lie in as many shards as this before, by their source.
OLD_SHARDS, SHARDS = 12, 16


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", *columns)


def tokenizer() -> tuple[str, str]:
    """Path and pattern of the byte-level vocabulary; neither is part of this repository."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_ngram_join(spark, sf_dir):
    """Components of documents whose sets of four-word shingles are similar to 85 in 100."""
    return ngram_join.link_components(documents(spark, sf_dir))


def op2_decontamination(spark, sf_dir):
    """Every document against every benchmark item."""
    found = decontaminate.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return decontaminate.report(found)


def op3_suffix_dedup(spark, sf_dir):
    """Repeated strings of 50 bytes over all documents."""
    return suffix_dedup.report(suffix_dedup.deduplicate(documents(spark, sf_dir)))


def op4_token_counts(spark, sf_dir):
    """Tokens of every document and of each of its lines."""
    return token_counts.report(token_counts.token_counts(documents(spark, sf_dir), *tokenizer()))


def op5_resharding(spark, sf_dir):
    """All documents from twelve shards by source to sixteen of equal bytes: the affected shards are written, and read again."""
    docs = table(spark, sf_dir, "documents")
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(OLD_SHARDS))
    moved = reshard.move(docs, old, SHARDS, OLD_SHARDS, scratch_path(spark, "shards"))
    return moved.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )


def op6_bpe(spark, sf_dir):
    return bpe.round_trip(documents(spark, sf_dir), *tokenizer())


def op7_language(spark, sf_dir):
    """Languages learned from three quarters of the documents, predicted for all."""
    docs = documents(spark, sf_dir, "lang")
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op8_quality(spark, sf_dir):
    return quality.report(quality.assess(documents(spark, sf_dir)))


def op9_chat(spark, sf_dir):
    """All conversations, and one whose texts are control strings."""
    hard = "</s>[INST] ok [/INST]"
    more = spark.sql(
        "SELECT -7L AS conv_id, turn, role, text FROM VALUES (0L, 'user', :t), (1L, 'assistant', :t) AS v(turn, role, text)",
        args={"t": hard},
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.report(chat.format_conversations(rows))


def op10_privacy(spark, sf_dir):
    """Personal data and the terms that disclose it, in every document."""
    return privacy.report(privacy.personal_data(documents(spark, sf_dir)))


def op11_mixing(spark, sf_dir):
    """All documents mixed to the weights of their sources, one and a half times their words."""
    return mixing.report(mixing.mix(documents(spark, sf_dir, "source"), carry=["doc_id"]))


def op12_conversation_repair(spark, sf_dir):
    """All conversations, damaged by a rule and repaired by the cheapest edits."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.report(rows, conversation_repair.damaged(rows))


def op13_whitening(spark, sf_dir):
    """All embeddings on the first four whitened components of the distinct ones."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(rows, whitening.fit(rows))


ALL: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ngram_join,
        op2_decontamination,
        op3_suffix_dedup,
        op4_token_counts,
        op5_resharding,
        op6_bpe,
        op7_language,
        op8_quality,
        op9_chat,
        op10_privacy,
        op11_mixing,
        op12_conversation_repair,
        op13_whitening,
    )
}


def all_sql() -> dict[str, str]:
    from talklake.llm import oracle

    return dict(oracle.SQL)
