"""From documents to tokens: language, near duplicates, decontamination, personal data, encoding.

Every stage takes what its predecessor kept, written as Parquet and read again; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from talklake.llm import bpe, decontaminate, language, ngram_join, privacy
from talklake.llm.common import table, written
from talklake.llm.queries import tokenizer


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, which have no text or no letter, go.

    Where no document names its language, there is none to learn, and only letters are asked for.
    """
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    if not model.languages:
        return docs.where(language.has_letter(F.col("text")))
    found = language.identify(docs, model)
    return found.where(F.col("lang_pred") != language.UNKNOWN).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the smallest id stays: five-word shingles, similarity 0.8."""
    return ngram_join.one_per_group(docs, size=5, similarity=80)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window occurs go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select(*docs.columns)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms are generalised, in whichever document they are; all documents stay.

    What was found is written first, so that a task has one Python worker at a time: executors keep as many as ever
    ran at once, and the next stage fills each of them with its tokenizer.
    """
    clean = privacy.sanitised(written(privacy.personal_data(docs), "found"))
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the bytes they decode to, per document."""
    return bpe.round_trip(docs.select("doc_id", "text"), *tokenizer())


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", remove_contaminated),
    ("personal_data", sanitise),
    ("encoding", encode),
]

#: The classifier's matrix, the tokenizer's merges and the marked terms are beyond SQL; a test holds the
#: stages against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a table folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
