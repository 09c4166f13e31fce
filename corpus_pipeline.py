"""The corpus pipeline: documents to training windows, one training-data operator per stage.

Each stage works on all rows that the one before it kept; between stages the documents are written as Parquet under
the shared folder and read again.  All stages but the last return the columns of ``documents``, extra ones included, whatever
they are called.  Rows are told apart by themselves, not by doc_id: null and repeated doc_ids are rows of their own.  Texts count
whole, however long.  An empty table stays empty through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newslab.llm import exact_dedup, jaccard_join, language_id, mixing
from newslab.llm.common import table, written
from newslab.llm.queries import packed, piece_digests


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or in no learned language.

    A null or empty text has no letter.  lang may be null anywhere; with no label at all every text with a letter stays.  A
    text of under 20 n-grams stays, as nothing can be said of it.  Equal texts share their fate.
    """
    return language_id.keep_known(docs, language_id.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (runs of white space count as one space, null as empty) keep the row with the smallest doc_id.

    A null doc_id loses to every other; of rows that repeat doc_id and text one stays.
    """
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates keep the document with the smallest doc_id.

    Texts without words are linked with nothing and stay.  A row with a null doc_id stays and links nothing; rows that share
    a doc_id are one node and stay or go together.
    """
    return jaccard_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents to meet the sources' targets, in training order.

    A null source is a source of its own; a text without words is never taken; ties in the order are broken by doc_id, size
    and a hash of the text, so reruns agree.
    """
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens; a null or empty text is one piece with the end id alone."""
    return piece_digests(packed(docs))


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("packing", pack)]

#: Language models and tokenizers are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
