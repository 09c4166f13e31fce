"""Operator 13, toxicity: a bidirectional gated recurrent network with attention pooling scores all overlapping windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslab.llm import bigru
from newslab.llm.common import text_or_empty

#: Labelled texts that the network is trained on: at most so many of each label, and only texts of up to so many bytes (a
#: longer one is left out whole, never cut).
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_BYTES = 400, 1200, 8000
FOLDS = 5


def held_out() -> Column:
    """Rows whose label is never learned: 5 divides crc32 of the decimal doc_id (not so for a null)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN, size: int = SAMPLE_BYTES):
    """Texts (as words) and labels of a bounded sample outside the held-out fold, the same on every run.

    A doc_id labelled both ways isn't used; of rows that share a doc_id the smallest text is.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).filter(~held_out())
             .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most"))
    texts = (docs.select(F.col("doc_id").cast("long").alias("t_id"), text_or_empty().alias("text"))
             .filter(F.octet_length("text") <= size))
    order = F.xxhash64("doc_id")
    # Twice the wanted number, as some labels' texts are missing or long; then a bounded join.
    drawn = None
    for value, most in ((1, toxic), (0, clean)):
        part = known.filter(F.col("toxic") == value).orderBy(order, "doc_id").limit(2 * most).select("doc_id", "toxic")
        drawn = part if drawn is None else drawn.unionAll(part)
    rows = (texts.join(F.broadcast(drawn), F.col("t_id") == F.col("doc_id")).groupBy("doc_id")
            .agg(F.min("text").alias("text"), F.min("toxic").alias("toxic")).withColumn("o", order).orderBy("o", "doc_id").collect())
    picked = [r for value, most in ((1, toxic), (0, clean)) for r in [x for x in rows if x["toxic"] == value][:most]]
    return [bigru.words_of(r["text"]) for r in picked], np.array([r["toxic"] for r in picked], np.int64)


def fit(docs: DataFrame, labels: DataFrame, **sizes) -> bigru.Network | None:
    """A network trained on ``sample``; None if it lacks one of both labels."""
    texts, marks = sample(docs, labels, **sizes)
    return bigru.fit(texts, marks) if set(marks.tolist()) == {0, 1} else None


RESULT = "doc_id long, held_out boolean, score double, predicted int"


def score_documents(docs: DataFrame, network: bigru.Network | None) -> DataFrame:
    """doc_id, held_out, score (0 to 1: the most toxic window's) and predicted (1 from 0.5) for every row of ``docs``
    (doc_id, text; other columns ignored).

    A text without words, null or empty, scores 0, as does any without a network to score it.  Long texts are scored
    whole, a bounded number of windows at a time; equal texts score alike to rounding; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            scores = np.zeros(len(batch))
            begin = 0
            while model is not None and begin < len(batch):  # words of a bounded stretch of text at a time
                texts, size = [], 0
                while begin + len(texts) < len(batch) and size < 8 * bigru.CHUNK_WORDS:
                    text = batch.column(2)[begin + len(texts)].as_py()
                    texts.append(bigru.words_of(text))
                    size += len(text)
                with np.errstate(over="ignore"):
                    scores[begin:begin + len(texts)] = 1 / (1 + np.exp(-model.score(texts)))
                begin += len(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_or_empty().alias("text"))
            .mapInArrow(run, RESULT))
