"""Word vocabulary and fixed-length encoding (F14, re-aimed from a sub-word tokenizer).

Vocabulary ids are the exact rank of each word by ``(count desc, word)``
(id 0 is padding).  The rank is computed without a single-partition window:
range-partition on the sort key, take each row's position inside its
partition, and add the sizes of all earlier partitions (a table with one
row per partition, so it is bounded by the partition count).

Encoding keeps the first ``max_length`` tokens of each text (truncation is
the feature), joins them to the vocabulary (AQE picks broadcast when the
vocabulary is measured small, otherwise a shuffle join whose hot words are
split by the skew-join rule), and pads ids and mask to ``max_length``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslab import schema as S
from newslab.functions import text as X

_POS_BITS = 33  # monotonically_increasing_id: partition index << 33 | row position


def global_rank(df: DataFrame, order: list, n_partitions: int | None = None) -> DataFrame:
    """Add ``rank`` (1-based, exact) in the total order ``order`` (must be unique)."""
    spark = df.sparkSession
    n = n_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    tagged = tagged.withColumn("_part", F.shiftright(F.col("_mid"), _POS_BITS))
    tagged = tagged.checkpoint(eager=True)  # pin the ids; reliable checkpoint in the shared folder
    sizes = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(w), F.lit(0)).alias("_offset"))
    pos = F.col("_mid") - F.shiftleft(F.col("_part"), _POS_BITS)
    out = tagged.join(F.broadcast(offsets), "_part")
    return out.withColumn("rank", F.col("_offset") + pos + 1).drop("_mid", "_part", "_offset")


def build_vocab(news_df: DataFrame, text_col: str = "clean_text") -> DataFrame:
    """Word -> id by frequency (whole texts), ties by word."""
    words = news_df.select(F.explode(X.tokens(F.col(text_col))).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    ranked = global_rank(counts, [F.col("freq").desc(), F.col("word")])
    return ranked.select("word", "freq", F.col("rank").cast("int").alias("id"))


def encode(news_df: DataFrame, vocab: DataFrame, max_length: int = S.MAX_LENGTH, id_col: str = "news_id",
           text_col: str = "clean_text") -> DataFrame:
    """``input_ids`` and ``attention_mask``, both exactly ``max_length`` long."""
    head = news_df.select(id_col, F.posexplode(F.slice(X.tokens(F.col(text_col)), 1, max_length)).alias("pos", "word"))
    ided = head.join(vocab.select("word", "id"), "word")
    per_doc = ided.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("t"))
    ids = F.transform(F.col("t"), lambda x: x["id"])
    docs = news_df.select(id_col).join(per_doc, id_col, "left")
    ids = F.coalesce(ids, F.array().cast("array<int>"))
    padded = F.slice(F.concat(ids, F.array_repeat(F.lit(0), max_length)), 1, max_length)
    mask = F.slice(F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), max_length)), 1,
                   max_length)
    return docs.select(id_col, padded.alias("input_ids"), mask.alias("attention_mask"))


#: Words whose ids a task keeps at hand.
WORDS_KEPT = 100_000


def encode_subwords(df: DataFrame, tokenizer: str, max_length: int = S.MAX_LENGTH, text: str = "clean_text",
                    keep: tuple[str, ...] = ("news_id",)) -> DataFrame:
    """F14 with sub-words: ``keep`` columns, ``input_ids`` and ``attention_mask`` of exactly ``max_length`` for every row.

    ``tokenizer`` is the path of a given vocabulary file that drops white space between words (never trained here).  A word
    has at least one id, so the first ``max_length`` words decide; every word is encoded by itself, once as long as the task
    remembers it.  Nothing is shuffled.  A null or empty text is all padding (id 0).
    """
    import numpy as np
    import pyarrow as pa

    def run(batches):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(tokenizer)
        library.encode_special_tokens = True
        known: dict[str, list[int]] = {}
        for batch in batches:
            ids, mask = np.zeros((len(batch), max_length), np.int32), np.zeros((len(batch), max_length), np.int32)
            for i, words in enumerate(batch.column(len(keep))):
                out: list[int] = []
                for word in words.as_py() or ():
                    if len(out) >= max_length:
                        break
                    if word not in known:
                        if len(known) >= WORDS_KEPT:
                            known.clear()
                        known[word] = library.encode(word, add_special_tokens=False).ids
                    out += known[word]
                out = out[:max_length]
                ids[i, :len(out)], mask[i, :len(out)] = out, 1
            offsets = pa.array(np.arange(len(batch) + 1) * max_length, pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.ListArray.from_arrays(offsets, pa.array(v.reshape(-1))) for v in (ids, mask))],
                                             names=[*keep, "input_ids", "attention_mask"])

    rows = df.select(*keep, F.slice(X.tokens(F.coalesce(F.col(text), F.lit(""))), 1, max_length).alias("words"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(run, f"{kinds}, input_ids array<int>, attention_mask array<int>")
