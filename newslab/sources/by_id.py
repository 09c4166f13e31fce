"""Documents beside their labels and event times, joined by id without moving a text.

The attributes are narrow (id, label, time).  Where they are few they are broadcast to the scan of the documents.  Beyond
that, documents and attributes are stored once in the same number of hash buckets of the id and joined bucket by bucket:
no exchange stands under either side.  Ids that repeat so often that their bucket would be one large task, and rows
without an id, stay out of the buckets and meet their attributes at the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslab.sources import stored
from newslab.sources.tables import read_table

#: Attribute rows (about 40 bytes each) that are broadcast.
BROADCAST_ROWS = 1_000_000
#: Stored bytes of documents in a bucket, and files that a store may have before its rows are dealt by bucket first.
BUCKET_BYTES, MOST_FILES = 128 * 1024 * 1024, 20_000
#: Rows from which an id is kept out of the buckets, and how many such ids are looked for.
HOT_ROWS, HOT_IDS = 200_000, 100


def base_label(toxic: Column, quality: Column) -> Column:
    return F.when(toxic == 1, F.lit("negatif")).when(quality == 1, F.lit("positif")).otherwise(F.lit("netral"))


def attributes(spark: SparkSession, sf_dir: str, labelled_only: bool, dated: bool) -> DataFrame:
    """(a_id, lbl, created_at): one row per pair of label row and event row of an id; ``created_at`` only if ``dated``.

    Ids of one side alone keep a null for the other (events without a label only unless ``labelled_only``).
    """
    labels = (read_table(spark, sf_dir, "labels").filter("doc_id is not null")
              .select(F.col("doc_id").alias("a_id"), base_label(F.col("toxic"), F.col("quality")).alias("lbl")))
    if not dated:
        return labels
    events = (read_table(spark, sf_dir, "events").filter("event_id is not null")
              .select(F.col("event_id").alias("a_id"), F.col("ts").alias("created_at")))
    return labels.join(events, "a_id", "left" if labelled_only else "full")


def _name(labelled_only: bool, dated: bool) -> str:
    return f"attributes{'-labelled' if labelled_only else ''}{'-dated' if dated else ''}"


def documents_with_attributes(spark: SparkSession, sf_dir: str, columns: list[str], labelled_only: bool, dated: bool) -> DataFrame:
    """``columns`` of the documents with lbl and, if ``dated``, created_at: a left join by id, inner if ``labelled_only``."""
    docs = read_table(spark, sf_dir, "documents").select(*columns)
    how = "inner" if labelled_only else "left"
    name = _name(labelled_only, dated)
    attrs = stored.materialise(spark, sf_dir, name, lambda: attributes(spark, sf_dir, labelled_only, dated))
    rows = stored.once(spark, sf_dir, f"{name}-rows", attrs.count)
    extra = [c for c in attrs.columns if c != "a_id"]
    if rows <= BROADCAST_ROWS:
        return docs.join(F.broadcast(attrs), F.col("doc_id") == F.col("a_id"), how).select(*columns, *extra)
    hot = stored.once(spark, sf_dir, "hot-ids", lambda: _hot_ids(docs))
    n = max(spark.sparkContext.defaultParallelism, -(-stored.input_bytes(spark, sf_dir, "documents") // BUCKET_BYTES))
    cold = lambda c: F.col(c).isNotNull() & ~F.col(c).isin(hot)
    all_docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    docs_table = stored.once(spark, sf_dir, f"documents-by-id-{n}",
                             lambda: stored.bucketed(all_docs.filter(cold("doc_id")), "documents-by-id", "doc_id", n, MOST_FILES))
    attrs_table = stored.once(spark, sf_dir, f"{name}-by-id-{n}",
                              lambda: stored.bucketed(attrs.filter(cold("a_id")), name, "a_id", n, MOST_FILES))
    out = (spark.table(docs_table).select(*columns)
           .join(spark.table(attrs_table).hint("merge"), F.col("doc_id") == F.col("a_id"), how).select(*columns, *extra))
    rest = docs.filter(F.col("doc_id").isin(hot) | F.col("doc_id").isNull())
    few = attrs.filter(F.col("a_id").isin(hot))
    if few.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        few = F.broadcast(few)
    return out.unionByName(rest.join(few, F.col("doc_id") == F.col("a_id"), how).select(*columns, *extra))


def _hot_ids(docs: DataFrame) -> list[int]:
    """Ids with about ``HOT_ROWS`` rows or more, by a frequency sketch next to the scan."""
    found = docs.select("doc_id").filter("doc_id is not null").agg(F.expr(f"approx_top_k(doc_id, {HOT_IDS}, 16384)").alias("top")).first()["top"]
    return [r["item"] for r in found or [] if r["count"] >= HOT_ROWS]
