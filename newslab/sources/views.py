"""Mapping of the supplied tables onto the news data model.

* ``news_raw``: ``documents`` left join ``labels`` (label text null when
  unlabelled; case and surrounding spaces varied by ``doc_id`` parity so the
  label normaliser has work to do); with ``dated``, ``created_at`` from
  ``events`` on ``event_id = doc_id`` (``events`` is not read otherwise).  Columns use the raw headline-table names
  ``judul``, ``tanggal``, ``sentimen``.
* ``labelled``: ``toxic=1`` -> negatif, else ``quality=1`` -> positif, else netral.

Labels and event times are joined to the documents by id without an exchange
of texts (``by_id``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslab.sources.by_id import documents_with_attributes


def news_raw(spark: SparkSession, sf_dir: str, labelled_only: bool = False, dated: bool = True) -> DataFrame:
    """The raw headline table; ``labelled_only`` keeps only documents with a label row.

    The prepared table drops unlabelled rows anyway, so it reads this view with an inner join: the same rows.
    """
    docs = documents_with_attributes(spark, sf_dir, ["doc_id", "text", "source"], labelled_only, dated)
    raw_label = (
        F.when(F.col("lbl").isNull(), F.lit(None).cast("string"))
        .when(F.col("doc_id") % 2 == 0, F.upper("lbl"))
        .otherwise(F.concat(F.lit("  "), F.col("lbl"), F.lit(" ")))
    )
    out = docs.select("doc_id", F.col("text").alias("judul"), raw_label.alias("sentimen"), "source", *(["created_at"] if dated else []))
    return out.withColumn("tanggal", F.date_format("created_at", "yyyy-MM-dd")) if dated else out
