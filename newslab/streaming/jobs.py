"""Structured Streaming jobs (T1, T2), run with ``trigger(availableNow=True)``.

T1 - scheduled ingest as an incremental stream: new landed files only, each title once, its first arrival.  A state store
holds the titles of the last ``retention``; within a micro-batch the first row in arrival order wins, whatever order tasks
deliver them in.  What the state has let go is looked up in the store, and only there: an anti join against rows that
arrived before the retention, in the title buckets of the batch.  The watermark follows the time of arrival, so it drops no
row however old its news is.  A replayed batch overwrites exactly its own partitions.

T2 - daily sentiment by a tumbling one-day event-time window.  Counts per (day, sentiment) live in a state store until the
watermark passes the day and are written whenever they change; readers take the newest count.  A row whose day the
watermark has passed is counted as late: it joins the current window under its own day, so it is in the state and the
store like any other, and readers fold it in.  A replayed batch overwrites exactly its own partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


@contextmanager
def state_partitions(spark: SparkSession, n: int | None):
    """Shuffle / state-store partitions for a streaming run.

    A stateful operator keeps the partition count it was first started with
    (it is stored in the checkpoint) and adaptive execution cannot coalesce
    it, so size it for the state, not for the session's batch default.
    """
    if not n:
        yield
        return
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


#: Default number of title buckets of a store; a store keeps the number it was started with, so size it for the
#: titles it will hold (a batch reads the buckets its titles fall in).
TITLE_BUCKETS = 256


def title_bucket(title, buckets: int = TITLE_BUCKETS):
    """Stable hash bucket of a title (partition column of the store)."""
    return F.pmod(F.xxhash64(title), F.lit(buckets)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def land_in_batches(df: DataFrame, landing: str, order_col: str, n_files: int = 3, after_each=None) -> None:
    """Land a table as ``n_files`` Parquet drops in ``order_col`` order (the arrival order).

    Drop boundaries are approximate quantiles of ``order_col`` (n-1 numbers
    reach the driver); rows without a value arrive first.  Each drop is a separate write.  ``after_each(k)`` runs
    after drop ``k`` has landed, e.g. a scheduled ``availableNow`` run of a
    stream that picks up only the new files.
    """
    staging = f"{landing}-staging"
    df.write.mode("overwrite").parquet(staging)  # one pass over the source
    df = df.sparkSession.read.parquet(staging)
    cuts = df.approxQuantile(order_col, [k / n_files for k in range(1, n_files)], 0.001) if n_files > 1 else []
    bounds = [None, *cuts, None]
    for k in range(n_files):
        cond = F.lit(True)
        if bounds[k] is not None:
            cond = cond & (F.col(order_col) > bounds[k])
        if bounds[k + 1] is not None:
            cond = cond & (F.col(order_col) <= bounds[k + 1])
        if bounds[k] is None:
            cond = F.coalesce(cond, F.lit(True)) | F.col(order_col).isNull()
        df.filter(cond).write.mode("overwrite").parquet(f"{landing}/drop={k:05d}")
        if after_each is not None:
            after_each(k)


#: Days for which the state store knows a title; older ones are looked up in the store.
RETENTION_DAYS = 30.0
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_JSON = {"timestampFormat": _MICROS, "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def _sort_key(col: Column, kind: str) -> Column:
    """Text that sorts as the values do, nulls first: whole numbers and times by their offset, other values as strings."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        key = F.lpad(F.hex(col.cast("long").bitwiseXOR(F.lit(-2**63))), 16, "0")
    elif kind in ("timestamp", "timestamp_ntz", "date"):
        key = F.lpad(F.hex(F.unix_micros(col.cast("timestamp")).bitwiseXOR(F.lit(-2**63))), 16, "0")
    else:
        key = F.hex(col.cast("string").cast("binary"))
    return F.coalesce(F.concat(F.lit("1"), key, F.lit(" ")), F.lit("0 "))


def _packed(df: DataFrame, order: Sequence[str]) -> Column:
    """A row as one string that sorts by ``order``, then by the row itself: sort keys, then the row as JSON."""
    kinds = dict(df.dtypes)
    keys = [_sort_key(F.col(c), kinds[c]) for c in order]
    return F.concat(*keys, F.to_json(F.struct(*df.columns), _JSON))


def _least(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first row of each title in each batch of a task: a hot title is thinned out before the shuffle."""
    for part in rows:
        yield part.groupby("title", as_index=False, dropna=False).agg({"packed": "min", "arrived": "max"})


def _first_arrival(retention_ms: int):
    def run(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best, arrived = None, 0
        for part in rows:
            least = part["packed"].min()
            best = least if best is None or least < best else best
            arrived = max(arrived, int(part["arrived"].max().timestamp() * 1000))
        known = state.exists
        state.update((arrived,))
        state.setTimeoutTimestamp(max(arrived + retention_ms, state.getCurrentWatermarkMs() + 1))
        if not known:
            yield pd.DataFrame({"title": [key[0]], "packed": [best]})

    return run


def ingest_dedup_stream(spark: SparkSession, landing: str, schema, store: str, checkpoint: str,
                        files_per_trigger: int | None = None, partitions: int | None = None,
                        buckets: int = TITLE_BUCKETS, order: Sequence[str] = (), retention_days: float = RETENTION_DAYS) -> None:
    """One scheduled run: stream the newly landed headline files into the store, each title at most once.

    Of rows that share a title the first to arrive is stored: of the earliest micro-batch, then first by ``order`` (nulls
    first), then by the row's text.  A null title is a title of its own.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    src = reader.parquet(landing)
    thin = "title string, packed string, arrived timestamp"
    rows = (src.select("title", _packed(src, order).alias("packed"), F.current_timestamp().alias("arrived"))
            .mapInPandas(_least, thin).withWatermark("arrived", "0 seconds"))
    fresh = rows.groupBy("title").applyInPandasWithState(
        _first_arrival(int(retention_days * 86_400_000)), "title string, packed string", "arrived long", "append",
        GroupStateTimeout.EventTimeTimeout)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # Used by two actions below; a micro-batch is bounded by the trigger size.
        batch.persist()
        try:
            _write_batch(batch, batch_id)
        finally:
            batch.unpersist()

    def _write_batch(batch: DataFrame, batch_id: int) -> None:
        row = F.from_json(F.expr("substr(packed, instr(packed, '{'))"), schema, _JSON)
        out = batch.select(title_bucket(F.col("title"), buckets).alias("title_bucket"), row.alias("row")).select("title_bucket", "row.*")
        out = out.withColumn("arrived", F.current_timestamp())
        if _exists(spark, store):
            # The store is partitioned by title bucket: read only the buckets this batch touches (at most ``buckets``
            # numbers reach the driver), and of them only rows that the state may have let go.
            touched = [r[0] for r in out.select("title_bucket").distinct().collect()]
            gone = F.col("arrived") <= F.current_timestamp() - F.expr(f"INTERVAL {int(retention_days * 86_400)} SECONDS")
            known = spark.read.parquet(store).filter(F.col("title_bucket").isin(touched) & gone & (F.col("batch_id") < batch_id))
            known = known.select(F.col("title_bucket").alias("k_bucket"), F.col("title").alias("k_title"))
            out = out.join(known, (F.col("title_bucket") == F.col("k_bucket")) & F.col("title").eqNullSafe(F.col("k_title")), "left_anti")
        (out.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("title_bucket", "batch_id").parquet(store))

    with state_partitions(spark, partitions):
        q = (fresh.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()


#: How long after a day's end its rows still count in the day's own window.
LATENESS = "1 day"
_DAILY = "day string, sentiment string, n long, newest timestamp, window_start timestamp, batch_id long"


def daily_sentiment_stream(spark: SparkSession, landing: str, schema, out: str, checkpoint: str,
                           partitions: int | None = None, lateness: str = LATENESS) -> dict | None:
    """One scheduled run: counts per (1-day window, sentiment) after the newly landed rows, added to the store.

    Rows without an event time are in no window.  A run takes all new files in one micro-batch, so that the watermark it
    starts with (the newest event time stored, less ``lateness``) holds for all its rows; land large backlogs in several
    drops.  Returns the last progress of the run.
    """
    src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(landing)
    newest = None
    if _exists(spark, out):
        newest = spark.read.schema(_DAILY).parquet(out).agg(F.max("newest")).first()[0]
    ends = F.date_trunc("day", "event_time") + F.expr("INTERVAL 1 DAY")
    late = F.lit(False)
    if newest is not None:
        late = ends <= F.lit(newest) - F.expr(f"INTERVAL {lateness}")
    rows = (src.filter("event_time is not null").withColumn("of_day", F.when(late, F.date_format("event_time", "yyyy-MM-dd")))
            .withColumn("event_time", F.when(late, F.lit(newest).cast("timestamp")).otherwise(F.col("event_time"))))
    counts = (rows.withWatermark("event_time", lateness)
              .groupBy(F.window("event_time", "1 day").alias("w"), "of_day", "sentiment")
              .agg(F.count(F.lit(1)).alias("n"), F.max("event_time").alias("newest")))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.select(F.coalesce("of_day", F.date_format("w.start", "yyyy-MM-dd")).alias("day"), "sentiment", "n", "newest",
                      F.col("w.start").alias("window_start"), F.lit(batch_id).cast("long").alias("batch_id"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out))

    with state_partitions(spark, partitions):
        q = (counts.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return q.lastProgress


def daily_counts(spark: SparkSession, out: str) -> DataFrame:
    """day, sentiment, n: the newest count of every window in the store of ``daily_sentiment_stream``, late rows folded in."""
    stored = spark.read.schema(_DAILY).parquet(out)
    newest = stored.groupBy("window_start", "day", "sentiment").agg(F.max_by("n", "batch_id").alias("n"))
    return newest.groupBy("day", "sentiment").agg(F.sum("n").alias("n"))
