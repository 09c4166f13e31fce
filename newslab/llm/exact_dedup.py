"""Operator 7, exact de-duplication by an extendible-hash index on shared files.

DataFrame operations only.  The index maps the 64-bit hash of a normalised text to a bucket through a directory of
hash prefixes.  A bucket with more distinct keys than its capacity is split by doubling the directory, until every
bucket fits.  Copies are pre-aggregated by the task that reads them, then the entries of shared keys go to the owner of
their bucket: buckets and keys are dealt in ranges, an owner sorts its range, chains the texts of equal keys and compares
them byte by byte.  What the owners find is written as the index in the shared folder, by bucket, and decides the groups;
a group of any size reaches its owner as one row per reading task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslab.functions.text import free_names
from newslab.llm.common import WORD_GAP, text_or_empty, written

#: Distinct keys that one bucket may hold.
BUCKET_KEYS = 20_000
#: Directory slots that are broadcast (16 MB); a larger directory is joined by a shuffle.
BROADCAST_SLOTS = 1 << 20
#: Shared keys that are broadcast (8 MB of hashes); beyond, the same join is shuffled.
BROADCAST_KEYS = 1_000_000
#: Rows of (doc_id, digest) that are broadcast to drop copies (about 30 MB); beyond, the same join is shuffled.
BROADCAST_ROWS = 250_000
HASH_BITS = 64


def normalised(text: str = "text") -> Column:
    """Every run of ASCII white space becomes one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(text), WORD_GAP, " ")


def text_key(norm: str) -> Column:
    """The 64-bit hash by which the index finds a text."""
    return F.xxhash64(norm)


def prefix(key: str, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit key."""
    return F.shiftrightunsigned(key, HASH_BITS - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int = BUCKET_KEYS) -> tuple[int, list[int]]:
    """(depth, bucket number for each of the 2**depth prefixes) such that no bucket holds over ``capacity`` keys.

    ``keys`` has one row per distinct key.  Counting starts two doublings short of the depth that evenly spread keys ask
    for; each doubling counts the overfull buckets alone.  About ``len(keys) / capacity`` counts reach the driver.
    """
    n = keys.count()
    depth = max(0, (n // max(capacity, 1)).bit_length() - 2)
    full = {r["p"]: r["n"] for r in keys.groupBy(prefix("key", depth).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    leaves = [(depth, p) for p in range(1 << depth)]
    overfull = [p for p, c in full.items() if c > capacity]
    while overfull and depth < HASH_BITS - 1:
        leaves = [e for e in leaves if e[0] < depth or e[1] not in set(overfull)]
        parents, depth = overfull, depth + 1
        counts = {r["p"]: r["n"] for r in
                  keys.filter(prefix("key", depth - 1).isin(*parents)).groupBy(prefix("key", depth).alias("p"))
                  .agg(F.count(F.lit(1)).alias("n")).collect()}
        halves = [2 * p + b for p in parents for b in (0, 1)]
        leaves += [(depth, h) for h in halves]
        overfull = [h for h in halves if counts.get(h, 0) > capacity]
    slots = [0] * (1 << depth)
    for number, (d, p) in enumerate(sorted(leaves, key=lambda e: e[1] << (HASH_BITS - e[0]))):
        slots[p << (depth - d):(p + 1) << (depth - d)] = [number] * (1 << (depth - d))
    return depth, slots


def with_bucket(rows: DataFrame, key: str, depth: int, slots: list[int]) -> DataFrame:
    """``rows`` with the bucket that owns each key: its prefix looked up in the directory."""
    table = rows.sparkSession.createDataFrame(list(enumerate(slots)), "slot long, bucket int")
    if len(slots) <= BROADCAST_SLOTS:
        table = F.broadcast(table)
    return rows.join(table, prefix(key, depth) == F.col("slot")).drop("slot")


def owned_chains(texts: DataFrame, depth: int, slots: list[int]) -> DataFrame:
    """Index entries (bucket, c_key, c_sha, keep_id, group_size) of ``texts`` (doc_id, key, norm), one per different text.

    The first grouping is by reading task and only thins copies out.  Then buckets and keys are dealt in ranges to owner
    tasks, and the grouping there needs no further exchange: an owner has all entries of its keys beside each other.
    """
    thin = (texts.groupBy(F.spark_partition_id().alias("task"), "key", "norm")
            .agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")))
    owners = min(max(slots, default=0) + 1, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # or several buckets each
    dealt = (with_bucket(thin, "key", depth, slots).repartitionByRange(owners, "bucket", "key")
             .sortWithinPartitions("bucket", "key", "norm"))
    return (dealt.groupBy("bucket", "key", "norm").agg(F.min("low").alias("keep_id"), F.sum("n").alias("group_size"))
            .select("bucket", F.col("key").alias("c_key"), F.unhex(F.sha2("norm", 256)).alias("c_sha"), "keep_id", "group_size"))


def dedup_exact(docs: DataFrame, capacity: int = BUCKET_KEYS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns ignored): doc_id, keep_id, group_size, kept, text_sha256.

    Of equal normalised texts the row with the smallest doc_id stays; ``keep_id`` is that doc_id, ``group_size`` the
    number of rows in the group.  A null text counts as empty.  A null doc_id loses to every other; of rows that
    repeat both the doc_id and the text one stays, so ``kept`` is true once per group.  An empty table gives no rows.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("norm"))
    entries = written(
        source.select("doc_id", text_key("norm").alias("key"), F.unhex(F.sha2("norm", 256)).alias("sha"),
                      F.monotonically_increasing_id().alias("row")), "dedup-entries")
    keys = written(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "dedup-keys")
    depth, slots = directory(keys, capacity)

    # Chains: rows whose key is shared bring their texts; within a bucket the grouping compares whole texts.
    shared = keys.filter("n > 1").select("key")
    if shared.count() <= broadcast_keys:
        shared = F.broadcast(shared)
    texts = source.withColumn("key", text_key("norm")).join(shared, "key", "left_semi")
    chains = written(owned_chains(texts, depth, slots), "dedup-index")

    # Rows that repeat a doc_id and a text: the first one counts.
    again = (entries.groupBy("key", "sha", F.col("doc_id").alias("r_id"))
             .agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("times")).filter("times > 1")
             .select(F.col("key").alias("r_key"), F.col("sha").alias("r_sha"), "r_id", "first_row"))
    return (entries.join(chains, (F.col("key") == F.col("c_key")) & (F.col("sha") == F.col("c_sha")), "left")
            .join(again, (F.col("key") == F.col("r_key")) & (F.col("sha") == F.col("r_sha"))
                  & F.col("doc_id").eqNullSafe(F.col("r_id")), "left")
            .select("doc_id",
                    F.when(F.col("c_key").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    F.lower(F.hex("sha")).alias("text_sha256"), "row", "first_row")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))
                        & (F.col("first_row").isNull() | (F.col("row") == F.col("first_row"))))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def keep_first(docs: DataFrame, capacity: int = BUCKET_KEYS) -> DataFrame:
    """The rows of ``docs`` that ``dedup_exact`` keeps, with all their columns, whatever these are called."""
    found = written(dedup_exact(docs, capacity), "dedup-result")
    sha, d_id, d_sha = free_names(docs, "sha", "d_id", "d_sha")
    # Texts of which a row goes, by doc_id; where one of several equal rows stays, all but one of them go.
    state = written(found.groupBy(F.col("doc_id").alias(d_id), F.col("text_sha256").alias(d_sha))
                    .agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("times")).filter("not stays or times > 1"), "dedup-go")
    again = state.filter("stays").select(d_id, d_sha)
    go = state.select(d_id, d_sha)
    go = F.broadcast(go) if state.count() <= BROADCAST_ROWS else go
    rows = docs.withColumn(sha, F.sha2(normalised(), 256))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(d_id)) & (F.col(sha) == F.col(d_sha))
    once = rows.join(go, same, "left_anti")
    if again.isEmpty():
        return once.drop(sha)
    return once.unionByName(rows.join(again, same, "left_semi").dropDuplicates(["doc_id", sha])).drop(sha)
