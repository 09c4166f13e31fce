"""Operator 8, mixing sources to target weights over a time-varying curriculum.

DataFrame operations only.  Each source gets a share of the budget by weight, never more than ``max_repeats`` times
its size.  Its weight over training time t in [0, 1] is a linear schedule; the integral of the schedule is the
source's cumulative token demand, and inverting it turns a document's place in its source into a training position.
Places are prefix sums in two levels (totals per hash range, then sums within a range), so no source is ever in one
task.  The copies are range-sorted by position into one schedule, numbered from 0; what the mix takes of a document is what
the schedule holds of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslab.functions.text import free_names
from newslab.llm.common import WORD_GAP, text_or_empty, written

MAX_REPEATS = 3
#: Number of values of ``order_hash``.
HASHES = 1 << 60
#: Rows per (source, hash range) that one window sums; the number of ranges follows the input.
RANGE_ROWS = 50_000
#: Weight at the start and end of training for sources of weight 1, 2 and 3.
SCHEDULES = ((2.0, 0.5), (1.0, 1.0), (0.5, 2.0))


def order_hash(doc_id: Column, seed: int) -> Column:
    """60 bits of an md5 of seed and doc_id: the seeded order of a source's documents, the same on every engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    """Number of maximal runs of other characters than ASCII white space."""
    gone = F.regexp_replace(text, "[^\\x20\\x09-\\x0D]+", "w")
    return (F.length(gone) - F.length(F.replace(gone, F.lit("w"), F.lit("")))).cast("long")


def sums_before(table: DataFrame, order: list[Column], columns: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``table`` with ``<column>_before``: the sum of the column over the rows before in ``order``, which has no ties.

    Two levels: totals per range of the order (one row per ``range_rows`` rows reaches the driver), then sums within a range.
    """
    n_ranges = max(1, table.count() // range_rows)
    parts = written(table.repartitionByRange(n_ranges, *order).withColumn("part", F.spark_partition_id()), "mix-sources")
    starts, at = [], [0.0] * len(columns)
    for r in sorted(parts.groupBy("part").agg(*[F.sum(c).cast("double") for c in columns]).collect()):
        starts.append((r[0], *at))
        at = [a + b for a, b in zip(at, r[1:])]
    starts = table.sparkSession.createDataFrame(starts, ", ".join(["p_part int", *[f"{c}_start double" for c in columns]]))
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (parts.join(F.broadcast(starts), F.col("part") == F.col("p_part"))
            .select(*table.columns, *[(F.col(f"{c}_start") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(f"{c}_before")
                                      for c in columns]))


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS, weights: int = 3, range_rows: int = RANGE_ROWS) -> DataFrame:
    """source, source_size, weight, target from (source, source_size), one row per source.

    Sources by code point, null last, weigh 1..``weights``, repeating.  Sharing by weight, with the excess of full
    sources shared again until none is above ``max_repeats`` times its size, has the limit min(cap, weight * level):
    the level follows from prefix sums over the sources in the order in which they fill up.
    """
    by_name = F.col("source").asc_nulls_last()
    sizes = written(sizes.withColumn("one", F.lit(1)), "mix-source-sizes")
    weighed = (sums_before(sizes, [by_name], ["one"], range_rows)
               .withColumn("weight", F.col("one_before") % weights + 1)
               .withColumn("cap", (F.col("source_size") * max_repeats).cast("double"))
               .withColumn("fill", F.col("cap") / F.col("weight")).select("source", "source_size", "weight", "cap", "fill"))
    weighed = written(weighed, "mix-weights")
    total, weight = weighed.agg(F.sum("source_size").cast("double"), F.sum("weight")).first()
    # Of the sources that the level would not fill, the first in filling order has the true level, the others a lower one.
    filled = sums_before(weighed, [F.col("fill").asc(), by_name], ["cap", "weight"], range_rows).withColumn(
        "level", (F.lit(total) - F.col("cap_before")) / (F.lit(weight) - F.col("weight_before")))
    level = filled.agg(F.max(F.when(F.col("fill") >= F.col("level"), F.col("level")))).first()[0]
    return weighed.select("source", "source_size", "weight",
                          F.least(F.col("cap"), F.col("weight") * F.lit(level).cast("double")).alias("target"))


def invert_demand(share: Column, start: Column, end: Column) -> Column:
    """Time t at which the fraction ``share`` of a source's demand is met: integral of start + (end - start) t, inverted."""
    root = F.sqrt(start * start + (end * end - start * start) * share)
    return share * (start + end) / (start + root)


def plan_mix(docs: DataFrame, seed: int = 17, max_repeats: int = MAX_REPEATS, range_rows: int = RANGE_ROWS,
             schedules=SCHEDULES, row: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text; other columns ignored).

    doc_id, source, size, source_size, target, taken, and ``copies``: an array of (epoch, words, position), one entry
    per copy taken, position in [0, 1].  Within a source, documents follow a seeded hash of doc_id, then doc_id, size and
    a hash of the text; the mix runs through them up to ``max_repeats`` times until the rounded target is met, so the last
    copy may be cut.  ``row`` names a column of ``docs`` with a number per row, which is then returned as well.

    Null text has size 0 and is never taken; a null source is a source of its own; a null doc_id counts as an empty
    string in the hash; equal rows each take their own place; an empty table, or one without words, takes nothing.
    """
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                               word_count(text_or_empty()).alias("size"), F.xxhash64(text_or_empty()).alias("text_hash"),
                               (F.col(row) if row else F.monotonically_increasing_id()).alias("tie"))
                   .withColumn("h", order_hash(F.col("doc_id"), seed)), "mix-sizes")
    n_ranges = max(1, rows.count() // range_rows)
    rows = rows.withColumn("range", F.expr(f"h div {-(-HASHES // n_ranges)}L"))
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    ranges = written(ranges, "mix-ranges")
    targets = source_targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), max_repeats, len(schedules), range_rows)
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranges.withColumn("range_start", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)))
               .join(targets.withColumnRenamed("source", "t_source"), F.col("source").eqNullSafe(F.col("t_source")))
               .select(F.col("t_source"), F.col("range").alias("t_range"), "range_start", "source_size", "weight", "target"))
    within = (Window.partitionBy("source", "range").orderBy("h", "doc_id", "size", "text_hash", "tie")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (rows.withColumn("in_range", F.coalesce(F.sum("size").over(within), F.lit(0)))
              .join(offsets, F.col("source").eqNullSafe(F.col("t_source")) & (F.col("range") == F.col("t_range")))
              .withColumn("place", F.col("range_start") + F.col("in_range"))
              .withColumn("quota", F.round("target").cast("long")))
    pick = lambda i: F.element_at(F.array(*[F.lit(s[i]) for s in schedules]), F.col("weight").cast("int"))

    def copy(epoch: int) -> Column:
        first = F.col("source_size") * epoch + F.col("place")
        words = F.greatest(F.least(F.col("size"), F.col("quota") - first), F.lit(0).cast("long"))
        share = F.least(first / F.greatest(F.col("quota"), F.lit(1)), F.lit(1.0))
        return F.struct(F.lit(epoch).alias("epoch"), words.alias("words"), invert_demand(share, pick(0), pick(1)).alias("position"))

    copies = F.filter(F.array(*[copy(e) for e in range(max_repeats)]), lambda c: c["words"] > 0)
    return (placed.withColumn("copies", copies)
            .withColumn("taken", F.aggregate("copies", F.lit(0).cast("long"), lambda acc, c: acc + c["words"]))
            .select("doc_id", "source", "size", "source_size", "target", "taken", "copies",
                    *([F.col("tie").alias(row)] if row else [])))


_POS_BITS = 33  # monotonically_increasing_id: partition << 33 | row in it


def schedule(plan: DataFrame, row: str | None = None) -> DataFrame:
    """The training order: (ordinal, position, doc_id, source, epoch, words) per copy, and ``row`` if the plan has it.

    Copies are range-sorted by position, then doc_id, row and epoch; a range's first ordinal is the number of copies in the
    ranges before it (one count per range reaches the driver).
    """
    more = [row] if row else []
    copies = plan.select(*more, "doc_id", "source", F.explode("copies").alias("c")).select(*more, "c.position", "doc_id", "source", "c.epoch", "c.words")
    spark = plan.sparkSession
    keys = ["position", "doc_id", *more, "epoch"]
    ordered = written(copies.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)
                      .withColumn("s_id", F.monotonically_increasing_id()), "mix-schedule")
    part = F.shiftright("s_id", _POS_BITS)
    starts, at = [], 0
    for r in sorted(ordered.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()):
        starts.append((r["p"], at - (r["p"] << _POS_BITS)))
        at += r["n"]
    starts = spark.createDataFrame(starts, "s_part long, shift long")
    return (ordered.join(F.broadcast(starts), part == F.col("s_part"))
            .select((F.col("s_id") + F.col("shift")).alias("ordinal"), "position", *more, "doc_id", "source", "epoch", "words")
            .orderBy("ordinal"))


def mix_documents(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """``plan_mix`` with ``taken`` summed, and ``first_ordinal`` taken, from the schedule: one row per row of ``docs``.

    A document that the schedule doesn't hold has taken 0 and first_ordinal null.  Edge cases as in ``plan_mix``.
    """
    rows = docs.select("doc_id", "source", "text").withColumn("m_row", F.monotonically_increasing_id())
    plan = written(plan_mix(rows, seed, row="m_row", **options).drop("taken"), "mix-plan")
    held = (schedule(plan, "m_row").groupBy(F.col("m_row").alias("h_row"))
            .agg(F.sum("words").alias("words"), F.min("ordinal").alias("first_ordinal")))
    return (plan.join(held, F.col("m_row") == F.col("h_row"), "left")
            .select("doc_id", "source", "size", "source_size", "target", F.coalesce("words", F.lit(0).cast("long")).alias("taken"), "copies", "first_ordinal"))


def mixed_rows(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The rows of ``docs``, with all columns, once per copy that the mix takes, range-sorted by training position.

    A copy that the quota cuts is whole here if at least half of it is taken and else left out.  The rows are written
    once with a number each, by which the plan finds them, so rows that share a doc_id keep their own copies.
    """
    row, p_row, copies, copy = free_names(docs, "row", "p_row", "copies", "copy")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "mix-input")
    plan = plan_mix(rows, seed, row=row).filter("taken > 0")
    plan = written(plan.select(F.col(row).alias(p_row), F.filter("copies", lambda c: 2 * c["words"] >= F.col("size")).alias(copies)), "mix-plan")
    return (rows.join(plan, F.col(row) == F.col(p_row))
            .select(*[F.col(c) for c in docs.columns], F.explode(copies).alias(copy))
            .orderBy(F.col(copy)["position"], "doc_id", F.col(copy)["epoch"]).drop(copy))
