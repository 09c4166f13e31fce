"""News preparation, exact stratified splits and dataset profile.

Split and subset are exact per stratum, reproducible for any partitioning,
and rank almost no rows:

1. ``h`` = seeded 32-bit md5 draw of the row id; bucket ``b = h >> 16``.
2. Rows are counted per ``(stratum, b)`` (map-side combine); running sums give
   each bucket's offset, so for every cut ``k`` (a rank in ``(h, id)`` order) the
   bucket that holds it is known: one per stratum and cut.
3. Rows of earlier and later buckets are decided by comparing ``b`` with the cut
   bucket, next to the scan and without a shuffle.
4. Only the rows of the cut buckets (about 1 in 65,536) are ranked by a window
   over ``(stratum, b)``, as ids and draws; the rest of the row stays at the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslab import schema as S
from newslab.functions import text as X
from newslab.functions.draws import draw
from newslab.sources.views import news_raw

# ---------------------------------------------------------------------------
# P1 - P7
# ---------------------------------------------------------------------------


def rename_news(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"judul": "text", "sentimen": "label", "tanggal": "date"})


def normalise_labels(df: DataFrame) -> DataFrame:
    """P2 + P3 + P4: normalise, keep the known domain (null is dropped), encode."""
    out = df.withColumn("label", X.normalise_label(F.col("label")))
    out = out.filter(F.col("label").isin(*S.LABELS))
    return out.withColumn("label_id", X.label_id(F.col("label")))


def with_clean_text(df: DataFrame, col: str = "text") -> DataFrame:
    out = df.withColumn("clean_text", X.clean_text(F.col(col)))
    return out.withColumn("words", X.word_count(F.col("clean_text")))


def filter_min_words(df: DataFrame, n: int = S.MIN_WORDS) -> DataFrame:
    return df.filter(F.col("words") >= n)


def prepare_news(raw: DataFrame, min_words: int = S.MIN_WORDS) -> DataFrame:
    """P1-P6 on a raw headline table (``judul``, ``tanggal``, ``sentimen``).

    The cleaned text is generated, not projected: filters on it stay above the
    generator, so the cleaning chain runs once per row, after the label test,
    and not again in a pushed-down copy of the word filter.
    """
    df = normalise_labels(rename_news(raw))
    df = df.select("*", F.explode(F.array(X.clean_text(F.col("text")))).alias("clean_text"))
    return filter_min_words(df.withColumn("words", X.word_count(F.col("clean_text"))), min_words)


def news(spark: SparkSession, sf_dir: str, dated: bool = True) -> DataFrame:
    """Prepared news: news_id, text, label, label_id, clean_text, words, source and, if ``dated``, created_at."""
    return prepare_news(news_raw(spark, sf_dir, labelled_only=True, dated=dated)).select(
        F.col("doc_id").alias("news_id"), "text", "label", "label_id", "clean_text", "words", "source",
        *(["created_at"] if dated else []),
    )


# ---------------------------------------------------------------------------
# D1 - D3
# ---------------------------------------------------------------------------


#: Strata whose cuts are broadcast (a few numbers each); beyond, the same join is shuffled.
BROADCAST_STRATA = 10_000
#: Ranked rows of cut buckets (stratum, id and rank) that are broadcast if their ids are unique; else these few rows are
#: shuffled whole.
BROADCAST_RANKS = 1_000_000


def stratified_part(df: DataFrame, strata: Sequence[str], id_col: str, cuts: Sequence[Callable[[Column], Column]],
                    seed: int = S.SEED) -> DataFrame:
    """Add ``_part``: how many of the cuts lie before the row's exact rank in its stratum (seeded hash order).

    ``cuts`` map a stratum's size to the last rank before the cut, in rising order.
    """
    strata = list(strata)
    keyed = df.withColumn("_h", draw(seed, F.col(id_col))).withColumn("_b", F.shiftright(F.col("_h"), 16))
    per_bucket = keyed.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*strata).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = per_bucket.select(
        *strata, "_b", "_cnt", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_before"),
        F.sum("_cnt").over(Window.partitionBy(*strata)).alias("_n"))
    aggs = []
    for i, cut in enumerate(cuts):
        open_ = F.col("_before") + F.col("_cnt") > cut(F.col("_n"))  # buckets not wholly before the cut
        aggs += [F.min(F.when(open_, F.col("_b"))).alias(f"_b{i}"),
                 F.max(F.when(open_, cut(F.col("_n")) - F.col("_before"))).alias(f"_in{i}"),
                 F.min_by(F.when(open_, F.col("_cnt")), F.when(open_, F.col("_b"))).alias(f"_size{i}")]
    table = buckets.groupBy(*strata).agg(*aggs).select(
        *[F.col(c).alias(f"_s{k}") for k, c in enumerate(strata)],
        *[f"_{p}{i}" for i in range(len(cuts)) for p in ("b", "in", "size")])
    rows = table.limit(BROADCAST_STRATA + 1).collect()
    known = len(rows) <= BROADCAST_STRATA
    if known:
        table = F.broadcast(df.sparkSession.createDataFrame(rows, table.schema))
    cut_rows = sum(r[f"_size{i}"] or 0 for r in rows for i in range(len(cuts)))
    placed = keyed.join(table, _same([(c, f"_s{k}") for k, c in enumerate(strata)]))

    def divides(i: int) -> Column:  # the row is in the i-th cut's bucket, and the cut lies inside it
        return F.coalesce((F.col("_b") == F.col(f"_b{i}")) & (F.col(f"_in{i}") > 0), F.lit(False))

    divided = reduce(lambda a, b: a | b, [divides(i) for i in range(len(cuts))])
    part = reduce(lambda a, b: a + b, [
        F.when(divides(i), (F.col("_rank") > F.col(f"_in{i}")).cast("int"))
        .otherwise(F.coalesce(F.col("_b") >= F.col(f"_b{i}"), F.lit(False)).cast("int")) for i in range(len(cuts))])
    in_bucket = Window.partitionBy(*strata, "_b").orderBy("_h", id_col)
    number = F.row_number().over(in_bucket).alias("_rank")
    ranks = placed.filter(divided).select(*[F.col(c).alias(f"_r{k}") for k, c in enumerate(strata)], F.col(id_col).alias("_id"), number)
    named = [*[f"_r{k}" for k in range(len(strata))], "_id"]
    # Ranks find their rows by stratum and id only where these name one row each; repeated ids are ranked row by row.
    if known and cut_rows <= BROADCAST_RANKS and ranks.groupBy(*named).count().filter("count > 1").isEmpty():
        out = placed.join(F.broadcast(ranks), _same(list(zip([*strata, id_col], named))), "left").drop(*named)
    else:
        out = placed.filter(~divided).withColumn("_rank", F.lit(None).cast("int")).unionByName(
            placed.filter(divided).select("*", number))
    return out.select(*df.columns, part.alias("_part"))


def _same(pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in pairs])


def stratified_split(df: DataFrame, strata: Sequence[str] = ("label",), id_col: str = "news_id",
                     fracs: Sequence[int] = S.SPLIT_FRACTIONS, seed: int = S.SEED) -> DataFrame:
    """Exact per-stratum train / val / test by integer cuts (``rank * 10 <= n * 8``)."""
    total = sum(fracs)
    names = F.array(F.lit("train"), F.lit("val"), F.lit("test"))
    out = stratified_part(df, strata, id_col, [lambda n, k=sum(fracs[:i + 1]): _div(n * k, total) for i in range(2)], seed)
    return out.withColumn("split", F.get(names, F.col("_part"))).drop("_part")


def _div(a: Column, b: int) -> Column:
    """Whole-number division of non-negative longs."""
    return ((a - a % b) / b).cast("long")


def subset_size(n: Column, num: int, den: int, rounding: str = "floor") -> Column:
    """Per-stratum subset size with integer arithmetic.

    ``floor``: ``max(1, floor(n*num/den))``; ``nearest``: half-even rounding
    of ``n*num/den`` (what a fractional sample of a group does).
    """
    q = _div(n * num, den)
    if rounding == "floor":
        return F.greatest(F.lit(1).cast("long"), q)
    rem = (n * num) - q * den
    up = (rem * 2 > den) | ((rem * 2 == den) & (q % 2 == 1))
    return q + F.when(up, F.lit(1)).otherwise(F.lit(0))


def stratified_subset(df: DataFrame, strata: Sequence[str] = ("label",), id_col: str = "news_id",
                      frac: tuple[int, int] = S.SUBSET_FRACTION, seed: int = S.SEED,
                      rounding: str = "floor") -> DataFrame:
    """The first ``k`` rows of each stratum in seeded hash order."""
    parts = stratified_part(df, strata, id_col, [lambda n: subset_size(n, frac[0], frac[1], rounding)], seed)
    return parts.filter(F.col("_part") == 0).drop("_part")


# ---------------------------------------------------------------------------
# A13
# ---------------------------------------------------------------------------


def dataset_profile(split_df: DataFrame) -> DataFrame:
    """Counts by (split), (label), (split, label) and () in one aggregation."""
    return split_df.groupingSets(
        [["split"], ["label"], ["split", "label"], []], "split", "label"
    ).agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"))
