"""News intelligence: features, counts, dominant sentiment, briefing, dashboard.

Per-ticker work is two partial-aggregatable steps (``explode`` then
``groupBy(ticker, sentiment)`` then ``min(struct)`` per ticker), so a ticker
that appears in a third of all rows is combined map-side and never collected
into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslab import schema as S
from newslab.functions import text as X
from newslab.operators.encode import global_rank
from newslab.sources import files


def news_features(df: DataFrame, text_col: str = "text", positive: Sequence[str] = S.POSITIVE_WORDS,
                  negative: Sequence[str] = S.NEGATIVE_WORDS,
                  tickers: Sequence[str] = tuple(t for t, _ in S.TICKERS)) -> DataFrame:
    """Sentiment, confidence, tickers and signal per row (F7 + F5 + F6)."""
    clean = F.col("clean_text") if "clean_text" in df.columns else X.clean_text(F.col(text_col))
    sentiment, confidence = X.lexicon_sentiment(clean, positive, negative)
    out = df.withColumns(
        {
            "tickers": X.detect_tickers(F.col(text_col), tickers),
            "sentiment": sentiment,
            "confidence": confidence,
        }
    )
    return out.withColumn("signal", X.signal(F.col("sentiment"), F.col("confidence")))


def _domain(spark: SparkSession) -> DataFrame:
    rows = [(i, name) for i, name in enumerate(S.REPORT_ORDER)]
    return spark.createDataFrame(rows, "ord INT, sentiment STRING")


def sentiment_counts(df: DataFrame) -> DataFrame:
    """Counts in fixed report order with zero fill (domain table left join)."""
    counts = df.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"))
    dom = F.broadcast(_domain(df.sparkSession))  # three fixed rows
    return dom.join(counts, "sentiment", "left").select(
        "ord", "sentiment", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")
    )


def dashboard_stats(df: DataFrame) -> DataFrame:
    """One row; unknown sentiments count in the total only."""
    return df.agg(
        F.count_if(F.col("sentiment") == "positif").alias("positif"),
        F.count_if(F.col("sentiment") == "negatif").alias("negatif"),
        F.count_if(F.col("sentiment") == "netral").alias("netral"),
        F.count(F.lit(1)).alias("total"),
    )


def ticker_sentiment_counts(df: DataFrame, seq_col: str = "news_id") -> DataFrame:
    """Per (ticker, sentiment) the count and first appearance; tickers ordered by first appearance.

    This is the bounded form of "sentiments collected per ticker": the list
    itself would grow with the data, its counts do not.
    """
    exploded = df.select(F.col(seq_col).alias("seq"), F.explode("tickers").alias("ticker"), "sentiment")
    per = exploded.groupBy("ticker", "sentiment").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"))
    first = per.groupBy("ticker").agg(F.min("first_seq").alias("ticker_first_seq"))
    return per.join(first, "ticker")


#: Sentiments on one page of a ticker's list.
PAGE_ROWS = 1000


def ticker_sentiment_pages(df: DataFrame, seq_col: str = "news_id", page_rows: int = PAGE_ROWS) -> DataFrame:
    """The sentiments of every ticker in order of appearance, in numbered pages: (ticker, page, sentiments).

    A range sort by ticker and appearance gives each mention its place (sums over ranges, then inside a range), so a hot
    ticker is many tasks' work and no list holds more than ``page_rows``.  Null sequence numbers come first; mentions with
    the same one follow the sentiment.
    """
    order = ["ticker", "seq", "sentiment", "tie"]
    spread = df.select(F.col(seq_col).alias("seq"), F.explode("tickers").alias("ticker"), "sentiment").withColumn("tie", F.monotonically_increasing_id())
    ranked = global_rank(spread, order)
    first = ranked.groupBy("ticker").agg(F.min("rank").alias("first_rank")).withColumnRenamed("ticker", "f_ticker")
    place = F.col("rank") - F.col("first_rank")
    placed = ranked.join(first, F.col("ticker").eqNullSafe(F.col("f_ticker"))).select(
        "ticker", F.expr(f"(rank - first_rank) div {page_rows}").alias("page"), place.alias("place"), "sentiment")
    pages = placed.groupBy("ticker", "page").agg(F.array_sort(F.collect_list(F.struct("place", "sentiment"))).alias("rows"))
    return pages.select("ticker", "page", F.transform("rows", lambda r: r["sentiment"]).alias("sentiments"))


def ticker_dominant(df: DataFrame, seq_col: str = "news_id") -> DataFrame:
    """A8 + W6: most frequent sentiment per ticker, ties to the smallest value."""
    exploded = df.select(F.col(seq_col).alias("seq"), F.explode("tickers").alias("ticker"), "sentiment")
    per = exploded.groupBy("ticker", "sentiment").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("s"))
    best = per.groupBy("ticker").agg(
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("sentiment"))).alias("m"),
        F.sum("n").alias("mentions"),
        F.min("s").alias("first_seq"),
    )
    return best.select(
        "ticker", F.col("m.sentiment").alias("dominant"), (-F.col("m.neg_n")).alias("dominant_n"), "mentions",
        "first_seq",
    )


def market_briefing(features: DataFrame, seq_col: str = "news_id") -> DataFrame:
    """Ordered briefing rows ``(section, ord, key, value)``.

    total; counts in fixed order; dominant sentiment per ticker in order of
    first appearance, or one "No ticker detected" row.

    One pass over the rows: they are aggregated by (sentiment, ticker set),
    a table bounded by 3 x the number of distinct ticker subsets, and every
    section is derived from that small table.
    """
    combos = features.groupBy("sentiment", "tickers").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col(seq_col)).alias("s")
    )
    # Each section reads a different column subset, which would give each its
    # own copy of the scan; pin the small aggregate once (reliable checkpoint
    # in the shared folder) so the rows are read and featurised a single time.
    combos = combos.checkpoint(eager=True)
    total = combos.agg(F.sum("n").alias("n")).select(
        F.lit("total").alias("section"), F.lit(0).alias("ord"), F.lit("total").alias("key"),
        F.coalesce(F.col("n"), F.lit(0)).cast("string").alias("value"),
    )
    per_sentiment = combos.groupBy("sentiment").agg(F.sum("n").alias("n"))
    dom_table = F.broadcast(_domain(features.sparkSession))  # three fixed rows
    counts = dom_table.join(per_sentiment, "sentiment", "left").select(
        F.lit("sentiment").alias("section"), (F.col("ord") + 1).alias("ord"), F.col("sentiment").alias("key"),
        F.coalesce(F.col("n"), F.lit(0)).cast("string").alias("value"),
    )
    per = combos.select("s", F.explode("tickers").alias("ticker"), "sentiment", "n").groupBy(
        "ticker", "sentiment").agg(F.sum("n").alias("n"), F.min("s").alias("s"))
    dom = per.groupBy("ticker").agg(
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("sentiment"))).alias("m"), F.min("s").alias("first_seq")
    )
    # The ticker table is bounded by the dictionary size, so a global order is cheap.
    ranked = dom.select(
        F.lit("ticker").alias("section"),
        F.row_number().over(Window.orderBy("first_seq", "ticker")).alias("ord"),
        F.col("ticker").alias("key"),
        F.col("m.sentiment").alias("value"),
    )
    none_row = (
        dom.agg(F.count(F.lit(1)).alias("k"))
        .filter(F.col("k") == 0)
        .select(F.lit("ticker").alias("section"), F.lit(1).alias("ord"), F.lit("none").alias("key"),
                F.lit("No ticker detected").alias("value"))
    )
    return total.unionByName(counts).unionByName(ranked).unionByName(none_row)


def recent_from_store(spark: SparkSession, store: str, n: int = S.RECENT_ROWS, ts: str = "created_at", id_col: str = "seq") -> DataFrame:
    """K2 on the news store: the newest ``n`` rows, reading only as many of the newest days as hold them.

    Days are the store's partitions; their rows are counted newest first, a few at a time (counts come from file footers),
    until there are enough.  Rows without a time come last and are read only if all dated rows are too few.
    """
    days = files.store_days(spark, store)
    use: list[str | None] = []
    rows, step = 0, 1
    while days and rows < n:
        take, days, step = days[:step], days[step:], 2 * step
        use += take
        rows += files.load_news_store(spark, store, take).count()
    return recent(files.load_news_store(spark, store, use or None), n, ts, id_col)


def recent(df: DataFrame, n: int = S.RECENT_ROWS, ts: str = "created_at", id_col: str = "news_id") -> DataFrame:
    """K2: newest ``n`` rows, id as tie-break (plans as TakeOrderedAndProject)."""
    return df.orderBy(F.col(ts).desc_nulls_last(), F.col(id_col).desc()).limit(n)


def dashboard_read(df: DataFrame, n: int = S.RECENT_ROWS, ts: str = "created_at", id_col: str = "news_id") -> DataFrame:
    """The recent rows plus the dashboard stats computed over those same rows."""
    top = recent(df, n, ts, id_col)
    w = Window.partitionBy()  # at most n rows
    return top.select(
        "*",
        F.count_if(F.col("sentiment") == "positif").over(w).alias("positif"),
        F.count_if(F.col("sentiment") == "negatif").over(w).alias("negatif"),
        F.count_if(F.col("sentiment") == "netral").over(w).alias("netral"),
        F.count(F.lit(1)).over(w).alias("total"),
    )


def daily_sentiment(df: DataFrame, ts: str = "created_at") -> DataFrame:
    """Counts per day and sentiment, pivoted in fixed order with zero fill; undated rows count under a null day."""
    day = F.date_format(F.col(ts), "yyyy-MM-dd").alias("day")
    piv = df.groupBy(day).pivot("sentiment", list(S.REPORT_ORDER)).count()
    return piv.select("day", *(F.coalesce(F.col(s), F.lit(0)).cast("long").alias(s) for s in S.REPORT_ORDER))
