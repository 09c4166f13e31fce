"""Registered queries: one Spark DataFrame builder per operator key.

Every builder takes ``(spark, sf_dir)`` and reads the supplied tables (or
tables Spark derived from them), whole.  Column names equal those of the
matching oracle SQL in ``newslab.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslab import schema as S
from newslab.functions import text as X
from newslab.operators import ingest as I
from newslab.operators import intel as N
from newslab.operators import metrics as M
from newslab.operators import prepare as P
from newslab.operators import search as G
from newslab.plans import context as C
from newslab.session import scratch_path
from newslab.sources import files
from newslab.sources.tables import read_table
from newslab.sources.views import news_raw

Q = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Q] = {}


def query(fn: Q) -> Q:
    REGISTRY[fn.__name__] = fn
    return fn


def _scored(spark, d) -> DataFrame:
    """Prepared news with lexicon sentiment and prediction id."""
    sentiment, confidence = X.lexicon_sentiment(F.col("clean_text"), C.POSITIVE, C.NEGATIVE)
    df = C.news(spark, d).withColumns({"sentiment": sentiment, "confidence": confidence})
    return df.withColumn("pred_id", X.label_id(F.col("sentiment")))


def _features(spark, d) -> DataFrame:
    return N.news_features(C.news(spark, d), "text", C.POSITIVE, C.NEGATIVE, C.TICKER_WORDS)


def _split(spark, d) -> DataFrame:
    return P.stratified_split(C.news(spark, d), ("label",), "news_id")

# --------------------------------------------------------------------------- ETL


@query
def news_etl_summary(spark, d):
    """N5 (flagship): documents and total words per label after cleaning, plus the total row."""
    n = P.news(spark, d, dated=False)
    return n.rollup("label").agg(F.count(F.lit(1)).alias("documents"), F.sum("words").alias("total_words"))


@query
def scan_csv_roundtrip(spark, d):
    raw = news_raw(spark, d).select("doc_id", "judul", "tanggal", "sentimen")
    path = scratch_path(spark, "raw-news-csv")
    files.write_news_csv(raw, path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *S.RAW_NEWS.fields])
    return files.read_news(spark, path, schema)


@query
def scan_csv_tolerant(spark, d):
    """S1 over a table with broken records (every tenth document adds one): good rows, and the quarantined records."""
    raw = news_raw(spark, d, dated=False).select("doc_id", "judul", F.lit(None).cast("string").alias("tanggal"), "sentimen", "source")
    path, quarantine = scratch_path(spark, "broken-csv"), scratch_path(spark, "csv-quarantine")
    files.write_news_csv(raw.drop("source"), f"{path}/good")
    files.write_news_csv(raw.filter("doc_id % 10 = 0").select(F.concat(F.lit("x"), F.col("doc_id")).alias("doc_id"), "source"), f"{path}/broken")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *S.RAW_NEWS.fields])
    good = files.read_news_tolerant(spark, f"{path}/*", quarantine, schema)
    broken = spark.read.schema("record string, file string").parquet(quarantine)
    return good.select("doc_id", "judul", "sentimen", F.lit(None).cast("string").alias("record")).unionByName(
        broken.select("record"), allowMissingColumns=True)


@query
def sql_label_counts(spark, d):
    P.news(spark, d, dated=False).createOrReplaceTempView("stock_news")
    return spark.sql("SELECT label, COUNT(*) AS count FROM stock_news GROUP BY label ORDER BY count DESC")


@query
def label_distribution(spark, d):
    return P.news(spark, d, dated=False).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query
def total_words(spark, d):
    return P.news(spark, d, dated=False).agg(
        F.coalesce(F.sum("words"), F.lit(0)).cast("long").alias("total_words"), F.count(F.lit(1)).alias("documents")
    )


@query
def news_prepare(spark, d):
    df = P.normalise_labels(P.rename_news(news_raw(spark, d)))
    return df.select("doc_id", "text", "date", "label", "label_id")


@query
def label_encode_decode(spark, d):
    df = P.normalise_labels(P.rename_news(news_raw(spark, d, dated=False)))
    return df.groupBy("label", "label_id", X.label_name(F.col("label_id")).alias("label_back")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def clean_text(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    return P.with_clean_text(docs).select("doc_id", "clean_text", "words")


@query
def word_count(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", X.word_count(X.clean_text(F.col("text"))).alias("words"))


@query
def min_words(spark, d):
    return P.news(spark, d, dated=False).select("news_id", "words")


@query
def split_records(spark, d):
    s = _split(spark, d)
    return s.select("news_id", F.col("clean_text").alias("text"), F.col("label_id").alias("labels"), "split")


@query
def stratified_split(spark, d):
    return _split(spark, d).select("news_id", "label", "split")


@query
def stratified_subset(spark, d):
    return C.proxy_news(spark, d).select("news_id", "label")


@query
def stratified_subset_rounded(spark, d):
    return P.stratified_subset(C.news(spark, d), ("label",), "news_id", S.SUBSET_FRACTION, S.SEED,
                               rounding="nearest").select("news_id", "label")


@query
def dataset_profile(spark, d):
    return P.dataset_profile(_split(spark, d))

# --------------------------------------------------------------------------- metrics


@query
def confusion(spark, d):
    return M.confusion(_scored(spark, d), "label_id", "pred_id")


@query
def weighted_metrics(spark, d):
    s = P.stratified_split(_scored(spark, d), ("label",), "news_id")
    return M.classification_metrics(s, "label_id", "pred_id", by=("split",))


@query
def compare_runs(spark, d):
    s = P.stratified_split(_scored(spark, d), ("label",), "news_id")
    return M.compare_groups(M.classification_metrics(s, "label_id", "pred_id", by=("split",)), "split", "train", "test")

# --------------------------------------------------------------------------- intelligence


@query
def lexicon_semi(spark, d):
    n = C.news(spark, d)
    clean = F.col("clean_text")
    hits = n.filter(X.lexicon_hit(clean, C.POSITIVE + C.NEGATIVE))
    return hits.select(
        "news_id", X.lexicon_count(clean, C.POSITIVE).alias("pos_hits"), X.lexicon_count(clean, C.NEGATIVE).alias(
            "neg_hits")
    )


@query
def lexicon_large_join(spark, d):
    """J3 with a lexicon table of any size: the words of the benchmark items, joined word by word."""
    words = read_table(spark, d, "benchmark").select(F.explode(X.tokens(X.clean_text(F.col("text")))).alias("word"))
    return X.lexicon_semi_join(C.news(spark, d).select("news_id", "clean_text", "label"), words).select("news_id", "label")


@query
def lexicon_sentiment(spark, d):
    return _scored(spark, d).select("news_id", "sentiment", "confidence")


@query
def detect_tickers(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", X.detect_tickers(F.col("text"), C.TICKER_WORDS).alias("tickers"))


@query
def detect_names(spark, d):
    """F5 with a dictionary table: the first three words of every benchmark item, searched in every document."""
    names = read_table(spark, d, "benchmark").select(
        F.col("item_id").alias("ord"), F.concat(F.lit("item-"), F.col("item_id")).alias("code"),
        F.array_join(F.slice(X.name_words(F.col("text")), 1, 3), " ").alias("name"))
    return X.detect_names(read_table(spark, d, "documents").select("doc_id", "text"), names)


@query
def sentiment_signal(spark, d):
    s = _scored(spark, d)
    return s.select("news_id", "sentiment", "confidence", X.signal(F.col("sentiment"), F.col("confidence")).alias(
        "signal"))


@query
def alert_text(spark, d):
    f = _features(spark, d)
    return f.select(
        "news_id",
        X.alert_text(F.col("text"), F.col("tickers"), F.col("sentiment"), F.col("confidence"), F.col("signal")).alias(
            "alert"),
    )


@query
def softmax_argmax(spark, d):
    emb = read_table(spark, d, "embeddings").select("vec_id", "embedding")
    logits = F.transform(F.slice(F.col("embedding"), 1, 3), lambda x: x.cast("double"))
    probs = X.softmax(logits)
    out = emb.select("vec_id", probs.alias("p"))
    return out.select(
        "vec_id",
        X.argmax(F.col("p")).cast("int").alias("pred_id"),
        X.label_name(X.argmax(F.col("p"))).alias("sentiment"),
        F.round(F.array_max("p") * 1e9).cast("long").alias("confidence_e9"),
    )


@query
def news_features(spark, d):
    return _features(spark, d).select("news_id", "tickers", "sentiment", "confidence", "signal")


@query
def sentiment_counts_filled(spark, d):
    return N.sentiment_counts(_features(spark, d))


@query
def dashboard_stats(spark, d):
    return N.dashboard_stats(_features(spark, d))


@query
def ticker_dominant(spark, d):
    return N.ticker_dominant(_features(spark, d))


@query
def ticker_sentiments(spark, d):
    return N.ticker_sentiment_counts(_features(spark, d))


@query
def ticker_sentiment_pages(spark, d):
    """Every ticker's sentiments in order of appearance, a thousand to a page."""
    return N.ticker_sentiment_pages(_features(spark, d))


@query
def market_briefing(spark, d):
    return N.market_briefing(_features(spark, d))


@query
def daily_sentiment(spark, d):
    return N.daily_sentiment(_scored(spark, d))


@query
def recent_news(spark, d):
    return N.recent(_scored(spark, d)).select("news_id", "created_at", "sentiment")


@query
def recent_from_store(spark, d):
    """K2 on the stored news: only the newest days' partitions are read."""
    store = scratch_path(spark, "news-recent")
    files.append_news(_scored(spark, d).select(F.col("news_id").alias("seq"), F.lit("").alias("title"), "sentiment", "created_at"), store, "run-1")
    return N.recent_from_store(spark, store).select(F.col("seq").alias("news_id"), "created_at", "sentiment")


@query
def dashboard_read(spark, d):
    s = _scored(spark, d).select("news_id", "created_at", "sentiment")
    return N.dashboard_read(s)


@query
def encode_tokens(spark, d):
    from newslab.operators.encode import build_vocab, encode

    n = C.news(spark, d)
    vocab = build_vocab(n)
    return encode(n, vocab, S.MAX_LENGTH)



#: A given sub-word vocabulary; its path is a parameter of the operator.
SUBWORDS = "/opt/tokenizers/word_bpe_49k.json"


@query
def encode_subwords(spark, d):
    """F14 with the sub-words of a given vocabulary (beyond SQL; the tests hold it against the library on whole texts)."""
    from newslab.operators.encode import encode_subwords

    return encode_subwords(C.news(spark, d), SUBWORDS)

# --------------------------------------------------------------------------- listings


def _pages(spark, d):
    return read_table(spark, d, "pages").select("page_id", "url", "html")


def _headlines(spark, d):
    return I.headlines_from_pages(_pages(spark, d), C.HEADLINE_RULES, C.MIN_TITLE)


_HEAD = ["page_id", "pos", "title", "url", "source"]


@query
def headlines_from_pages(spark, d):
    return _headlines(spark, d)


@query
def resolve_links(spark, d):
    p = _pages(spark, d)
    href = X.first_href(F.col("html"))
    return p.select("page_id", href.alias("href"), X.resolve_link(F.col("url"), href).alias("link"))


@query
def dedup_titles(spark, d):
    return I.dedup_titles(_headlines(spark, d))


@query
def cap_per_source(spark, d):
    return I.collect_headlines(_headlines(spark, d))


@query
def json_posts(spark, d):
    conv = read_table(spark, d, "conversations").select("conv_id", "turn", "text")
    posts = I.json_posts(I.feed_json(conv))
    kept = I.collect_headlines(posts, order=("conv_id", "pos"))
    return kept.select("conv_id", "pos", "title", "url")


@query
def json_posts_drift(spark, d):
    """S5 over listings of drifting shape: by conversation, titles that are numbers, no permalinks, children in an object,
    pages cut short."""
    conv = read_table(spark, d, "conversations").select("conv_id", "turn", "text")
    feeds = I.feed_json(conv).withColumn("j", F.from_json("json", S.JSON_FEED))
    kind = F.pmod("conv_id", F.lit(5))

    def page(child):
        """The page with every post replaced by ``child`` of its title and permalink."""
        posts = F.transform("j.data.children", lambda c: F.struct(child(c["data"]).alias("data")))
        return F.to_json(F.struct(F.struct(posts.alias("children")).alias("data")))

    drifted = (F.when(kind == 1, page(lambda d: F.struct(F.lit(12345678901234567).alias("title"), d["permalink"].alias("permalink"))))
               .when(kind == 2, page(lambda d: F.struct(d["title"].alias("title"))))
               .when(kind == 3, F.concat(F.lit('{"data":{"children":{"first":'), F.col("json"), F.lit("}}}")))
               .when(kind == 4, F.expr("left(json, length(json) - 3)")).otherwise(F.col("json")))
    return I.json_posts_of_any_shape(feeds.withColumn("json", drifted)).select("conv_id", "pos", "title", "url")


def _events_time(spark, d):
    return read_table(spark, d, "events").select(F.col("event_id").alias("page_id"), F.col("ts").alias("created_at"))


@query
def ingest_score_store(spark, d):
    heads = I.collect_headlines(_headlines(spark, d))
    scored = I.score_items(heads, C.POSITIVE, C.NEGATIVE).join(_events_time(spark, d), "page_id", "left")
    store = scratch_path(spark, "news-store")
    files.append_news(scored, store, "run-1")
    out = files.load_news_store(spark, store)
    return out.select(*_HEAD, "sentiment", "confidence", "badge", "created_at",
                      F.date_format(F.col("date"), "yyyy-MM-dd").alias("date"))


@query
def sink_news_roundtrip(spark, d):
    s = _scored(spark, d).select(F.col("news_id").alias("seq"), F.col("text").alias("title"), "source", "sentiment",
                                 "confidence", "created_at")
    store = scratch_path(spark, "news-sink")
    files.append_news(s, store, "run-1")
    out = files.load_news_store(spark, store)
    return out.select("seq", "sentiment", "confidence", "created_at", F.date_format(F.col("date"), "yyyy-MM-dd").alias("date"))

# --------------------------------------------------------------------------- search


@query
def population_init(spark, d):
    pop = G.create_population(spark, S.POPULATION_SIZE, S.SEED, 1)
    scored = G.sweep(pop, C.vectors(spark, d, "proxy")).select("cand_key", "fitness")
    return pop.join(scored, "cand_key").select("slot", "cand_key", *G.GENE_COLS, "fitness")


@query
def candidate_key(spark, d):
    pops = C.populations(spark, d)
    return G.with_key(pops.drop("cand_key")).select("gen", "slot", "cand_key", *G.GENE_COLS)


@query
def candidate_features(spark, d):
    t = C.trials(spark, d).select("cand_key", *G.GENE_COLS, "fitness")
    return G.candidate_features(t).select("cand_key", *G.FEATURE_NAMES, "fitness")


def _gen1_parents(spark, d):
    ev = C.population_results(spark, d, 1)
    return G.select_parents(ev)


@query
def parents_top_half(spark, d):
    parents, _ = _gen1_parents(spark, d)
    return parents.select("cand_key", "fitness", "rk")


@query
def crossover(spark, d):
    parents, k = _gen1_parents(spark, d)
    kids = G.crossover(parents, k, S.POPULATION_SIZE - 1, S.SEED, 2)
    return G.with_key(kids).select("slot", "cand_key", *G.GENE_COLS)


@query
def mutation(spark, d):
    parents, k = _gen1_parents(spark, d)
    kids = G.mutate(G.crossover(parents, k, S.POPULATION_SIZE - 1, S.SEED, 2), S.SEED, 2)
    return G.with_key(kids).select("slot", "cand_key", *G.GENE_COLS)


@query
def next_generation(spark, d):
    ev = C.population_results(spark, d, 1)
    return G.next_generation(ev, S.POPULATION_SIZE, S.SEED, 2).select("slot", "cand_key", *G.GENE_COLS)


def _sweep_out(df):
    return df.select("cand_key", "n", "accuracy", "precision", "recall", "fitness")


@query
def trial_sweep(spark, d):
    pop = G.create_population(spark, S.POPULATION_SIZE, S.SEED, 1)
    return _sweep_out(G.sweep(pop, C.vectors(spark, d, "proxy")))


@query
def grid_sweep(spark, d):
    return _sweep_out(G.sweep(G.grid(spark), C.vectors(spark, d, "full")))


@query
def trial_errors(spark, d):
    """The first population swept per document language in one job.

    Languages present in ``documents`` but without labelled rows enter
    as zero-count vectors, so their evaluations fail and become rows with
    ``fitness = -1`` and an error text; the job goes on.
    """
    pop = G.create_population(spark, S.POPULATION_SIZE, S.SEED, 1)
    langs = read_table(spark, d, "documents").select(F.col("doc_id").alias("news_id"), "lang")
    labelled = G.feature_vectors(C.news(spark, d).join(langs, "news_id"), C.POSITIVE, C.NEGATIVE, ("lang",))
    placeholders = langs.select("lang").distinct().select(
        "lang", *(F.lit(0).alias(c) for c in G.FEATURE_COLS), F.lit(0).cast("long").alias("cnt"))
    vec = labelled.unionByName(placeholders)
    return G.sweep(pop, vec, by=("lang",)).select("lang", "cand_key", "n", "fitness", "error")


@query
def valid_trials(spark, d):
    return G.valid_trials(C.trials(spark, d)).select("cand_key", "gen", "fitness")


@query
def best_trial(spark, d):
    return G.best_trial(C.trials(spark, d)).select("cand_key", *G.GENE_COLS, "fitness")


@query
def leaderboard(spark, d):
    return G.leaderboard(C.trials(spark, d)).select("position", "cand_key", "gen", "fitness")


@query
def top3_distinct(spark, d):
    return G.top_distinct(C.trials(spark, d), 3).select("cand_key", "fitness", "proxy_rank")


def _full_scores(spark, d, cands):
    return G.sweep(cands, C.vectors(spark, d, "full"))


@query
def rank_shift(spark, d):
    top = G.top_distinct(C.trials(spark, d), 3)
    full = _full_scores(spark, d, top)
    return G.rank_shift(top, full)


@query
def validate_top3(spark, d):
    top = G.top_distinct(C.trials(spark, d), 3).select("cand_key", *G.GENE_COLS, F.lit("top3").alias("origin"))
    dflt = G.default_candidate(spark).select("cand_key", *G.GENE_COLS, F.lit("default").alias("origin"))
    cands = top.unionByName(dflt)
    full = _full_scores(spark, d, cands).select("cand_key", F.col("accuracy").alias("full_accuracy"),
                                                F.col("fitness").alias("full_f1"))
    j = cands.groupBy("cand_key").agg(F.min("origin").alias("origin")).join(full, "cand_key")
    from pyspark.sql import Window

    j = j.withColumn("full_rank", F.row_number().over(Window.orderBy(F.col("full_f1").desc(), "cand_key")))
    return j.withColumn("chosen", F.col("full_rank") == 1).withColumn("final_epochs", F.lit(S.FINAL_EPOCHS))


@query
def best_or_default(spark, d):
    return G.best_or_default(C.trials(spark, d), G.default_candidate(spark))


@query
def generation_log(spark, d):
    return G.generation_log(C.populations(spark, d), C.trials(spark, d))


@query
def search_summary(spark, d):
    log = G.generation_log(C.populations(spark, d), C.trials(spark, d))
    return G.search_summary(C.trials(spark, d), log, S.POPULATION_SIZE)


@query
def search_savings(spark, d):
    return G.savings(G.generation_log(C.populations(spark, d), C.trials(spark, d)))


@query
def early_stop(spark, d):
    return G.early_stop(G.generation_log(C.populations(spark, d), C.trials(spark, d)))


def _gen2(spark, d):
    return C.populations(spark, d).filter(F.col("gen") == 2)


def _before_gen2(spark, d):
    return C.trials(spark, d).filter(F.col("gen") < 2)


@query
def cache_miss_anti(spark, d):
    cands = G.distinct_candidates(_gen2(spark, d)).select("cand_key", *G.GENE_COLS)
    return G.unseen(cands, _before_gen2(spark, d))


@query
def cache_hit_join(spark, d):
    pop = _gen2(spark, d).select("gen", "slot", "cand_key")
    return G.attach_results(pop, C.trials(spark, d)).select("slot", "cand_key", "hit", "fitness", "rows_scored")


@query
def distinct_candidates(spark, d):
    return G.distinct_candidates(_gen2(spark, d))


def _screened(spark, d):
    """A pool of random candidates with the fitness predicted from the stored trials."""
    pool = G.distinct_candidates(G.create_population(spark, S.SURROGATE_POOL, S.SEED, 3, tag="pool"))
    return G.predict_main_effects(C.trials(spark, d), pool)


@query
def topk_screened(spark, d):
    return G.topk(_screened(spark, d), "predicted", S.SURROGATE_TOPK).select("cand_key", "predicted")


@query
def merge_evaluated(spark, d):
    a = C.population_results(spark, d, 2).select("cand_key", "fitness").dropDuplicates(["cand_key"])
    top = G.topk(_screened(spark, d), "predicted", S.SURROGATE_TOPK)
    b = G.sweep(top, C.vectors(spark, d, "proxy")).select("cand_key", "fitness")
    return G.merge_evaluated(a, b)
