"""Registered queries over Spark ML fits, the surrogate search, the JSON report and the streaming jobs.

Values of fitted models are not bit-comparable with SQL.  Their queries return the keys, the counts and the measured
fitness, which SQL states, and conditions on the predictions checked row by row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newslab import schema as S
from newslab.functions import text as X
from newslab.operators import metrics as M
from newslab.operators import ml
from newslab.operators import search as G
from newslab.operators import stacked as K
from newslab.operators.search_loop import run_search
from newslab.plans import context as C
from newslab.plans.queries import _headlines, _scored, query
from newslab.session import scratch_path
from newslab.sources import files
from newslab.streaming import jobs


def _pool(spark, gen: int = 3):
    return G.distinct_candidates(G.create_population(spark, S.SURROGATE_POOL, S.SEED, gen, tag="pool"))


def _finite(c) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


@query
def surrogate_fit(spark, d):
    """Regressor (boosted trees) fitted on the stored trials; its prediction on each of them is finite."""
    t = C.trials(spark, d)
    pred = ml.screen(C.surrogate(spark, d), t.select("cand_key", *G.GENE_COLS))
    return pred.join(t.select("cand_key", "fitness"), "cand_key").select(
        "cand_key", "fitness", _finite(F.col("predicted")).alias("finite"))


@query
def surrogate_screen(spark, d):
    """G8 + K3 + J1: score a random pool, keep the best unseen candidates; per pool member the rules checked."""
    t = C.trials(spark, d)
    pool = _pool(spark)
    pred = ml.screen(C.surrogate(spark, d), pool)
    chosen = G.unseen(G.topk(pred, "predicted", S.SURROGATE_TOPK), t).select("cand_key", F.lit(True).alias("chosen"))
    stored = t.select("cand_key", F.lit(True).alias("stored")).distinct()
    rows = pool.select("cand_key").join(chosen, "cand_key", "left").join(stored, "cand_key", "left")
    few = F.lit(chosen.limit(S.SURROGATE_TOPK + 1).count() <= S.SURROGATE_TOPK)
    return rows.select("cand_key", F.col("stored").isNotNull().alias("stored"),
                       (~(F.col("chosen").isNotNull() & F.col("stored").isNotNull()) & few).alias("ok"))


@query
def surrogate_calibration(spark, d):
    """Predicted versus measured fitness for the screened pool (measured on the proxy vectors)."""
    pred = ml.screen(C.surrogate(spark, d), _pool(spark))
    measured = G.sweep(pred, C.vectors(spark, d, "proxy")).withColumn("gen", F.lit(0))
    cal = ml.surrogate_calibration(pred, measured)
    return cal.select("cand_key", "fitness", (_finite(F.col("predicted"))
                                              & (F.col("abs_err") == F.abs(F.col("predicted") - F.col("fitness")))).alias("ok"))


@query
def search_run(spark, d):
    """Warm-up generations in full; of the screened generations after them, that they kept the rules."""
    store = scratch_path(spark, "search-surrogate")
    res = run_search(spark, C.vectors(spark, d, "proxy"), store, patience=S.EARLY_STOP_PATIENCE,
                     surrogate="ridge", parent_scope="history")
    log = G.generation_log(spark.read.parquet(res.populations_path), spark.read.parquet(res.trials_path))
    log = log.filter(F.col("gen").isNotNull())
    warm = log.filter(F.col("gen") <= S.WARMUP_GENERATIONS).withColumn("ok", F.lit(True))
    late = log.filter(F.col("gen") > S.WARMUP_GENERATIONS).agg(
        F.coalesce(F.min((F.col("new_evals") <= S.SURROGATE_TOPK) & (F.col("best_f1") <= 1.0)), F.lit(True)).alias("ok"))
    return warm.unionByName(late, allowMissingColumns=True)


@query
def final_by_split(spark, d):
    """SURVEY 4.5: the best distinct candidates and the default, measured on the validation and the test split."""
    top = G.top_distinct(C.trials(spark, d), 3).select("cand_key", *G.GENE_COLS)
    cands = top.unionByName(G.default_candidate(spark).select("cand_key", *G.GENE_COLS)).dropDuplicates(["cand_key"])
    held = C.split(spark, d).filter(F.col("split").isin("val", "test"))
    vec = G.feature_vectors(held, C.POSITIVE, C.NEGATIVE, ("split",))
    return G.sweep(cands, vec, by=("split",)).select("split", "cand_key", "n", "accuracy", "fitness")


@query
def trial_report_json(spark, d):
    """Nested report (config, per-generation log, leaderboard top) written as JSON, read back and flattened."""
    t = C.trials(spark, d)
    log = G.generation_log(C.populations(spark, d), t).filter(F.col("gen").isNotNull())
    # Per-generation rows and the top list are tagged and unioned: one aggregation builds the report row.
    gen_rows = log.select(F.struct("gen", "new_evals", "cache_hits", "best_f1", "rows_scored").alias("g"),
                          F.lit(None).cast("struct<proxy_rank:int,cand_key:string,fitness:double>").alias("t"))
    top_rows = G.top_distinct(t, 3).select(
        F.lit(None).cast("struct<gen:int,new_evals:bigint,cache_hits:bigint,best_f1:double,rows_scored:double>")
        .alias("g"),
        F.struct(F.col("proxy_rank").cast("int").alias("proxy_rank"), "cand_key", "fitness").alias("t"))
    config = F.struct(F.lit(S.POPULATION_SIZE).alias("population"), F.lit(S.GENERATIONS).alias("generations"),
                      F.lit(S.SEED).alias("seed"))
    report = gen_rows.unionByName(top_rows).agg(
        F.sort_array(F.collect_list("g")).alias("per_gen"), F.sort_array(F.collect_list("t")).alias("top")
    ).select(config.alias("config"), "per_gen", "top")
    path = scratch_path(spark, "report")
    files.write_report(report, path)
    back = spark.read.schema(report.schema).json(path)
    gens = back.select(F.explode("per_gen").alias("g")).select(
        F.lit("generation").alias("section"), F.col("g.gen").alias("ord"), F.lit(None).cast("string").alias("cand_key"),
        F.col("g.new_evals").alias("new_evals"), F.col("g.cache_hits").alias("cache_hits"), F.col("g.best_f1").alias("fitness"))
    tops = back.select(F.explode("top").alias("t")).select(
        F.lit("top").alias("section"), F.col("t.proxy_rank").alias("ord"), "t.cand_key",
        F.lit(None).cast("long").alias("new_evals"), F.lit(None).cast("long").alias("cache_hits"), "t.fitness")
    head = back.select(F.lit("config").alias("section"), F.col("config.seed").alias("ord"), F.lit(None).cast("string").alias("cand_key"),
                       F.col("config.population").cast("long").alias("new_evals"),
                       F.col("config.generations").cast("long").alias("cache_hits"), F.lit(None).cast("double").alias("fitness"))
    return gens.unionByName(tops).unionByName(head)


@query
def train_text_classifier(spark, d):
    """M1 with G5: text classifiers of the default and the best candidates, trained together; metrics on the val split."""
    m = ml.candidate_metrics(C.hashed(spark, d), *C.classifiers(spark, d), "val")
    return m.select("cand_key", "n", "accuracy", "precision", "recall", "f1", "error")


@query
def score_news(spark, d):
    """M2 + F10: the default candidate's classifier over all news rows."""
    candidates, stack = C.classifiers(spark, d)
    out = K.score(C.hashed(spark, d), candidates[0], stack, ["news_id"])
    return out.select("news_id", X.label_name(F.col("pred_id")).alias("sentiment"), F.array_max("probability").alias("confidence"))


@query
def baseline_vs_tuned(spark, d):
    """M3: the search's best classifier against the default one on the test split, metric by metric."""
    candidates, stack = C.classifiers(spark, d)
    best = G.best_trial(C.trials(spark, d)).first()["cand_key"]
    counts = K.evaluate(C.hashed(spark, d).filter(F.col("split") == "test"), candidates, stack)
    metrics = M.classification_metrics(counts.filter(F.col("cand_key").isin(best, candidates[0].key)), "y", "yhat", by=("cand_key",), weight="n")
    return M.compare_groups(metrics, "cand_key", best, candidates[0].key)


@query
def stream_ingest_dedup(spark, d):
    """Headline files landed in three drops, streamed with title de-duplication; the first arrival of every title."""
    rows = _headlines(spark, d)
    landing = scratch_path(spark, "landing-headlines")
    store = scratch_path(spark, "stream-store")
    ckpt = scratch_path(spark, "stream-ckpt")
    # Three scheduled runs, each after one more drop has landed.
    jobs.land_in_batches(rows, landing, "page_id", 3,
                         after_each=lambda k: jobs.ingest_dedup_stream(spark, landing, rows.schema, store, ckpt, buckets=16,
                                                                       order=("page_id", "pos")))
    return spark.read.parquet(store).select(*rows.columns)


@query
def stream_daily_sentiment(spark, d):
    """Scored news streamed in three drops through a one-day tumbling window; undated rows counted beside it."""
    scored = _scored(spark, d).select("news_id", F.col("created_at").cast("timestamp").alias("event_time"), "sentiment")
    landing = scratch_path(spark, "landing-news")
    out = scratch_path(spark, "stream-daily")
    ckpt = scratch_path(spark, "stream-ckpt")
    dated = scored.filter(F.col("event_time").isNotNull())
    # Three scheduled runs, each after one more drop has landed.
    jobs.land_in_batches(dated, landing, "news_id", 3,
                         after_each=lambda k: jobs.daily_sentiment_stream(spark, landing, scored.schema, out, ckpt))
    days = jobs.daily_counts(spark, out)
    undated = scored.filter(F.col("event_time").isNull()).groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"))
    return days.unionByName(undated.select(F.lit(None).cast("string").alias("day"), "sentiment", "n"))
