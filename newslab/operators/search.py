"""Trial search on Spark: populations, genetic operators, candidate sweeps.

Candidates are six integer genes (indices into ``schema.SPACE``).  Every
random choice is an md5 draw of ``(seed, gen, slot, tag)`` so populations are
reproducible for any partitioning and checkable by a SQL oracle.

Relational scorer (what a candidate means when it is evaluated over the
news table); the genes carry the names of the searched configuration, here
they weigh lexicon hits.  Per prepared news row the integer features are

* ``ph`` / ``nh`` = positive / negative lexicon tokens,
* ``wm`` = ``least(words, 7)`` (no gene looks further), ``lb`` = ``words div 100``;

gene indices ``g1..g6`` give weights ``1+g1`` / ``1+g2``, margins ``g3`` /
``g4``, length normaliser ``g5`` and minimum words ``3 + 2*g6``:

    s = ph*(1+g1) - nh*(1+g2);  m = g5*lb
    pred = netral   if words < 3+2*g6
           positif  if s  > g3 + m
           negatif  if -s > g4 + m
           netral   otherwise

Scale plan of a sweep: the feature rows are aggregated (partial + final
HashAggregate) into distinct vectors, whose number grows with the length of
texts and not with the number of rows; each partition of that table is scored
against the candidates in slices of fixed memory by one vectorised
``mapInPandas`` call that emits nine confusion counts per candidate, and a
final ``groupBy(cand_key)`` sums them.  No pair of data rows is ever formed.
Candidates beyond one batch are dealt into hash groups that are swept one
after the other, so the driver holds one batch at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslab import schema as S
from newslab.functions import text as X
from newslab.functions.draws import draw, rate_threshold
from newslab.operators import metrics as M
from newslab.session import scratch_path

GENE_COLS = [f"i_{g}" for g in S.GENES]
#: Candidates that are sent to tasks at once, and bytes of one work array in a task.
BATCH_CANDIDATES = 4096
SLICE_BYTES = 8 << 20
FEATURE_COLS = ["label_id", "ph", "nh", "wm", "lb"]

# ---------------------------------------------------------------------------
# Keys, values, candidate features
# ---------------------------------------------------------------------------


def cand_key(df: DataFrame) -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in GENE_COLS])


def with_key(df: DataFrame) -> DataFrame:
    return df.withColumn("cand_key", cand_key(df))


def gene_values(df: DataFrame) -> DataFrame:
    """Add the typed gene values next to their indices."""
    vals = {
        g: F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col(f"i_{g}") + 1)
        for g, values in S.SPACE
    }
    return df.withColumns(vals)


def candidate_features(df: DataFrame) -> DataFrame:
    """index/(n-1) for the six genes, log10(lr), rank, alpha, alpha/max(rank, 1)."""
    with_vals = gene_values(df)
    cols = {}
    for k, (g, values) in enumerate(S.SPACE):
        cols[f"f{k}"] = F.col(f"i_{g}") / max(len(values) - 1, 1)
    cols["f6"] = F.log10(F.col("learning_rate"))
    cols["f7"] = F.col("lora_rank")
    cols["f8"] = F.col("lora_alpha")
    cols["f9"] = F.col("lora_alpha") / F.greatest(F.col("lora_rank"), F.lit(1.0))
    return with_vals.withColumns(cols)


FEATURE_NAMES = [f"f{k}" for k in range(10)]

# ---------------------------------------------------------------------------
# Populations
# ---------------------------------------------------------------------------


def create_population(spark: SparkSession, n: int, seed: int = S.SEED, gen: int = 1, tag: str = "init") -> DataFrame:
    """G1: ``n`` slots, each gene an md5 draw modulo its size."""
    base = spark.range(n).select(F.col("id").cast("int").alias("slot"))
    genes = {
        f"i_{g}": (draw(seed, gen, F.col("slot"), tag, g) % len(vals)).cast("int") for g, vals in S.SPACE
    }
    out = base.withColumns(genes).withColumn("gen", F.lit(gen))
    return with_key(out).select("gen", "slot", "cand_key", *GENE_COLS)


def grid(spark: SparkSession) -> DataFrame:
    """Every combination of the space (972 rows), as a Spark range."""
    total = S.SPACE_SIZE
    base = spark.range(total).select(F.col("id").alias("code"))
    cols = {}
    stride = total
    for g, vals in S.SPACE:
        stride //= len(vals)
        cols[f"i_{g}"] = ((F.col("code") / stride).cast("long") % len(vals)).cast("int")
    return with_key(base.withColumns(cols)).select("cand_key", *GENE_COLS)


def candidates_from_indices(spark: SparkSession, rows: Sequence[Sequence[int]]) -> DataFrame:
    out = spark.createDataFrame([tuple(int(x) for x in r) for r in rows], ", ".join(f"{c} INT" for c in GENE_COLS))
    return with_key(out).select("cand_key", *GENE_COLS)


def default_candidate(spark: SparkSession) -> DataFrame:
    return candidates_from_indices(spark, [S.default_indices()])


def distinct_candidates(pop: DataFrame) -> DataFrame:
    """One row per candidate key (the first slot keeps it)."""
    first = pop.groupBy("cand_key").agg(F.min_by(F.struct(*GENE_COLS, "slot"), F.col("slot")).alias("r"))
    return first.select("cand_key", F.col("r.slot").alias("slot"), *(F.col(f"r.{c}").alias(c) for c in GENE_COLS))

# ---------------------------------------------------------------------------
# Genetic operators
# ---------------------------------------------------------------------------


def rank_valid(evaluated: DataFrame) -> DataFrame:
    """Distinct valid candidates ranked by ``fitness desc, cand_key`` (candidate-sized)."""
    valid = evaluated.filter(F.col("fitness") >= 0).select("cand_key", *GENE_COLS, "fitness").dropDuplicates(
        ["cand_key"]
    )
    return valid.withColumn("rk", F.row_number().over(Window.orderBy(F.col("fitness").desc(), "cand_key")))


def select_parents(evaluated: DataFrame) -> tuple[DataFrame, int]:
    """K4: top half (integer division, at least one) of the distinct valid candidates."""
    ranked = rank_valid(evaluated)
    m = ranked.count()  # a single number: the candidate count
    n_parents = max(m // 2, 1) if m else 0
    return ranked.filter(F.col("rk") <= n_parents), n_parents


def crossover(parents: DataFrame, n_parents: int, n_children: int, seed: int, gen: int,
              first_slot: int = 1) -> DataFrame:
    """Each child picks two ranked parents by draw and each gene 50/50."""
    spark = parents.sparkSession
    kids = spark.range(first_slot, first_slot + n_children).select(F.col("id").cast("int").alias("slot"))
    kids = kids.withColumns(
        {
            "r1": (draw(seed, gen, F.col("slot"), "p1") % n_parents + 1).cast("int"),
            "r2": (draw(seed, gen, F.col("slot"), "p2") % n_parents + 1).cast("int"),
        }
    )
    p1 = parents.select(F.col("rk").alias("r1"), *(F.col(c).alias(f"a_{c}") for c in GENE_COLS))
    p2 = parents.select(F.col("rk").alias("r2"), *(F.col(c).alias(f"b_{c}") for c in GENE_COLS))
    if n_parents <= BATCH_CANDIDATES:
        p1, p2 = F.broadcast(p1), F.broadcast(p2)
    j = kids.join(p1, "r1").join(p2, "r2")
    genes = {
        f"i_{g}": F.when(draw(seed, gen, F.col("slot"), "x", g) % 2 == 0, F.col(f"a_i_{g}")).otherwise(
            F.col(f"b_i_{g}")
        )
        for g in S.GENES
    }
    return j.select("slot", *(genes[c].alias(c) for c in GENE_COLS))


def mutate(pop: DataFrame, seed: int, gen: int, rate: float = S.MUTATION_RATE) -> DataFrame:
    """Per gene, with probability ``rate`` (integer cut), redraw (may repeat the value)."""
    cut = rate_threshold(rate)
    genes = {
        f"i_{g}": F.when(
            draw(seed, gen, F.col("slot"), "m", g) < cut, (draw(seed, gen, F.col("slot"), "v", g) % len(vals)).cast("int")
        ).otherwise(F.col(f"i_{g}"))
        for g, vals in S.SPACE
    }
    return pop.withColumns(genes)


def next_generation(evaluated: DataFrame, n: int, seed: int, gen: int, rate: float = S.MUTATION_RATE) -> DataFrame:
    """Elite (best valid) in slot 0 plus ``n-1`` mutated children of the top half.

    Falls back to a fresh random population when no candidate is valid.
    """
    parents, n_parents = select_parents(evaluated)
    spark = evaluated.sparkSession
    if n_parents == 0:
        return create_population(spark, n, seed, gen)
    elite = parents.filter(F.col("rk") == 1).select(F.lit(0).alias("slot"), *GENE_COLS)
    kids = mutate(crossover(parents, n_parents, n - 1, seed, gen), seed, gen, rate)
    out = elite.unionByName(kids).withColumn("gen", F.lit(gen))
    return with_key(out).select("gen", "slot", "cand_key", *GENE_COLS)

# ---------------------------------------------------------------------------
# Relational scorer and sweep
# ---------------------------------------------------------------------------


def scorer_features(news_df: DataFrame, positive: Sequence[str], negative: Sequence[str],
                    by: Sequence[str] = ()) -> DataFrame:
    """Integer features per news row (needs ``clean_text``, ``words``, ``label_id``)."""
    clean = F.col("clean_text")
    return news_df.select(
        *by,
        "label_id",
        X.lexicon_count(clean, positive).alias("ph"),
        X.lexicon_count(clean, negative).alias("nh"),
        F.least(F.col("words"), F.lit(7)).alias("wm"),
        (F.col("words") / 100).cast("int").alias("lb"),
    )


def feature_vectors(news_df: DataFrame, positive: Sequence[str], negative: Sequence[str],
                    by: Sequence[str] = ()) -> DataFrame:
    """Distinct feature vectors with their row counts."""
    return scorer_features(news_df, positive, negative, by).groupBy(*by, *FEATURE_COLS).agg(
        F.count(F.lit(1)).alias("cnt")
    )


def predict_column(genes: dict[str, Column], ph: Column, nh: Column, wm: Column, lb: Column) -> Column:
    """The scorer as a Column expression (used for per-row predictions)."""
    g = [genes[c] for c in GENE_COLS]
    s = ph * (g[0] + 1) - nh * (g[1] + 1)
    m = g[4] * lb
    return (
        F.when(wm < g[5] * 2 + 3, F.lit(1)).when(s > g[2] + m, F.lit(2)).when(-s > g[3] + m, F.lit(0)).otherwise(F.lit(1))
    )


def _score_matrix(cands: np.ndarray, vec: pd.DataFrame) -> np.ndarray:
    """C x 9 confusion counts of every candidate over a batch of vectors, in candidate slices of ``SLICE_BYTES``."""
    ph, nh, wm, lb, y, cnt = (vec[c].to_numpy(np.int64) for c in ("ph", "nh", "wm", "lb", "label_id", "cnt"))
    weights = np.stack([np.where(y == i, cnt, 0) for i in range(3)], axis=1)  # vectors x 3
    out = np.zeros((cands.shape[0], 9), dtype=np.int64)
    step = max(1, SLICE_BYTES // (8 * max(len(vec), 1)))
    for first in range(0, len(cands), step):
        g = cands[first:first + step, :, None]  # slice x 6 x 1
        s = ph * (g[:, 0] + 1) - nh * (g[:, 1] + 1)
        m = g[:, 4] * lb
        pred = np.where(wm < g[:, 5] * 2 + 3, 1, np.where(s > g[:, 2] + m, 2, np.where(-s > g[:, 3] + m, 0, 1)))
        for j in range(3):
            out[first:first + step, j::3] = (pred == j).astype(np.int64) @ weights
    return out


def _sweep_batch(cands_pdf: pd.DataFrame, vectors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    keys = cands_pdf["cand_key"].tolist()
    mat = cands_pdf[GENE_COLS].to_numpy(np.int64)
    count_cols = [f"c{i}{j}" for i in range(3) for j in range(3)]
    by = list(by)
    by_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields if f.name in by)
    out_schema = (by_schema + ", " if by else "") + "cand_key STRING, " + ", ".join(f"{c} LONG" for c in count_cols)

    def score(batches):
        totals: dict = {}
        for vec in batches:
            if not len(vec):
                continue
            groups = vec.groupby(by, sort=False, dropna=False) if by else [((), vec)]
            for gkey, part in groups:
                gkey = gkey if isinstance(gkey, tuple) else (gkey,)
                acc = totals.setdefault(gkey, np.zeros((len(keys), 9), dtype=np.int64))
                acc += _score_matrix(mat, part)
        if not by and not totals:
            totals[()] = np.zeros((len(keys), 9), dtype=np.int64)
        for gkey, acc in totals.items():
            res = pd.DataFrame(acc, columns=count_cols)
            res.insert(0, "cand_key", keys)
            for name, value in zip(by, gkey):
                res.insert(by.index(name), name, value)
            yield res

    partial = vectors.mapInPandas(score, out_schema)
    return partial.groupBy(*by, "cand_key").agg(*(F.sum(c).alias(c) for c in count_cols))


def _finish_sweep(sel: DataFrame, results: DataFrame, by: Sequence[str], small: bool) -> DataFrame:
    count_cols = [f"c{i}{j}" for i in range(3) for j in range(3)]
    by = list(by)
    # Broadcast the candidate table only when it fits in one checked batch.
    cands_side = F.broadcast(sel) if small else sel
    if by:
        joined = results.join(cands_side, "cand_key")
    else:
        # Keep every candidate, zero counts when no vector was seen.
        joined = cands_side.join(results, "cand_key", "left").fillna(0, subset=count_cols)
    scored = M.with_metrics(joined)
    failed = F.col("f1").isNull()
    return scored.select(
        *by, "cand_key", *GENE_COLS, *count_cols, "n", "accuracy", "precision", "recall",
        F.when(failed, F.lit(-1.0)).otherwise(F.col("f1")).alias("fitness"),
        F.col("n").cast("double").alias("rows_scored"),
        F.when(failed, F.lit("empty evaluation set")).alias("error"),
    )


def sweep(cands: DataFrame, vectors: DataFrame, by: Sequence[str] = (), batch: int = BATCH_CANDIDATES) -> DataFrame:
    """Every candidate scored over every vector; metrics per candidate (and per ``by`` group).

    Up to ``batch`` candidates are sent to the tasks in one job.  More are dealt into hash groups of about that size;
    the groups are swept one after the other and their counts written to the shared folder, so any number works and
    the driver never holds more than one group.
    Returns [by...], cand_key, genes, c00..c22, n, accuracy, precision, recall,
    fitness, rows_scored and error (G6: an evaluation failure
    becomes a row with fitness -1).  A ``by`` group present only with zero
    counts yields failure rows.
    """
    spark = cands.sparkSession
    sel = cands.select("cand_key", *GENE_COLS).dropDuplicates(["cand_key"])
    first = sel.limit(batch + 1).toPandas()  # size check and candidates in one job
    if not len(first):
        counts = "cand_key STRING, " + ", ".join(f"c{i}{j} LONG" for i in range(3) for j in range(3))
        return _finish_sweep(sel, spark.createDataFrame([], counts), (), small=True)
    if len(first) <= batch:
        schema = "cand_key STRING, " + ", ".join(f"{c} INT" for c in GENE_COLS)
        sel = spark.createDataFrame([tuple(r) for r in first.itertuples(index=False, name=None)], schema)
        return _finish_sweep(sel, _sweep_batch(first, vectors, by), by, small=True)
    groups = -(-2 * sel.count() // batch)
    path = scratch_path(spark, "sweep")
    for k in range(groups):
        part = sel.filter(F.pmod(F.xxhash64("cand_key"), F.lit(groups)) == k).toPandas()
        if len(part):
            _sweep_batch(part, vectors, by).write.mode("append").parquet(path)
    return _finish_sweep(sel, spark.read.parquet(path), by, small=False)


# ---------------------------------------------------------------------------
# Trial-table operators
# ---------------------------------------------------------------------------


def valid_trials(trials: DataFrame) -> DataFrame:
    return trials.filter(F.col("fitness") >= 0)


def unseen(cands: DataFrame, trials: DataFrame) -> DataFrame:
    """Candidates with no stored result."""
    return cands.join(trials.select("cand_key").distinct(), "cand_key", "left_anti")


def attach_results(pop: DataFrame, trials: DataFrame, gen_col: str = "gen") -> DataFrame:
    """Population slots with their stored result; 0 rows scored when it was a cache hit.

    A hit is a result first stored in an earlier generation than the slot's.
    """
    first = trials.groupBy("cand_key").agg(
        F.min_by(F.struct("fitness", "rows_scored", F.col("gen").alias("first_gen")), F.col("gen")).alias("t")
    )
    j = pop.join(first, "cand_key", "left")
    hit = F.col("t.first_gen") < F.col(gen_col)
    return j.select(
        *pop.columns,
        F.coalesce(hit, F.lit(False)).alias("hit"),
        F.col("t.fitness").alias("fitness"),
        F.when(hit, F.lit(0.0)).otherwise(F.col("t.rows_scored")).alias("rows_scored"),
    )


def best_trial(trials: DataFrame) -> DataFrame:
    """A3: the single best valid trial (``fitness desc, cand_key``)."""
    return valid_trials(trials).orderBy(F.col("fitness").desc(), F.col("cand_key")).limit(1)


def leaderboard(trials: DataFrame) -> DataFrame:
    """Valid trials best first."""
    w = Window.orderBy(F.col("fitness").desc(), F.col("cand_key"))
    return valid_trials(trials).withColumn("position", F.row_number().over(w))


def top_distinct(trials: DataFrame, k: int = 3) -> DataFrame:
    """Best ``k`` distinct candidates with their proxy rank."""
    best = valid_trials(trials).groupBy("cand_key", *GENE_COLS).agg(F.max("fitness").alias("fitness"))
    top = best.orderBy(F.col("fitness").desc(), "cand_key").limit(k)
    return top.withColumn("proxy_rank", F.row_number().over(Window.orderBy(F.col("fitness").desc(), "cand_key")))


def best_or_default(trials: DataFrame, default: DataFrame) -> DataFrame:
    """The best valid trial, or the default candidate when there is none."""
    best = top_distinct(trials, 1).select("cand_key", *GENE_COLS, "fitness", F.lit(False).alias("is_default"))
    fallback = default.select("cand_key", *GENE_COLS, F.lit(None).cast("double").alias("fitness"),
                              F.lit(True).alias("is_default"))
    both = best.unionByName(fallback)
    w = Window.orderBy(F.col("is_default").asc())  # two rows at most
    return both.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")


def generation_log(populations: DataFrame, trials: DataFrame) -> DataFrame:
    """A10: per generation new evaluations, cache hits, best valid fitness, cost; plus a total row."""
    first = trials.groupBy("cand_key").agg(
        F.min("gen").alias("first_gen"), F.min_by("fitness", "gen").alias("fitness"),
        F.min_by("rows_scored", "gen").alias("cost"),
    )
    slots = populations.join(first, "cand_key", "left")
    per_slot = slots.select(
        "gen", "cand_key", "fitness",
        F.when(F.col("first_gen") == F.col("gen"), F.col("cand_key")).alias("new_key"),
    )
    per_gen = per_slot.groupBy("gen").agg(
        F.count_distinct("new_key").alias("new_evals"),
        F.count(F.lit(1)).alias("slots"),
        F.max(F.when(F.col("fitness") >= 0, F.col("fitness"))).alias("best"),
    )
    cost = first.groupBy(F.col("first_gen").alias("gen")).agg(F.sum("cost").alias("rows_scored"))
    g = per_gen.join(cost, "gen", "left").select(
        "gen", "new_evals", (F.col("slots") - F.col("new_evals")).alias("cache_hits"),
        F.coalesce(F.col("best"), F.lit(-1.0)).alias("best_f1"),
        F.coalesce(F.col("rows_scored"), F.lit(0.0)).alias("rows_scored"),
    )
    return g.rollup("gen").agg(
        F.sum("new_evals").alias("new_evals"), F.sum("cache_hits").alias("cache_hits"),
        F.max("best_f1").alias("best_f1"), F.sum("rows_scored").alias("rows_scored"),
    )


def early_stop(log: DataFrame, patience: int = S.EARLY_STOP_PATIENCE) -> DataFrame:
    """Running best, streak without improvement; all-failed generations do not count.

    ``log`` has one row per generation (``gen``, ``best_f1``); it is bounded by
    the number of generations, so the global window is cheap.
    """
    per_gen = log.filter(F.col("gen").isNotNull()).select("gen", "best_f1")
    valid = F.col("best_f1") >= 0
    w_prev = Window.orderBy("gen").rowsBetween(Window.unboundedPreceding, -1)
    w_run = Window.orderBy("gen").rowsBetween(Window.unboundedPreceding, 0)
    prev_best = F.coalesce(F.max(F.when(valid, F.col("best_f1"))).over(w_prev), F.lit(-1.0))
    x = per_gen.withColumn("prev_best", prev_best)
    x = x.withColumn("improved", valid & (F.col("best_f1") > F.col("prev_best")))
    x = x.withColumn("island", F.sum(F.when(F.col("improved"), 1).otherwise(0)).over(w_run))
    w_island = Window.partitionBy("island").orderBy("gen").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn(
        "streak",
        F.sum(F.when((F.col("best_f1") >= 0) & ~F.col("improved"), 1).otherwise(0)).over(w_island),
    )
    stop_gen = F.min(F.when(F.col("streak") >= patience, F.col("gen"))).over(Window.partitionBy())
    x = x.withColumn("stop_gen", stop_gen)
    return x.select(
        "gen", "best_f1", "prev_best", "improved", "streak",
        F.coalesce(F.col("gen") == F.col("stop_gen"), F.lit(False)).alias("stop"),
        F.coalesce(F.col("gen") > F.col("stop_gen"), F.lit(False)).alias("skipped"),
    )


def search_summary(trials: DataFrame, log: DataFrame, pop_size: int) -> DataFrame:
    """Unique configurations, coverage and hit rate (percent), mean costs.

    Trials and per-generation rows are tagged and unioned, so the summary is
    one aggregation (no join of the two one-row results).
    """
    t = trials.select(F.lit("t").alias("src"), "cand_key", F.col("rows_scored").alias("cost"), "fitness",
                      F.lit(None).cast("long").alias("cache_hits"))
    g = log.filter(F.col("gen").isNotNull()).select(
        F.lit("g").alias("src"), F.lit(None).cast("string").alias("cand_key"),
        F.col("rows_scored").cast("double").alias("cost"), F.lit(None).cast("double").alias("fitness"),
        F.col("cache_hits").cast("long").alias("cache_hits"))
    u = t.unionByName(g)
    is_t, is_g = F.col("src") == "t", F.col("src") == "g"
    one = u.agg(
        F.count_distinct(F.when(is_t, F.col("cand_key"))).alias("unique_configs"),
        F.avg(F.when(is_t & (F.col("cost") > 0), F.col("cost"))).alias("mean_cost_per_candidate"),
        F.max(F.when(is_t & (F.col("fitness") >= 0), F.col("fitness"))).alias("best_fitness"),
        F.count_if(is_g).alias("generations"),
        F.sum(F.when(is_g, F.col("cache_hits"))).alias("hits"),
        F.avg(F.when(is_g, F.col("cost"))).alias("mean_cost_per_generation"),
    )
    return one.select(
        "unique_configs",
        (F.col("unique_configs") * 100.0 / S.SPACE_SIZE).alias("coverage_pct"),
        (F.col("hits") * 100.0 / F.greatest(F.col("generations") * pop_size, F.lit(1))).alias("hit_rate_pct"),
        "mean_cost_per_generation", "mean_cost_per_candidate", "best_fitness", "generations",
    )


def savings(log: DataFrame, warmup: int = S.WARMUP_GENERATIONS) -> DataFrame:
    """Per-generation extrapolation of the warm-up cost versus what was spent.

    The estimate scales the warm-up *per generation* (not the warm-up total)
    by the number of generations.
    """
    per_gen = log.filter(F.col("gen").isNotNull())
    w = per_gen.agg(
        F.count(F.lit(1)).alias("generations"),
        F.sum("new_evals").alias("actual_evals"),
        F.sum("rows_scored").alias("actual_cost"),
        F.avg(F.when(F.col("gen") <= warmup, F.col("new_evals"))).alias("warmup_evals_per_gen"),
        F.avg(F.when(F.col("gen") <= warmup, F.col("rows_scored"))).alias("warmup_cost_per_gen"),
    )
    est_e = F.col("warmup_evals_per_gen") * F.col("generations")
    est_c = F.col("warmup_cost_per_gen") * F.col("generations")
    return w.select(
        "generations", "actual_evals", "actual_cost",
        est_e.alias("estimated_evals"), est_c.alias("estimated_cost"),
        F.when(F.col("actual_evals") > 0, est_e / F.col("actual_evals")).alias("eval_ratio"),
        F.when(F.col("actual_cost") > 0, est_c / F.col("actual_cost")).alias("cost_ratio"),
    )


def topk(df: DataFrame, score: str, k: int) -> DataFrame:
    """K3: best ``k`` by a score, key as tie-break (TakeOrderedAndProject)."""
    return df.orderBy(F.col(score).desc(), F.col("cand_key")).limit(k)


def predict_main_effects(trials: DataFrame, pool: DataFrame) -> DataFrame:
    """Predicted fitness of pool candidates: the mean, over the genes, of the stored fitness of valid trials with the
    candidate's value of that gene (of all valid trials for a value never tried), rounded to 12 places.
    """
    genes = ", ".join(f"'{c}', {c}" for c in GENE_COLS)
    long = lambda df, *cols: df.selectExpr(*cols, f"stack({len(GENE_COLS)}, {genes}) AS (gene, value)")
    valid = valid_trials(trials)
    effect = long(valid, "fitness").groupBy(F.col("gene").alias("e_gene"), F.col("value").alias("e_value")).agg(
        F.avg("fitness").alias("effect"))
    overall = valid.agg(F.avg("fitness")).first()[0] or 0.0  # one number
    scored = (long(pool, "cand_key").join(effect, (F.col("gene") == F.col("e_gene")) & (F.col("value") == F.col("e_value")), "left")
              .groupBy("cand_key").agg(F.round(F.avg(F.coalesce("effect", F.lit(overall))), 12).alias("predicted")))
    return pool.select("cand_key", *GENE_COLS).join(scored, "cand_key")


def merge_evaluated(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a`` plus the rows of ``b`` whose key is not in ``a``."""
    return a.unionByName(b.join(a.select("cand_key"), "cand_key", "left_anti"))


def rank_shift(proxy: DataFrame, full: DataFrame) -> DataFrame:
    """Proxy rank versus full-data rank of the same candidates."""
    f = full.select("cand_key", F.col("fitness").alias("full_f1"))
    j = proxy.select("cand_key", "proxy_rank", F.col("fitness").alias("proxy_f1")).join(f, "cand_key")
    j = j.withColumn("full_rank", F.row_number().over(Window.orderBy(F.col("full_f1").desc(), "cand_key")))
    return j.withColumn("rank_kept", (F.col("proxy_rank") == 1) & (F.col("full_rank") == 1))
