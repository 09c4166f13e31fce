"""Generation loop (G9) with a persistent evaluation cache.

Each generation is a handful of small Spark plans: population (md5 draws)
-> distinct (U1) -> anti join with the stored trials (J1) -> sweep of the
unseen candidates over the feature vectors (G5) -> append to the trials
store with the measured seconds -> next generation (G4) from the stored
results.  The store and the population log live in the shared folder, so each
generation re-reads Parquet instead of chaining lineage across generations,
and a lost executor only re-runs the current generation's small jobs.

Optional surrogate screening (G7, G8): after ``warmup`` generations a
Spark ML regressor trained on the stored trials scores a pool (random, or
offspring of the best) and only the best ``topk`` unseen candidates are
evaluated; the generation's population is then its cached members plus those
``topk``.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslab import schema as S
from newslab.operators import search as G
from newslab.sources import files


@dataclass
class SearchResult:
    trials_path: str
    populations_path: str
    generations_run: int
    stopped_early: bool
    wall_seconds: list


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def _early_stop_state(bests: list, patience: int | None) -> tuple[float, int, bool]:
    """Running best, streak and stop flag after the given per-generation bests (None = all failed)."""
    best_so_far, streak = -1.0, 0
    for b in bests:
        if patience is None or b is None:
            continue
        if b > best_so_far:
            best_so_far, streak = b, 0
        else:
            streak += 1
            if streak >= patience:
                return best_so_far, streak, True
    return best_so_far, streak, False


def run_search(spark: SparkSession, vectors: DataFrame, store: str, pop_size: int = S.POPULATION_SIZE,
               generations: int = S.GENERATIONS, seed: int = S.SEED, patience: int | None = None,
               surrogate: str | None = None, warmup: int = S.WARMUP_GENERATIONS, pool: int = S.SURROGATE_POOL,
               topk: int = S.SURROGATE_TOPK, parent_scope: str = "population", retry_failed: bool = False,
               pool_source: str = "random") -> SearchResult:
    """Run (or resume) the search; trials and populations are appended under ``store``.

    Per generation: the population (at most pop_size + topk rows) is pinned on the driver and logged, its candidates
    without a stored result are swept over the vectors in one job and appended to the trials store, and the next
    population is drawn from the stored results.  ``vectors`` are those of the split that fitness is measured on.
    ``retry_failed`` evaluates stored failures again; ``pool_source`` is ``random`` or ``offspring``.  A store that
    already holds generations is resumed: the last logged generation's missing evaluations are completed and the run
    continues from the next generation, so a restarted driver repeats no work.
    """
    trials_path = f"{store}/trials"
    pops_path = f"{store}/populations"
    pop_cols = ["gen", "slot", "cand_key", *G.GENE_COLS]
    pop_schema = "gen INT, slot INT, cand_key STRING, " + ", ".join(f"{c} INT" for c in G.GENE_COLS)
    bests: list = []
    walls = []

    def stored() -> DataFrame:
        """Results by candidate; of a failure that was tried again the latest result."""
        trials = files.load_trials(spark, trials_path)
        if not retry_failed:
            return trials
        best = trials.groupBy("cand_key").agg(F.max_by(F.struct(*[c for c in trials.columns if c != "cand_key"]),
                                                       F.col("fitness")).alias("t"))
        return best.select("cand_key", "t.*")

    def evaluate(pop: DataFrame, gen: int) -> DataFrame:
        todo = G.distinct_candidates(pop)
        if _exists(spark, trials_path):
            known = stored()
            todo = G.unseen(todo, known.filter("fitness >= 0") if retry_failed else known)
        t0, staged = time.time(), f"{store}/staged-{gen}"
        G.sweep(todo, vectors).withColumn("gen", F.lit(gen)).write.mode("overwrite").parquet(staged)
        fresh = spark.read.parquet(staged)
        n = fresh.count()
        if n or not _exists(spark, trials_path):
            files.append_trials(fresh.withColumn("seconds", F.lit((time.time() - t0) / max(n, 1))), trials_path)
        evaluated = pop.join(stored().select("cand_key", "fitness"), "cand_key")
        if patience is not None:  # one number per generation
            bests.append(evaluated.agg(F.max(F.when(F.col("fitness") >= 0, F.col("fitness")))).first()[0])
        return evaluated

    def following(evaluated: DataFrame, gen: int) -> DataFrame:
        parents_from = stored() if parent_scope == "history" else evaluated
        return G.next_generation(parents_from, pop_size, seed, gen + 1)

    start = 1
    population = G.create_population(spark, pop_size, seed, 1)
    if _exists(spark, pops_path):
        logged = spark.read.parquet(pops_path)
        last = logged.agg(F.max("gen")).first()[0]  # one number
        if last:
            if patience is not None:
                for g in range(1, last):
                    done = logged.filter(F.col("gen") == g).join(files.load_trials(spark, trials_path), "cand_key")
                    bests.append(done.agg(F.max(F.when(F.col("fitness") >= 0, F.col("fitness")))).first()[0])
            rows = logged.filter(F.col("gen") == last).select(*pop_cols).collect()
            pop = spark.createDataFrame([tuple(r) for r in rows], pop_schema)
            evaluated = evaluate(pop, last)
            _, _, stopped = _early_stop_state(bests, patience)
            if stopped or last >= generations:
                return SearchResult(trials_path, pops_path, last, stopped, walls)
            population = following(evaluated, last)
            start = last + 1

    gen = start - 1
    stopped = False
    for gen in range(start, generations + 1):
        t0 = time.time()
        if surrogate is not None and gen > warmup and _exists(spark, trials_path):
            from newslab.operators import ml

            model = ml.fit_surrogate(files.load_trials(spark, trials_path), kind=surrogate)
            if model is not None:
                pool_df = (G.next_generation(stored(), pool, seed, gen) if pool_source == "offspring"
                           else G.create_population(spark, pool, seed, gen, tag="pool"))
                pred = ml.screen(model, G.distinct_candidates(pool_df))
                best = G.topk(pred, "predicted", topk).select("cand_key", *G.GENE_COLS)
                # Only the screened top-k are evaluated; population members are
                # looked up in the store (uncached ones are not evaluated).
                cached = population.select("cand_key", *G.GENE_COLS).join(
                    files.load_trials(spark, trials_path).select("cand_key").distinct(), "cand_key", "left_semi")
                population = cached.unionByName(best)
                # pop_size + topk rows: a global order is cheap and deterministic
                population = population.withColumn(
                    "slot", (F.row_number().over(Window.orderBy("cand_key")) - 1).cast("int"))
                population = population.withColumn("gen", F.lit(gen)).select(*pop_cols)
        # Pin the population on the driver (bounded) and log it.
        rows = population.select(*pop_cols).collect()
        pop = spark.createDataFrame([tuple(r) for r in rows], pop_schema)
        pop.write.mode("append").parquet(pops_path)
        evaluated = evaluate(pop, gen)
        walls.append(time.time() - t0)
        _, _, stopped = _early_stop_state(bests, patience)
        if stopped:
            break
        if gen < generations:
            population = following(evaluated, gen)
    return SearchResult(trials_path, pops_path, gen, stopped, walls)
