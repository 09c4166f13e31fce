"""Derived tables shared by several queries, written once per session and input.

Each is computed by Spark from the supplied tables and written as Parquet
under the shared checkpoint folder; later queries re-read it (lineage cut,
survives executor loss).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslab import schema as S
from newslab.operators import prepare as P
from newslab.operators import search as G
from newslab.operators.search_loop import SearchResult, run_search
from newslab.session import scratch_path
from newslab.sources import stored

# Data-derived lexicons and ticker words used by the registered queries: the
# supplied documents are invented prose in four languages, so frequent words
# of those languages stand in for the finance lexicon (passed as parameters).
POSITIVE = ("the", "und")
NEGATIVE = ("les", "que")
TICKER_WORDS = ("THE", "AND", "UND", "LES", "QUE")
# The supplied pages list links as items (<li><a>) and carry one article heading; a headline is an item's own link
# text, or the page's heading with the first link of its body.
HEADLINE_RULES = (("body", ("h1",)), ("li", ("a",)))
MIN_TITLE = 4

def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared news table (ETL output), written once to the shared folder.

    Cleaning whole texts is the expensive step; downstream queries (splits,
    metrics, features, search) read this table instead of re-running the
    regex chain, and a plan that uses it twice (the exact split's bucket
    counts and ranks) scans narrow columns twice instead of re-cleaning.
    """
    return stored.materialise(spark, sf_dir, "news", lambda: P.news(spark, sf_dir))


def proxy_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.stratified_subset(news(spark, sf_dir), ("label",), "news_id", S.SUBSET_FRACTION, S.SEED)


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split news table, written once: every pass of a fit reads it instead of splitting again."""
    def build():
        return P.stratified_split(news(spark, sf_dir), ("label",), "news_id").select("news_id", "clean_text", "words", "label_id", "split")

    return stored.materialise(spark, sf_dir, "split", build)


#: Candidates whose text classifiers are trained: the default and the best distinct ones of the search.
CLASSIFIERS = 20


def classifier_genes(spark: SparkSession, sf_dir: str) -> list[dict]:
    default = dict(zip(G.GENE_COLS, S.default_indices())) | {"cand_key": "-".join(str(i) for i in S.default_indices())}
    rows = G.top_distinct(trials(spark, sf_dir), CLASSIFIERS).select("cand_key", *G.GENE_COLS, "proxy_rank").collect()
    best = [r.asDict() for r in sorted(rows, key=lambda r: r["proxy_rank"])]
    return [default, *[g for g in best if g["cand_key"] != default["cand_key"]]][:CLASSIFIERS]


def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split news rows as hashed words at every width that the classifiers use."""
    from newslab.operators import ml

    return stored.materialise(spark, sf_dir, "hashed-news",
                              lambda: ml.hashed_news(split(spark, sf_dir), classifier_genes(spark, sf_dir)))


def classifiers(spark: SparkSession, sf_dir: str):
    """The trained classifiers (the default first, then by proxy rank) and what their rows look like; weights are a few
    megabytes, set by the hash widths."""
    from newslab.operators import ml

    return stored.once(spark, sf_dir, "classifiers",
                       lambda: ml.train_candidates(hashed(spark, sf_dir), classifier_genes(spark, sf_dir)))


def vectors(spark: SparkSession, sf_dir: str, which: str = "proxy") -> DataFrame:
    """Feature vectors of the proxy subset or of all rows."""

    def build():
        src = proxy_news(spark, sf_dir) if which == "proxy" else news(spark, sf_dir)
        return G.feature_vectors(src, POSITIVE, NEGATIVE)

    return stored.materialise(spark, sf_dir, f"vectors-{which}", build)


def history(spark: SparkSession, sf_dir: str) -> SearchResult:
    """The default search (seed 42, 20 per generation, 5 generations, no surrogate)."""
    return stored.once(spark, sf_dir, "history",
                       lambda: run_search(spark, vectors(spark, sf_dir, "proxy"), scratch_path(spark, "search")))


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(history(spark, sf_dir).trials_path)


def populations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(history(spark, sf_dir).populations_path)


def population_results(spark: SparkSession, sf_dir: str, gen: int) -> DataFrame:
    pop = populations(spark, sf_dir).filter(F.col("gen") == gen)
    t = trials(spark, sf_dir).select("cand_key", "fitness")
    return pop.join(t, "cand_key")


def surrogate(spark: SparkSession, sf_dir: str, kind: str = "gbt"):
    """The surrogate fitted on the default search's trials (fitted once per session).

    The fitted pipeline is saved to the shared folder, so a new driver can
    load it instead of refitting.
    """
    from pyspark.ml import PipelineModel

    from newslab.operators import ml

    def build() -> str:
        model = ml.fit_surrogate(trials(spark, sf_dir), kind=kind)
        path = scratch_path(spark, f"surrogate-{kind}")
        model.write().overwrite().save(path)
        return path

    return PipelineModel.load(stored.once(spark, sf_dir, f"surrogate-{kind}", build))
