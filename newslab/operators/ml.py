"""Surrogate regression by Spark ML (G7, G8) and the text classifiers (M1-M3).

Classifiers of many candidates are trained together (``stacked``); one by itself can also be a Spark ML pipeline.
Scores of fitted models are beyond SQL; tests hold them against NumPy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, StandardScaler, Tokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslab import schema as S
from newslab.functions import text as X
from newslab.operators import metrics as M
from newslab.operators import search as G
from newslab.operators import stacked as K
from newslab.session import scratch_path


#: Trials in a partition while the surrogate is fitted.
ROWS_PER_PARTITION = 20_000


def fit_surrogate(trials: DataFrame, kind: str = "gbt", min_samples: int = S.MIN_SURROGATE_SAMPLES,
                  max_iter: int = 100) -> PipelineModel | None:
    """Standardise the ten candidate features and fit a regressor on valid trials.

    ``gbt``: 100 boosted trees of depth 3, step 0.1, seed 42; ``ridge``: an
    L2 linear model for small histories.  None when there are too few samples.
    """
    samples = G.candidate_features(G.valid_trials(trials).select("cand_key", *G.GENE_COLS, "fitness"))
    n = samples.count()
    if n < min_samples:
        return None
    # Boosting runs several small jobs per tree: few rows (one per candidate tried) belong in few partitions.
    samples = samples.coalesce(1 + n // ROWS_PER_PARTITION).persist()
    assembler = VectorAssembler(inputCols=G.FEATURE_NAMES, outputCol="raw_features")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    if kind == "ridge":
        reg = LinearRegression(featuresCol="features", labelCol="fitness", regParam=0.1, elasticNetParam=0.0)
    else:
        reg = GBTRegressor(featuresCol="features", labelCol="fitness", maxIter=max_iter, maxDepth=3, stepSize=0.1,
                           seed=S.SEED, checkpointInterval=-1)
    try:
        return Pipeline(stages=[assembler, scaler, reg]).fit(samples)
    finally:
        samples.unpersist()


def screen(model: PipelineModel, pool: DataFrame) -> DataFrame:
    """Predicted fitness for every pool candidate (any pool size)."""
    scored = model.transform(G.candidate_features(pool))
    return scored.select("cand_key", *G.GENE_COLS, F.col("prediction").alias("predicted"))


def surrogate_calibration(screened: DataFrame, trials: DataFrame) -> DataFrame:
    """Predicted versus measured fitness of screened candidates."""
    j = screened.join(G.valid_trials(trials).select("cand_key", "fitness"), "cand_key")
    return j.select("cand_key", "predicted", "fitness", F.abs(F.col("predicted") - F.col("fitness")).alias("abs_err"))

# ---------------------------------------------------------------------------
# Text classifier
# ---------------------------------------------------------------------------


def classifier_params(genes: dict[str, int]) -> dict:
    """Map a candidate's gene indices onto classifier parameters."""
    return {
        "numFeatures": 1 << (12 + genes.get("i_learning_rate", 1)),
        "minDocFreq": genes.get("i_batch_size", 0),
        "regParam": (0.0, 0.01, 0.1)[genes.get("i_lora_rank", 1)],
        "elasticNetParam": (0.0, 0.5, 1.0)[genes.get("i_lora_alpha", 0)],
        "maxIter": (20, 50, 100)[genes.get("i_lora_dropout", 1)],
        "tol": (1e-6, 1e-5, 1e-4)[genes.get("i_weight_decay", 0)],
    }


def train_classifier(train: DataFrame, params: dict) -> PipelineModel:
    """M1: tokenizer -> hashing TF -> IDF -> multinomial logistic regression on ``clean_text``."""
    tok = Tokenizer(inputCol="clean_text", outputCol="tok")
    tf = HashingTF(inputCol="tok", outputCol="tf", numFeatures=params["numFeatures"])
    idf = IDF(inputCol="tf", outputCol="features", minDocFreq=params["minDocFreq"])
    lr = LogisticRegression(featuresCol="features", labelCol="label_id", family="multinomial",
                            regParam=params["regParam"], elasticNetParam=params["elasticNetParam"],
                            maxIter=params["maxIter"], tol=params["tol"])
    return Pipeline(stages=[tok, tf, idf, lr]).fit(train.withColumn("label_id", F.col("label_id").cast("double")))


def score_news(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M2 + F10: whole-table scoring; confidence is the largest class probability."""
    out = model.transform(df)
    probs = vector_to_array(F.col("probability"))
    return out.select(
        *df.columns,
        F.col("prediction").cast("int").alias("pred_id"),
        X.label_name(F.col("prediction").cast("int")).alias("sentiment"),
        F.array_max(probs).alias("confidence"),
    )


def hashed_news(split_df: DataFrame, genes: Sequence[dict]) -> DataFrame:
    """The hashed words of the split news rows at every width that the candidates use, with id, label and split."""
    widths = [classifier_params(g)["numFeatures"] for g in genes]
    found = K.hashed_features(split_df, [w for w in widths if 0 < w <= K.MAX_WIDTH and w & (w - 1) == 0], ["news_id", "label_id", "split"])
    cores = split_df.sparkSession.sparkContext.defaultParallelism
    return found.repartition(cores) if found.rdd.getNumPartitions() < cores else found  # read again in every pass


def train_candidates(features: DataFrame, genes: Sequence[dict]) -> tuple[list[K.Candidate], K.Stack]:
    """M1 with G5: one classifier per candidate, all trained together on the train split of ``hashed_news``."""
    candidates = [K.Candidate.of(g["cand_key"], classifier_params(g)) for g in genes]
    return candidates, K.train(features.filter(F.col("split") == "train"), candidates)


def candidate_metrics(features: DataFrame, candidates: Sequence[K.Candidate], stack: K.Stack, eval_split: str = "val") -> DataFrame:
    """Metrics of every candidate on one split, in one pass; one that failed is a row with f1 -1 and the error's text.

    ``seconds`` is the candidate's share of the measured training time.
    """
    counts = K.evaluate(features.filter(F.col("split") == eval_split), candidates, stack)
    metrics = M.classification_metrics(counts, "y", "yhat", by=("cand_key",), weight="n")
    rows = [(c.key, c.error, c.seconds) for c in candidates]
    table = features.sparkSession.createDataFrame(rows, "cand_key string, error string, seconds double")
    ok = F.col("error").isNull()
    return table.join(metrics, "cand_key", "left").select(
        "cand_key", F.coalesce("n", F.lit(0)).alias("n"), "accuracy", "precision", "recall",
        F.when(ok, F.col("f1")).otherwise(F.lit(-1.0)).alias("f1"), "error", "seconds")


def evaluate_candidates(split_df: DataFrame, candidates: Sequence[dict], eval_split: str = "val") -> DataFrame:
    """Train one classifier per candidate, all in the same passes, and measure them on ``eval_split``."""
    features = hashed_news(split_df, candidates)
    path = scratch_path(split_df.sparkSession, "hashed-news")
    features.write.parquet(path)
    features = split_df.sparkSession.read.parquet(path)
    return candidate_metrics(features, *train_candidates(features, candidates), eval_split)
