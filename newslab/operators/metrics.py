"""Confusion counts and weighted classification metrics.

All metrics come from the nine integer confusion counts, summed with
partial + final aggregation; the floating-point formula runs once per group
with class terms in a fixed order (negatif, netral, positif), so the result
does not depend on partitioning.

Weighted definitions (zero division -> 0), with ``n_c`` true rows of class c,
``p_c`` predicted rows, ``tp_c`` hits and ``N`` rows:
precision = sum(n_c * tp_c / p_c) / N, recall = sum(tp_c) / N (= accuracy),
F1 = sum(n_c * 2 tp_c / (n_c + p_c)) / N.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 3  # number of classes


def confusion(df: DataFrame, y: str = "label_id", yhat: str = "pred_id") -> DataFrame:
    """A4: one row per observed (y, yhat) pair."""
    return df.groupBy(F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(F.count(F.lit(1)).alias("n"))


def confusion_counts(df: DataFrame, y: str = "label_id", yhat: str = "pred_id", by: Sequence[str] = (),
                     weight: str | None = None) -> DataFrame:
    """Nine conditional counts ``c{i}{j}`` per group (optionally weighted by a count column)."""
    w = F.col(weight) if weight else F.lit(1)
    aggs = [
        F.sum(F.when((F.col(y) == i) & (F.col(yhat) == j), w).otherwise(F.lit(0))).cast("long").alias(f"c{i}{j}")
        for i in range(K)
        for j in range(K)
    ]
    return df.groupBy(*by).agg(*aggs)


def _c(i: int, j: int) -> Column:
    return F.col(f"c{i}{j}")


def metric_columns() -> dict[str, Column]:
    n = [_c(i, 0) + _c(i, 1) + _c(i, 2) for i in range(K)]
    p = [_c(0, j) + _c(1, j) + _c(2, j) for j in range(K)]
    tp = [_c(i, i) for i in range(K)]
    total = n[0] + n[1] + n[2]
    prec_terms = [n[c] * F.when(p[c] > 0, tp[c] / p[c]).otherwise(F.lit(0.0)) for c in range(K)]
    f1_terms = [n[c] * F.when(n[c] + p[c] > 0, (tp[c] * 2) / (n[c] + p[c])).otherwise(F.lit(0.0)) for c in range(K)]
    safe = total > 0
    return {
        "n": total,
        "accuracy": F.when(safe, (tp[0] + tp[1] + tp[2]) / total),
        "precision": F.when(safe, (prec_terms[0] + prec_terms[1] + prec_terms[2]) / total),
        "recall": F.when(safe, (tp[0] + tp[1] + tp[2]) / total),
        "f1": F.when(safe, (f1_terms[0] + f1_terms[1] + f1_terms[2]) / total),
    }


def with_metrics(counts: DataFrame) -> DataFrame:
    return counts.withColumns(metric_columns())


def classification_metrics(df: DataFrame, y: str = "label_id", yhat: str = "pred_id", by: Sequence[str] = (),
                           weight: str | None = None) -> DataFrame:
    """A5: accuracy and weighted precision / recall / F1 per group."""
    counts = confusion_counts(df, y, yhat, by, weight)
    m = metric_columns()
    return counts.select(*by, *(v.alias(k) for k, v in m.items()))


def metrics_long(metrics: DataFrame, names: Sequence[str] = ("accuracy", "precision", "recall", "f1")) -> DataFrame:
    """One-row metric table to (metric, value) rows."""
    stack = ", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in names)
    return metrics.selectExpr(f"stack({len(names)}, {stack}) AS (metric, value)")


def compare_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """J6 + F15: full outer join on metric; ratio null when the base is 0 or missing."""
    a2 = a.select("metric", F.col("value").alias("a"))
    b2 = b.select("metric", F.col("value").alias("b"))
    j = a2.join(b2, "metric", "full_outer")
    return j.select(
        "metric", "a", "b",
        F.when(F.col("b") != 0, F.col("a") / F.col("b")).alias("ratio"),
        (F.col("a") - F.col("b")).alias("delta"),
    )


def compare_groups(metrics: DataFrame, by: str, a: str, b: str,
                   names: Sequence[str] = ("accuracy", "precision", "recall", "f1")) -> DataFrame:
    """J6 + F15 for two groups of one metric table: one aggregation turns its rows into columns ``a`` and ``b``."""
    stack = ", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in names)
    both = metrics.selectExpr(by, f"stack({len(names)}, {stack}) AS (metric, value)").groupBy("metric").agg(
        F.max(F.when(F.col(by) == a, F.col("value"))).alias("a"), F.max(F.when(F.col(by) == b, F.col("value"))).alias("b"))
    return both.select("metric", "a", "b", F.when(F.col("b") != 0, F.col("a") / F.col("b")).alias("ratio"),
                       (F.col("a") - F.col("b")).alias("delta"))
