"""Stacked classifiers against a dense NumPy trainer, their failures, and the queries over them."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslab.operators import metrics as M
from newslab.operators import ml
from newslab.operators import stacked as K
from newslab.plans import context as C
from newslab.plans.queries import REGISTRY
from newslab.plans import extra  # noqa: F401
from tests.conftest import SF001


def candidate(key, **over):
    return K.Candidate.of(key, {"numFeatures": 4096, "minDocFreq": 0, "regParam": 0.01, "elasticNetParam": 0.0, "maxIter": 20, "tol": 0.0} | over)


CANDIDATES = {"ridge": {}, "lasso": {"elasticNetParam": 1.0, "regParam": 0.002}, "net": {"elasticNetParam": 0.5, "minDocFreq": 2},
              "free": {"regParam": 0.0, "numFeatures": 8192, "maxIter": 35}, "stops": {"tol": 0.02}, "none": {"maxIter": 0}}


def words(spark, df):
    """(label, words) of every row, and each word's hash in the widest table."""
    rows = [(r.label_id, r.clean_text.split()) for r in df.collect()]
    distinct = spark.createDataFrame([(w,) for w in sorted({w for _, t in rows for w in t})], "w string")
    return rows, {r.w: r.h for r in distinct.select("w", F.pmod(F.hash("w"), F.lit(8192)).alias("h")).collect()}


def dense(rows, code, width, df=None, min_df=0, n=None):
    x = np.zeros((len(rows), width))
    for i, (_, text) in enumerate(rows):
        for w in text:
            x[i, code[w] % width] += 1
    df = (x > 0).sum(axis=0) if df is None else df
    idf = np.array([math.log(((n or len(rows)) + 1) / (d + 1)) if d >= min_df else 0.0 for d in df])
    x = x * idf
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.hstack([8 * x / np.where(length == 0, 1, length), np.ones((len(rows), 1))]), df


def softmax(z):
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def reference(rows, code, c):
    """The same objective, minimised densely: momentum and soft threshold written out."""
    x, df = dense(rows, code, c.width, min_df=c.min_df)
    y = np.array([label for label, _ in rows])
    onehot = (y[:, None] == np.arange(3)).astype(float)
    bound, u = np.inf, np.ones(c.width + 1)
    for _ in range(4):
        a = x.T @ (x @ u) / len(y)
        bound, u = min(bound, max(a[a > 0] / u[a > 0]) / 2), np.where(a > 0, a / a.max(), u)
    assert bound >= np.linalg.eigvalsh(x @ x.T / len(y))[-1] / 2 * (1 - 1e-12)
    w = v = np.zeros((c.width + 1, 3))
    t, n = 1.0, 0
    while n < c.max_iter:
        g = x.T @ (softmax(x @ v) - onehot) / len(y)
        l1, l2 = c.reg * c.l1_ratio, c.reg * (1 - c.l1_ratio)
        u = v - (g + l2 * np.vstack([v[:-1], np.zeros((1, 3))])) / (bound + l2)
        kept = np.maximum(np.abs(u[:-1]) - l1 / (bound + l2), 0) * np.sign(u[:-1])
        new = np.vstack([kept, u[-1:]])
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, step, w, t, n = new + (t - 1) / t2 * (new - w), np.abs(new - w).max(), new, t2, n + 1
        if step <= c.tol:
            break
    return w, n, df


@pytest.fixture(scope="module")
def features(spark, tmp_path_factory):
    df = C.split(spark, SF001)
    path = str(tmp_path_factory.mktemp("features") / "rows")
    K.hashed_features(df, [4096, 8192], ["news_id", "label_id", "split", "clean_text"]).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("stack_bytes,entries,slices,task_rows", [(1 << 25, 200_000, 1 << 26, 1000), (200_000, 50, 20_000, 5)])
def test_weights_and_scores_equal_dense_training(spark, features, monkeypatch, stack_bytes, entries, slices, task_rows):
    for name, value in (("STACK_BYTES", stack_bytes), ("ENTRIES", entries), ("SLICE_BYTES", slices), ("TASK_ROWS", task_rows)):
        monkeypatch.setattr(K, name, value)
    train = features.filter("split = 'train'")
    rows, code = words(spark, train)
    other, more = words(spark, features)
    made = [candidate(k, **v) for k, v in CANDIDATES.items()]
    stack = K.train(train, made)
    counts = {(r.cand_key, r.y, r.yhat): r.n for r in K.evaluate(features, made, stack).collect()}
    for c in made:
        w, n, df = reference(rows, code, c)
        assert (c.error, c.iterations) == (None, n)
        np.testing.assert_allclose(c.weights, w, atol=1e-9)
        x, _ = dense(other, more, c.width, df, c.min_df, len(rows))
        p = softmax(x @ w)
        best = p.argmax(axis=1)
        y = np.array([label for label, _ in other])
        want = {(c.key, a, b): int(((y == a) & (best == b)).sum()) for a in range(3) for b in range(3)}
        assert {k: v for k, v in counts.items() if k[0] == c.key} == {k: v for k, v in want.items() if v}
        got = K.score(features, c, stack, ["clean_text"]).collect()
        by = {" ".join(t): (int(b), q) for (_, t), b, q in zip(other, best, p)}
        for r in got:
            assert r.pred_id == by[r.clean_text][0]
            np.testing.assert_allclose(r.probability, by[r.clean_text][1], atol=1e-9)
    assert 0 < made[4].iterations < 20  # the tolerance ended it


def test_failing_candidates_are_rows(spark, features):
    made = [candidate("width", numFeatures=1000), candidate("reg", regParam=-1.0), candidate("ratio", elasticNetParam=2.0), candidate("good")]
    blown = candidate("blown", regParam=float("inf"))
    stack = K.train(features.filter("split = 'train'"), [*made, blown])
    rows = {r.cand_key: r for r in ml.candidate_metrics(features, [*made, blown], stack, "val").collect()}
    assert all(rows[k].f1 == -1.0 and rows[k].error and rows[k].n == 0 for k in ("width", "reg", "ratio", "blown"))
    assert rows["good"].f1 >= 0 and rows["good"].error is None and rows["good"].seconds > 0
    nothing = [candidate("x")]
    K.train(features.filter("split = 'nowhere'"), nothing)
    assert nothing[0].error == "no training rows"


def test_edges_of_hashed_features(spark):
    rows = [(1, ""), (2, "a a b"), (3, " ".join(f"w{i}" for i in range(5000))), (4, None)]
    got = {r.id: r for r in K.hashed_features(spark.createDataFrame(rows, "id long, clean_text string"), [64, 1024], ["id"]).collect()}
    assert got[1].i64 == [] and sum(got[2].c1024) == 3 and sum(got[3].c64) == 5000 and len(got[3].i64) == 64
    assert all(len(r.i64) == len(r.c64) and r.i64 == sorted(set(r.i64)) for r in got.values() if r.i64 is not None)


def test_queries_give_the_metrics_of_the_scores(spark):
    candidates, stack = C.classifiers(spark, SF001)
    rows = {r.cand_key: r for r in REGISTRY["train_text_classifier"](spark, SF001).collect()}
    assert len(rows) == len(candidates) == C.CLASSIFIERS and all(r.error is None for r in rows.values())
    features = C.hashed(spark, SF001)
    scored = K.score(features.filter("split = 'val'"), candidates[3], stack, ["label_id"])
    m = M.classification_metrics(scored, "label_id", "pred_id").first()
    r = rows[candidates[3].key]
    assert (m.n, m.accuracy, m.precision, m.recall, m.f1) == (r.n, r.accuracy, r.precision, r.recall, r.f1)
    news = REGISTRY["score_news"](spark, SF001).collect()
    assert len(news) == C.news(spark, SF001).count() and all(1 / 3 <= r.confidence <= 1 for r in news)
    cmp = {r.metric: r for r in REGISTRY["baseline_vs_tuned"](spark, SF001).collect()}
    assert set(cmp) == {"accuracy", "precision", "recall", "f1"} and all(r.delta == r.a - r.b for r in cmp.values())


def test_candidates_on_one_path_are_computed_once(spark, monkeypatch):
    words = ["a b c", "a c d", "b d", "c d a a", "b c", "a d"] * 3  # every word is in more than two rows
    rows = spark.createDataFrame([(w, i % 3) for i, w in enumerate(words)], "clean_text string, label_id int")
    made = [candidate("one", minDocFreq=1), candidate("long", minDocFreq=1, maxIter=30), candidate("stops", minDocFreq=1, tol=0.02),
            candidate("rare", minDocFreq=2), candidate("other", minDocFreq=1, regParam=0.1)]
    alone = [candidate(c.key, maxIter=c.max_iter, tol=c.tol, minDocFreq=c.min_df, regParam=c.reg) for c in made]
    features = K.hashed_features(rows, [4096], ["label_id"])
    for c in alone:
        K.train(features, [c])
    sizes, plain = [], K._summed
    monkeypatch.setattr(K, "_summed", lambda f, names, total, *rest: sizes.append(total) or plain(f, names, total, *rest))
    K.train(features, made)
    path = 4097 * K.CLASSES
    assert sizes == [4097] * K.ROUNDS + [2 * path] * 20 + [path] * 10  # two paths for five candidates, one group of rows
    for c, own in zip(made, alone):
        assert c.iterations == own.iterations
        np.testing.assert_allclose(c.weights, own.weights, atol=1e-12)
