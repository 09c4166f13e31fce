"""Queries over fitted models: keys, counts and checked conditions (model values are not bit-comparable)."""

import __spark_entry__ as E
from newslab import schema as S

from .conftest import SF01


def test_search_run_with_surrogate(spark):
    rows = E.queries()["search_run"](spark, SF01).collect()
    assert all(r.ok for r in rows)
    assert sorted(r.gen for r in rows if r.gen is not None) == list(range(1, S.WARMUP_GENERATIONS + 1))


def test_surrogate_queries(spark):
    for key, flag in (("surrogate_fit", "finite"), ("surrogate_screen", "ok"), ("surrogate_calibration", "ok")):
        rows = E.queries()[key](spark, SF01).collect()
        assert rows and all(r[flag] for r in rows), key


def test_a_failing_fit_is_a_row(spark, monkeypatch):
    from newslab.operators import ml
    from newslab.plans import context as C

    params = ml.classifier_params
    monkeypatch.setattr(ml, "classifier_params", lambda g: params(g) | ({"regParam": -1.0} if g["cand_key"] == "bad" else {}))
    rows = {r.cand_key: r for r in ml.evaluate_candidates(C.split(spark, SF01), [{"cand_key": "bad"}, {"cand_key": "good"}]).collect()}
    assert rows["bad"].f1 == -1.0 and rows["bad"].error and rows["bad"].n == 0
    assert rows["good"].f1 >= 0 and rows["good"].error is None and rows["good"].seconds > 0


def ridge(features, y):
    """Predictor from X'X sums: features standardised by the pipeline (sample spread), then features and label again by the
    regression (population spread), which penalises there."""
    import numpy as np

    mean, spread = features.mean(axis=0), features.std(axis=0, ddof=1)
    scale = np.where(spread > 0, spread, 1)
    z = (features - mean) / scale
    inner = np.where(z.std(axis=0) > 0, z.std(axis=0), 1)
    z = z / inner
    w = np.linalg.solve(z.T @ z / len(y) + 0.1 / y.std() * np.eye(z.shape[1]), z.T @ (y - y.mean()) / len(y))
    return lambda x: (x - mean) / scale / inner @ w + y.mean()


def features_of(df):
    from newslab.operators import search as G

    rows = G.candidate_features(df).toPandas()
    return rows["cand_key"].tolist(), rows[G.FEATURE_NAMES].to_numpy(float)


def test_ridge_surrogate_equals_normal_equations(spark):
    import numpy as np

    from newslab.operators import ml
    from newslab.operators import search as G
    from newslab.plans import context as C

    t = C.trials(spark, SF01)
    valid = G.valid_trials(t).select("cand_key", *G.GENE_COLS, "fitness")
    keys, x = features_of(valid)
    y = {r.cand_key: r.fitness for r in valid.collect()}
    want = ridge(x, np.array([y[k] for k in keys]))(x)
    pred = {r.cand_key: r.predicted for r in ml.screen(ml.fit_surrogate(t, kind="ridge"), t.select("cand_key", *G.GENE_COLS)).collect()}
    np.testing.assert_allclose([pred[k] for k in keys], want, rtol=1e-6)


def test_screened_generations_evaluate_the_best_predicted(spark):
    """Generation by generation: the surrogate refitted by hand on the trials so far picks the candidates that were evaluated."""
    import numpy as np

    from newslab.operators import search as G
    from newslab.operators.search_loop import run_search
    from newslab.plans import context as C
    from newslab.session import scratch_path

    res = run_search(spark, C.vectors(spark, SF01, "proxy"), scratch_path(spark, "screened"), surrogate="ridge", parent_scope="history")
    trials = spark.read.parquet(res.trials_path)
    checked = 0
    for gen in range(S.WARMUP_GENERATIONS + 1, res.generations_run + 1):
        before = G.valid_trials(trials.filter(f"gen < {gen}")).select("cand_key", *G.GENE_COLS, "fitness")
        keys, x = features_of(before)
        y = {r.cand_key: r.fitness for r in before.collect()}
        predict = ridge(x, np.array([y[k] for k in keys]))
        pool, px = features_of(G.distinct_candidates(G.create_population(spark, S.SURROGATE_POOL, S.SEED, gen, tag="pool")).select("cand_key", *G.GENE_COLS))
        ranked = sorted(zip(-predict(px), pool))
        if ranked[S.SURROGATE_TOPK][0] - ranked[S.SURROGATE_TOPK - 1][0] < 1e-9:
            continue  # a tie at the cut
        best = {k for _, k in ranked[:S.SURROGATE_TOPK]}
        assert {r.cand_key for r in trials.filter(f"gen = {gen}").collect()} == best - {r.cand_key for r in trials.filter(f"gen < {gen}").collect()}
        checked += 1
    assert checked


def test_boosted_surrogate_fits_and_calibrates(spark):
    """Boosting explains the trials it saw nearly whole, ranks their best high, and the calibration rows are its errors."""
    import numpy as np

    from newslab.operators import ml
    from newslab.operators import search as G
    from newslab.plans import context as C

    t = G.valid_trials(C.trials(spark, SF01))
    pred = ml.screen(C.surrogate(spark, SF01), t.select("cand_key", *G.GENE_COLS))
    rows = ml.surrogate_calibration(pred, t).collect()
    y, p = np.array([r.fitness for r in rows]), np.array([r.predicted for r in rows])
    assert len(rows) == t.count() and all(r.abs_err == abs(r.predicted - r.fitness) for r in rows)
    assert ((y - p) ** 2).mean() < 0.05 * y.var()
    assert p[y.argmax()] >= np.quantile(p, 0.9)


def test_report_json(spark):
    rows = E.queries()["trial_report_json"](spark, SF01).collect()
    assert sorted(r.ord for r in rows if r.section == "generation") == list(range(1, S.GENERATIONS + 1))
    assert sorted(r.ord for r in rows if r.section == "top") == [1, 2, 3]
