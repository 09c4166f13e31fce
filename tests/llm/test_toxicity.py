"""The network against loops and finite differences, its windows, and held-out accuracy."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslab.llm import bigru, toxicity
from tests.conftest import SF01
from tests.llm.conftest import DOCS

CLEAN = "the river runs past old stone mills and quiet green fields where people walk in summer".split()


def corpus(n, seed=3, longest=120):
    """Texts of which some hold a word of a bad stem with changing endings."""
    r = np.random.default_rng(seed)
    out = []
    for i in range(n):
        words = [str(w) for w in r.choice(CLEAN, r.integers(1, longest))]
        bad = i % 4 == 0
        if bad:
            words[r.integers(len(words))] = "vokr" + str(r.choice(["ax", "ent", "ully", "ishm", "o"]))
        out.append((" ".join(words), int(bad)))
    return out


@pytest.fixture(scope="module")
def trained():
    rows = corpus(300)
    return bigru.fit([bigru.words_of(t) for t, _ in rows], np.array([y for _, y in rows]), steps=120, batch_words=4000)


def slow_logit(net, words):
    """One window, word by word in plain loops."""
    w, h = net.weights, bigru.HIDDEN
    x = []
    for word in words:
        marked = b"^" + word + b"$"
        total = np.zeros(bigru.CHAR_DIM)
        count = 0
        for n in bigru.GRAMS:
            for i in range(len(marked) - n + 1):
                code = n
                for byte in marked[i:i + n]:
                    code = (code ^ byte) * 0x01000193 % 2**32
                code = (code ^ code >> 15) * 0x2C1B3C6D % 2**32
                total += w["char"][(code ^ code >> 13) % bigru.BUCKETS]
                count += 1
        x.append(np.concatenate([w["word"][net.known.get(word, 0)], total / math.sqrt(count)]) @ w["in"] + w["bias"])
    sides = []
    for side, order in ((0, range(len(words))), (1, range(len(words) - 1, -1, -1))):
        state, states = np.zeros(h), {}
        for t in order:
            p = x[t][3 * h * side:3 * h * (side + 1)]
            gate = 1 / (1 + np.exp(-(p[:2 * h] + state @ w["gates"][side])))
            new = np.tanh(p[2 * h:] + (gate[h:] * state) @ w["new"][side])
            state = (1 - gate[:h]) * new + gate[:h] * state
            states[t] = state
        sides.append([states[t] for t in range(len(words))])
    states = np.concatenate(sides, axis=1)
    heed = np.exp(np.tanh(states @ w["look"] + w["look_bias"]) @ w["heed"])
    return float(heed / heed.sum() @ states @ w["out"] + w["out_bias"][0])


def slow_score(net, words):
    starts = range(0, max(1, len(words) - bigru.WINDOW + bigru.STRIDE), bigru.STRIDE)
    return max((slow_logit(net, words[i:i + bigru.WINDOW]) for i in starts), default=-math.inf) if words else -math.inf


def test_scores_equal_plain_loops(trained, docs):
    texts = [r.text for r in docs.collect()] + [t for t, _ in corpus(20, seed=8)]
    words = [bigru.words_of(t or "")[:200] for t in texts]
    np.testing.assert_allclose(trained.score(words), [slow_score(trained, w) for w in words], rtol=1e-3, atol=1e-4)


def test_gradients_equal_finite_differences():
    r = np.random.default_rng(0)
    net = bigru.Network.start({b"river": 1, b"old": 2})
    net.weights = {k: v.astype(float) for k, v in net.weights.items()}
    texts = [bigru.words_of(t) for t, _ in corpus(4, longest=60)]
    distinct, ids, lengths = bigru.index(texts)
    at, live = bigru.spread(ids, *bigru.windows(lengths)[:2])
    pull = r.normal(size=at.shape[1])

    def value():
        return float(net.run(net.embed(distinct)[0], at, live)[0].astype(float) @ pull)

    projected, embedded = net.embed(distinct)
    _, saved = net.run(projected, at, live, keep=True)
    grad = net.back(pull, saved, embedded, projected, at, live)
    for name, g in grad.items():
        assert g.shape == net.weights[name].shape
        flat = net.weights[name].reshape(-1)
        for i in np.argsort(-np.abs(g.reshape(-1)))[:4]:
            keep, step = flat[i], 1e-2
            flat[i] = keep + step
            up = value()
            flat[i] = keep - step
            down = value()
            flat[i] = keep
            assert abs((up - down) / (2 * step) - g.reshape(-1)[i]) <= 2e-2 * max(1.0, abs(g.reshape(-1)[i])), name


def test_windows_cover_every_word_and_overlap():
    for n in (0, 1, 31, 32, 33, 56, 57, 1000):
        start, size, text = bigru.windows(np.array([3, n, 2]))
        mine = [(a - 3, a - 3 + b) for a, b, t in zip(start, size, text) if t == 1]
        assert sorted({i for a, b in mine for i in range(a, b)}) == list(range(n))
        assert all(b[0] == a[0] + bigru.STRIDE < a[1] for a, b in zip(mine, mine[1:]))


def test_one_bad_word_anywhere_in_a_long_text_decides(trained, monkeypatch):
    monkeypatch.setattr(bigru, "CHUNK_WORDS", 480)
    words = bigru.words_of(" ".join(CLEAN)) * 200
    clean = trained.score([words])[0]
    assert clean < 0
    for i in (0, 479, 480, 481, 1500, len(words) - 1):
        text = list(words)
        text[i] = b"vokrully"
        assert trained.score([text])[0] > 0
        assert abs(trained.score([text])[0] - slow_score(trained, text[max(0, i - 100):i + 100])) < 3


def test_chunks_do_not_change_scores(trained, monkeypatch):
    texts = [bigru.words_of(t) for t, _ in corpus(60, seed=5, longest=400)]
    whole = trained.score(texts)
    monkeypatch.setattr(bigru, "CHUNK_WORDS", 96)
    np.testing.assert_allclose(trained.score(texts), whole, rtol=1e-4, atol=1e-4)


def test_unseen_endings_are_caught(trained):
    bad = [bigru.words_of(" ".join(CLEAN) + " vokr" + e) for e in ("ably", "ent", "otic")]
    assert (trained.score(bad) > 0).all() and trained.score([bigru.words_of(" ".join(CLEAN))])[0] < 0


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF01.replace('0.01', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    rows = (toxicity.score_documents(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").filter("held_out").collect())
    hit = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert len(hit) > 80 and sum(hit) / len(hit) > 0.85 and sum(clean) / len(clean) < 0.03
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and (r.score >= 0.5) == (r.predicted == 1) for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark):
    rows = corpus(400)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, (t, _) in enumerate(rows)], DOCS)
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(rows)], "doc_id long, quality int, toxic int")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    (a, ya), (b, yb) = toxicity.sample(docs, labels), toxicity.sample(docs, flipped)
    assert a == b and ya.tolist() == yb.tolist() and 0 < ya.sum() < len(ya)
    assert len(a) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(400))
    (c, yc) = toxicity.sample(docs.repartition(7), labels.repartition(5), toxic=20, clean=30)
    assert (sum(yc), len(yc)) == (20, 50) and (c, yc.tolist()) == (lambda r: (r[0], r[1].tolist()))(toxicity.sample(docs, labels, toxic=20, clean=30))


def test_edges(spark, docs, clashing, empty, trained):
    got = toxicity.score_documents(docs, trained).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert {r.score for r in got if r.doc_id in (3, 4, 5)} == {0.0}
    more = clashing.withColumns({c: F.lit("x") for c in ("toxic", "held_out", "score", "predicted", "t_id", "most", "o")})
    assert sorted(map(str, toxicity.score_documents(more, trained).collect())) == sorted(map(str, got))
    assert toxicity.score_documents(empty, trained).count() == 0
    labels = spark.createDataFrame([(0, None, 1), (1, 0, None), (None, 1, 1), (2, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(more, labels) is None
    assert {r.score for r in toxicity.score_documents(docs, None).collect()} == {0.0}
