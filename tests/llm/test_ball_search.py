"""Ranked search against brute force over every document, and the bounds that close subtrees."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslab.llm import ball_search
from tests.conftest import SF001
from tests.llm.conftest import BASE

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, top=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        q, found = Counter(terms(text)), []
        for i, c in counted:
            m = 25 + 75 * c.total() * n_docs // total
            score = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t, r in q.items())
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item_id, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found)[:top])]
    return Counter(out)


def found(docs, items, **kw):
    return Counter(tuple(r) for r in ball_search.search(docs, items, **kw).collect())


def test_equals_brute_force_on_documents(spark):
    docs, items = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert found(docs, items) == want
    assert found(docs, items, tree_docs=30, leaf=2, seed_docs=40, item_bytes=500) == want


@pytest.mark.parametrize("leaf,tree_docs,top", [(1, 3, 10), (16, 4096, 10), (4, 7, 2)])
def test_edges(spark, docs, leaf, tree_docs, top):
    items = [(0, BASE), (1, None), (2, ""), (3, "word WORD one"), (3, "one two three"), (None, "漢字 éèü É x"), (4, "unheard-of terms only"),
             (5, "der die das " * 50), (6, " \t.,;")]
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], items, top)
    assert found(docs, spark.createDataFrame(items, ITEMS), leaf=leaf, tree_docs=tree_docs, top=top, seed_docs=4) == want


def test_ties_take_the_smallest_ids(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(500, 0, -1)] + [(None, "same words here"), (600, "other")],
                                 "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([(1, "same here")], ITEMS)
    got = ball_search.search(docs, items, tree_docs=64, leaf=4, seed_docs=50).orderBy("rank").collect()
    assert [(r.rank, r.doc_id) for r in got] == [(i, i) for i in range(1, 11)] and len({r.score for r in got}) == 1


def test_clashing_names_and_empty(spark, docs, clashing, empty):
    items = spark.createDataFrame([(0, BASE), (1, "one two")], ITEMS)
    more = items.select("*", *[F.lit("x").alias(c) for c in ("no", "item", "score", "rank", "doc_id", "n", "ids")])
    assert found(clashing.withColumns({c: F.lit(1) for c in ("no", "tfs", "id", "scored", "score", "item", "item_id")}), more) == found(docs, items)
    assert ball_search.search(empty, items).count() == 0
    assert ball_search.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def random_tree(seed, rows=400, vocabulary=300, leaf=8):
    r = np.random.default_rng(seed)
    lengths = r.integers(1, 40, rows)
    ids = np.concatenate([np.sort(r.choice(vocabulary, n, replace=False)) for n in lengths])
    values = r.integers(1, 10**6, len(ids))
    starts = np.concatenate(([0], np.cumsum(lengths)))
    weights = r.integers(1, 12_000, vocabulary)
    tree = ball_search.BallTree(starts, ids, values, np.argsort(np.argsort(weights)) * 16 // vocabulary, np.sqrt(weights.astype(float)), leaf)
    return r, tree, starts, ids, values, weights


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_at_every_node(seed):
    r, tree, starts, ids, values, weights = random_tree(seed)

    def rows_under(node):
        children, leaf = tree.nodes[node][3:]
        return np.concatenate([rows_under(c) for c in children]) if children else leaf[0]

    for _ in range(20):
        q = np.sort(r.choice(len(weights), 25, replace=False))
        dense = np.zeros(len(weights), np.int64)
        dense[q] = weights[q]
        scores = np.add.reduceat(values * dense[ids], starts[:-1])
        at = np.searchsorted(tree.terms, q)
        here = tree.terms[np.minimum(at, len(tree.terms) - 1)] == q
        for node in range(len(tree.nodes)):
            assert tree.bound(node, at[here], weights[q][here] / tree.spread[at[here]]) >= scores[rows_under(node)].max()
        best: list = []
        tree.search(ball_search.Query(0, q, weights[q]), best, 1, list(range(len(starts) - 1)))
        want = sorted(((int(s), -i) for i, s in enumerate(scores) if s > 0), reverse=True)[:10]
        assert sorted(best, reverse=True) == want


def test_subtrees_are_closed():
    """A row that repeats the query is found by opening few leaves; without bounds all would be."""
    r, tree, starts, ids, values, weights = random_tree(9, rows=2000, vocabulary=3000, leaf=4)
    row = slice(starts[5], starts[6])
    opened = tree.search(ball_search.Query(0, ids[row], weights[ids[row]]), [], int((values[row] * weights[ids[row]]).sum()), list(range(2000)))
    assert opened < 100
