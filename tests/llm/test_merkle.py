"""The manifest against a brute-force recursion over whole lists."""

from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from newslab.llm import merkle
from tests.llm.conftest import DOCS


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def up(nodes):
    return [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]


def path_of(nodes, i):
    out = []
    while len(nodes) > 1:
        first = i - i % 2
        out.append((nodes[first:i], nodes[i + 1:first + 2]))
        nodes, i = up(nodes), i // 2
    return out, nodes[0]


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    order = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    for t in trees.values():
        t.sort(key=lambda x: x[:3])
    subroots = [path_of([x[2] for x in trees[t]], 0)[1] for t in order]
    out = []
    for k, t in enumerate(order):
        nodes = [x[2] for x in trees[t]]
        outer, root = path_of(subroots, k)
        for i, (_, _, own, r) in enumerate(trees[t]):
            path = path_of(nodes, i)[0] + outer
            bad = r[0] is not None and crc32(str(r[0]).encode()) % 7 == 0
            folded = leaf(*r[:4], None if r[4] is None else r[4] + bad)
            for left, right in path:
                folded = h(*left, folded, *right)
            out.append((r[0], own, subroots[k], root, h(*(s for a, b in path for s in a + b)), folded, folded == root))
    return out


def found(docs, **kw):
    return Counter(tuple(r) for r in merkle.manifest(docs, merkle.every_seventh(), **kw).collect())


def rows_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_equals_recursion_on_edges(docs, levels):
    assert found(docs, levels=levels) == Counter(brute(rows_of(docs)))


@pytest.mark.parametrize("n,langs,levels", [(1, 1, 2), (2, 1, 1), (5, 5, 1), (67, 2, 2), (129, 1, 3), (40, 13, 2)])
def test_shapes(spark, n, langs, levels):
    rows = [(i * 3, f"text {i}", None if i % langs == 0 else f"l{i % langs}é", "s", None if i % 5 == 0 else i) for i in range(n)]
    assert found(spark.createDataFrame(rows, DOCS).repartition(4), levels=levels) == Counter(brute(rows))


def test_one_tampered_row_breaks_only_its_own_proof(spark):
    rows = [(i, "t", "en", "s", 1) for i in range(50)]
    got = merkle.manifest(spark.createDataFrame(rows, DOCS), F.col("doc_id") == 7).collect()
    assert [r.doc_id for r in got if not r.verified] == [7]
    assert not any(r.verified is False for r in merkle.manifest(spark.createDataFrame(rows, DOCS)).collect())


def test_equal_rows_repeated_and_largest_values(spark):
    big = 2**63 - 1
    rows = [(5, "same", "en", "s", 1)] * 300 + [(big, "x" * 200_000, "en", None, big), (-big, "", "de", "", -1), (None, None, None, None, None)]
    assert found(spark.createDataFrame(rows, DOCS).repartition(5), levels=3) == Counter(brute(rows))


def test_clashing_names_and_empty(docs, clashing, empty):
    more = clashing.select("*", *[F.lit("x").alias(c) for c in ("tree", "read", "pos", "m_tie", "m_id", "m_part", "block", "path", "root",
                                                               "leaf", "subroot", "m_rows", "m_first", "n_part")])
    assert found(more) == found(docs)
    assert merkle.manifest(empty).count() == 0


def test_fold_needs_every_sibling(docs):
    """Switching one sibling of a proof off changes the root that a leaf folds to."""
    tree = merkle.reduce_levels([merkle.hashed(str(i)) for i in range(11)], merkle.levels_of(11))
    for i in range(11):
        path = merkle.siblings(tree, i)
        assert merkle.fold(tree[0][i], path) == tree[-1][0]
        for k in range(len(path)):
            assert merkle.fold(tree[0][i], path[:k] + ["R" + "0" * 64] + path[k + 1:]) != tree[-1][0]
