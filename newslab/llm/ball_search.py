"""Operator 11, ranked lexical search: exact inner-product search in sparse ball trees.

A document is a sparse vector over the items' terms, an item a sparse query, and the score their inner product.  The
documents of a scan split go, a bounded block at a time, into balanced trees; every node keeps a centroid and a radius
per term group, so that no document below it can score above query . centroid + sum of |query| * radius, rounded up.
Subtrees are opened best-first and left closed when their bound is under the item's tenth best score so far; leaves are
scored exactly in 64-bit integers.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslab.llm.common import text_or_empty, written

#: Fixed values of the score.
SCALE, K1, SLOPE = 1_000_000_000, 8, 75
TOP = 10
#: Text of the items that one pass over the documents takes (its terms and weights are broadcast), in bytes.
ITEM_BYTES = 2_000_000
#: Documents and vector entries in one tree at most (a document with more entries is a tree by itself), documents in a leaf.
TREE_DOCS, TREE_ENTRIES, LEAF = 4096, 1_000_000, 16
#: Terms are dealt to so many groups by weight, each with a radius of its own.
GROUPS = 16
#: Documents, about, whose search gives every item a first threshold.
SEED_DOCS = 8192
#: Relative and absolute room for rounding in radii and bounds: far above the error of sums of a million doubles.
ROOM, STEP = 1e-9, 1.0
_TERM = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_NO_ID = 2**63  # of a null doc_id, above every other
VECTORS = "doc_id long, n long, ids array<int>, tfs array<int>"


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all other code points; only A-Z is lower-cased."""
    return text.translate(_TERM).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Query:
    """An item: its distinct term ids, ascending, and their summed weights (64-bit integers)."""

    item_id: int | None
    ids: np.ndarray
    weights: np.ndarray


class BallTree:
    """A balanced tree over sparse rows: ``ids`` and ``values`` (64-bit integers) of row i lie at ``starts[i]:starts[i + 1]``.

    ``group`` and ``spread`` give each term's radius group and the scale in which distances are taken: values are
    multiplied by ``spread`` and queries divided by it, which leaves inner products as they are.
    """

    def __init__(self, starts: np.ndarray, ids: np.ndarray, values: np.ndarray, group: np.ndarray, spread: np.ndarray,
                 leaf: int = LEAF):
        self.terms, local = np.unique(ids, return_inverse=True)
        self.group, self.spread = group[self.terms], spread[self.terms]
        self.n_groups = int(group.max()) + 1 if len(group) else 1
        scaled = values * self.spread[local]
        #: Per node: term positions of the centroid, its values there, radius per group, children or rows of a leaf.
        self.nodes: list[tuple] = []
        self._starts, self._local, self._values, self._scaled = starts, local, values, scaled
        self._grow(np.arange(len(starts) - 1), leaf)
        del self._starts, self._local, self._values, self._scaled

    def _take(self, rows: np.ndarray):
        a, b = self._starts[rows], self._starts[rows + 1]
        lengths = b - a
        first = np.concatenate(([0], np.cumsum(lengths)))
        at = np.arange(first[-1]) - np.repeat(first[:-1], lengths) + np.repeat(a, lengths)
        return first[:-1], np.repeat(np.arange(len(rows)), lengths), at

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        first, row, at = self._take(rows)
        local, x = self._local[at], self._scaled[at]
        support, where = np.unique(local, return_inverse=True)
        centre = np.bincount(where, x) / len(rows)
        # Squared distance by group: the centroid's whole square, corrected at the entries that a row has.
        g = self.group[support]
        squares = np.bincount(g, centre * centre, self.n_groups)
        entry = row * self.n_groups + g[where]
        size = len(rows) * self.n_groups
        distance = (squares + np.bincount(entry, x * x - 2 * x * centre[where], size).reshape(-1, self.n_groups))
        room = ROOM * (squares + np.bincount(entry, x * x, size).reshape(-1, self.n_groups))
        radius = np.sqrt((np.maximum(distance, 0) + 4 * room).max(axis=0)) * (1 + ROOM)
        index = len(self.nodes)
        self.nodes.append(None)
        if len(rows) <= leaf:
            table = np.zeros((len(support), len(rows)), np.int64)
            table[where, row] = self._values[at]
            self.nodes[index] = (support, centre, radius, None, (rows, table))
            return index
        far = int(distance.sum(axis=1).argmax())
        side = self._beside(first, local, x, far)
        other = int(side.argmin())
        order = np.argsort(side - self._beside(first, local, x, other), kind="stable")
        half = len(rows) // 2
        children = self._grow(rows[np.sort(order[:half])], leaf), self._grow(rows[np.sort(order[half:])], leaf)
        self.nodes[index] = (support, centre, radius, children, None)
        return index

    def _beside(self, first: np.ndarray, local: np.ndarray, x: np.ndarray, pivot: int) -> np.ndarray:
        """Inner product with a pivot row, relative to its length."""
        end = first[pivot + 1] if pivot + 1 < len(first) else len(local)
        p = np.zeros(len(self.terms))
        p[local[first[pivot]:end]] = x[first[pivot]:end]
        return np.add.reduceat(x * p[local], first) - (p @ p) / 2

    def bound(self, node: int, at: np.ndarray, q: np.ndarray) -> float:
        """No row under ``node`` scores more. ``at``: term positions, ascending; ``q``: the query's values there."""
        support, centre, radius, _, _ = self.nodes[node]
        where = np.searchsorted(support, at)
        where[where == len(support)] = 0
        here = support[where] == at  # a term that no row here has adds to no score
        p = q[here]
        length = np.sqrt(np.bincount(self.group[at[here]], p * p, self.n_groups))
        return float(p @ centre[where[here]] + length @ radius) * (1 + ROOM) + STEP

    def search(self, query: Query, best: list, floor: int, doc_ids: list[int], top: int = TOP) -> int:
        """Add rows to the heap ``best`` of (score, -doc_id), at most ``top``; scores under ``floor`` needn't be found.

        Returns how many leaves were scored.
        """
        at = np.searchsorted(self.terms, query.ids)
        at[at == len(self.terms)] = 0
        here = self.terms[at] == query.ids
        at, weights = at[here], query.weights[here]
        if not len(at):
            return 0
        q = weights / self.spread[at]
        queue, scored = [(-self.bound(0, at, q), 0)], 0
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < (max(floor, best[0][0]) if len(best) == top else floor):
                break
            support, _, _, children, rows = self.nodes[node]
            if children:
                for child in children:
                    heapq.heappush(queue, (-self.bound(child, at, q), child))
                continue
            scored += 1
            where = np.searchsorted(support, at)
            where[where == len(support)] = 0
            here = support[where] == at
            members, table = rows
            scores = weights[here] @ table[where[here]]
            least = max(1, floor, best[0][0] if len(best) == top else 0)
            for i in np.flatnonzero(scores >= least).tolist():
                found = (int(scores[i]), -doc_ids[members[i]])
                if len(best) < top:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return scored


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms of the text) and the ids and counts of the terms in ``vocabulary``, for texts with a term."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value.get
        for batch in batches:
            n, lengths, ids, tfs, keep = [], [], [], [], []
            for text in batch.column(1).cast(pa.binary()):
                words = terms(text.as_py())
                keep.append(bool(words))
                if not words:
                    continue
                found, counts = np.unique(np.array([i for i in map(known, words) if i is not None], np.int32), return_counts=True)
                n.append(len(words))
                lengths.append(len(found))
                ids.append(found)
                tfs.append(counts.astype(np.int32))
            offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(v) if v else np.empty(0, np.int32), pa.int32()))
                     for v in (ids, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_())), pa.array(n, pa.int64()), *lists],
                                             names=["doc_id", "n", "ids", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, VECTORS)


def tree_blocks(batches: Iterator[pa.RecordBatch], docs: int, entries: int):
    """Bounded groups of vectors: lists of doc_id, n, ids, tfs.  Vectors without an entry can't score and are left out."""
    ids, n, terms_, tfs, size = [], [], [], [], 0
    for batch in batches:
        offsets = np.asarray(batch.column(2).offsets)
        all_ids, all_tfs = (np.asarray(batch.column(k).values) for k in (2, 3))
        for i, (doc, length) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            a, b = offsets[i], offsets[i + 1]
            if a == b:
                continue
            if ids and (len(ids) >= docs or size + b - a > entries):
                yield ids, n, terms_, tfs
                ids, n, terms_, tfs, size = [], [], [], [], 0
            ids.append(_NO_ID if doc is None else doc)
            n.append(length)
            terms_.append(all_ids[a:b])
            tfs.append(all_tfs[a:b])
            size += b - a
    if ids:
        yield ids, n, terms_, tfs


def best_rows(found: DataFrame, queries: list[Query], weights: np.ndarray, n_docs: int, n_terms: int, floors: list[int],
              top: int = TOP, tree_docs: int = TREE_DOCS, leaf: int = LEAF) -> DataFrame:
    """(item, item_id, doc_id, score, scored): each split's best rows of every query, and the leaves it scored for it."""
    # Groups of terms of like weight; distances are taken in values times the root of the weight.
    group = (np.argsort(np.argsort(weights, kind="stable"), kind="stable") * GROUPS // max(1, len(weights))).astype(np.int64)
    spread = np.sqrt(np.maximum(weights, 1)).astype(float)
    sent = found.sparkSession.sparkContext.broadcast((queries, group, spread, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, group, spread, floors = sent.value
        best, scored = [[] for _ in queries], [0] * len(queries)
        for doc_ids, n, ids, tfs in tree_blocks(batches, tree_docs, TREE_ENTRIES):
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            m = 100 - SLOPE + (SLOPE * np.array(n, np.int64) * n_docs) // n_terms
            tf = np.concatenate(tfs).astype(np.int64)
            tree = BallTree(np.concatenate(([0], np.cumsum(lengths))), np.concatenate(ids).astype(np.int64),
                            (SCALE * tf) // (1000 * tf + K1 * np.repeat(m, lengths)), group, spread, leaf)
            for k, query in enumerate(queries):
                scored[k] += tree.search(query, best[k], floors[k], doc_ids, top)
        rows = [(k, queries[k].item_id, None if -doc == _NO_ID else -doc, score, scored[k])
                for k, heap in enumerate(best) for score, doc in heap]
        cols = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), *[pa.int64()] * 4))],
                                         names=["item", "item_id", "doc_id", "score", "scored"])

    return found.mapInArrow(run, "item int, item_id long, doc_id long, score long, scored long")


def _item_blocks(items: DataFrame, item_bytes: int) -> Iterator[list]:
    """Rows (item_id, text) in blocks of about ``item_bytes`` of text, dealt by a row number."""
    rows = written(items.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text"))
                   .withColumn("no", F.monotonically_increasing_id()), "search-items")
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = -(-size // item_bytes)
    for i in range(blocks):
        yield rows.filter(F.pmod(F.xxhash64("no"), F.lit(blocks)) == i).orderBy("no").collect()


def search(docs: DataFrame, items: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES, tree_docs: int = TREE_DOCS,
           leaf: int = LEAF, seed_docs: int = SEED_DOCS) -> DataFrame:
    """The ``top`` highest scores above 0 of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text): item_id,
    rank (from 1), doc_id, score; equal scores by ascending doc_id, a null doc_id last.  Other columns are ignored.

    A null or empty text has no terms: such a document counts nowhere, such an item has no rows.  Rows that share a doc_id
    are documents each; rows that share an item_id (or have none) are ranked each by itself.  Long texts count whole.  An
    empty table on either side gives no rows.  Items are taken in blocks of bounded size, one pass over the documents each;
    a first search of about ``seed_docs`` documents gives a floor under each item's tenth best score, which changes cost only.
    """
    out = None
    for block in _item_blocks(items, item_bytes):
        words = [terms(r["text"].encode()) for r in block]
        vocabulary = {t: i for i, t in enumerate(sorted({t for w in words for t in w}))}
        if not vocabulary:
            continue
        found = written(vectors(docs, vocabulary), "search-vectors")
        n_docs, n_terms = found.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        counts = found.select(F.explode("ids").alias("id")).groupBy("id").count().toArrow()  # a row per term of the block
        df = np.zeros(len(vocabulary), np.int64)
        df[counts["id"].to_numpy()] = counts["count"].to_numpy()
        weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
        queries = []
        for r, w in zip(block, words):
            ids, repeats = np.unique(np.array([vocabulary[t] for t in w], np.int64), return_counts=True)
            queries.append(Query(r["item_id"], ids, repeats * weights[ids]))
        run = lambda rows, floors: best_rows(rows, queries, weights, n_docs, n_terms, floors, top, tree_docs, leaf)
        floors = [1] * len(queries)
        if n_docs > seed_docs:
            first = run(found.sample(seed_docs / n_docs, 3), floors)
            ranked = first.withColumn("r", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"))))
            for r in ranked.filter(F.col("r") == top).select("item", "score").collect():
                floors[r["item"]] = r["score"]
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = (run(found, floors).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
                  .select("item_id", "rank", "doc_id", "score"))
        out = ranked if out is None else out.unionAll(ranked)
    return out if out is not None else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
