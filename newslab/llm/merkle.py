"""Operator 12, Merkle manifest of a dataset: a subtree per language, subroots folded to one root, a proof per row.

Leaves get their place in their subtree from a range sort and are dealt in superblocks of consecutive places.  Going up,
each superblock is reduced to one node, which is a leaf of the next round, so a round shrinks the table by the size of a
superblock.  Going down, each superblock of nodes is cogrouped with the outer path of the node it became (a row with a
sibling per level): one ``applyInPandas`` finishes the local reduction, joins local and outer siblings to proofs and folds
the leaf that was read (tampered where the caller says so) back to a root.  Text never moves: leaves are hashed at the scan.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslab.llm.common import written

#: Levels that one superblock covers: at most 2 ** LEVELS leaves meet in one group.
LEVELS = 10
#: Rows of nodes or paths that share a file between rounds.
FILE_ROWS = 200_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_POS_BITS = 33  # monotonically_increasing_id: partition << 33 | row in it
_LEFT, _RIGHT, _ALONE = "L", "R", ""


def hashed(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length in bytes, ``:`` and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_hash(n_chars: Column | None = None) -> Column:
    """Hash of a document's fields; ``n_chars`` takes the place of the column of that name."""
    cols = [F.col(c) if c != "n_chars" or n_chars is None else n_chars for c in FIELDS]
    return F.sha2(F.concat(*map(field, cols)), 256)


def every_seventh() -> Column:
    """Rows whose check in the query is tampered with: 7 divides crc32 of the decimal doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0


def levels_of(n: int) -> int:
    """Levels of a binary tree over ``n`` leaves."""
    return (int(n) - 1).bit_length()


def reduce_levels(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, the given ones first; a last node without partner is hashed alone."""
    out = [nodes]
    for _ in range(levels):
        nodes = [hashed(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def siblings(tree: list[list[str]], place: int) -> list[str]:
    """Per level the sibling on the way up from ``place``: side and hash, empty where a node is alone."""
    path = []
    for nodes in tree[:-1]:
        other = place ^ 1
        path.append((_LEFT if other < place else _RIGHT) + nodes[other] if other < len(nodes) else _ALONE)
        place >>= 1
    return path


def fold(leaf: str, path: list[str]) -> str:
    for s in path:
        leaf = hashed(s[1:], leaf) if s.startswith(_LEFT) else hashed(leaf, s[1:])
    return leaf


def placed(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Add pos (from 0, by ``order``) and n (rows) per value of ``tree``, which is not null.

    A range sort gives each row its partition and its row there; a table of (partition, tree) sizes gives the start of
    each run.  A tree's rows may fill many partitions; equal rows are dealt over several by a tie number.
    """
    spark = rows.sparkSession
    keys = [tree, *order, "m_tie"]
    ordered = written(rows.withColumn("m_tie", F.monotonically_increasing_id())
                      .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)
                      .withColumn("m_id", F.monotonically_increasing_id())
                      .withColumn("m_part", F.shiftright("m_id", _POS_BITS)).drop("m_tie"), "merkle-ordered")
    runs = ordered.groupBy("m_part", tree).agg(F.count(F.lit(1)).alias("m_rows"), F.min("m_id").alias("m_first"))
    w = Window.partitionBy(tree)  # a row per partition at most
    starts = (runs.withColumn("n", F.sum("m_rows").over(w))
              .withColumn("m_start", F.coalesce(F.sum("m_rows").over(
                  w.orderBy("m_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select("m_part", tree, "n", (F.col("m_start") - F.col("m_first")).alias("m_shift")))
    return (ordered.join(starts, ["m_part", tree]).withColumn("pos", F.col("m_id") + F.col("m_shift"))
            .drop("m_part", "m_id", "m_shift"))


def _block(levels: int) -> Column:
    return F.shiftright("pos", levels).alias("block")


def _reducer(levels: int) -> Callable:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n"].iloc[0])
        tree = reduce_levels(rows.sort_values("pos")["node"].tolist(), min(levels, levels_of(n)))
        return pd.DataFrame({"tree": [key[0]], "n": [-(-n >> levels)], "pos": [key[1]], "node": [tree[-1][0]]})

    return run


def _packed(df: DataFrame, rows: int) -> DataFrame:
    """A small table in few files."""
    return df.repartition(1 + rows // FILE_ROWS)


def climb(nodes: DataFrame, levels: int) -> list[tuple[DataFrame, int]]:
    """Tables (tree, n, pos, node) and their rows, round by round, the last with one node per tree; the first is ``nodes``."""
    rounds = [nodes]
    sizes = []
    while True:
        most, rows = rounds[-1].agg(F.max("n"), F.count(F.lit(1))).first()
        sizes.append(rows)
        if (most or 0) <= 1:
            return list(zip(rounds, sizes))
        step = rounds[-1].select("tree", "n", "pos", "node", _block(levels)).groupBy("tree", "block")
        step = step.applyInPandas(_reducer(levels), "tree string, n long, pos long, node string")
        rounds.append(written(_packed(step, rows >> levels), "merkle-round"))


def _descender(levels: int) -> Callable:
    def run(key: tuple, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        tree = reduce_levels(rows["node"].tolist(), min(levels, levels_of(rows["n"].iloc[0])))
        path = list(outer["path"].iloc[0])
        return pd.DataFrame({"tree": rows["tree"], "pos": rows["pos"], "subroot": outer["subroot"].iloc[0], "root": outer["root"].iloc[0],
                             "path": [siblings(tree, i) + path for i in range(len(rows))]})

    return run


def descend(rounds: list[tuple[DataFrame, int]], outer: DataFrame, levels: int) -> DataFrame:
    """Outer paths of the nodes of ``rounds[0]`` from those of ``rounds[-1]`` (tree, pos, subroot, root, path)."""
    for nodes, size in reversed(rounds[:-1]):
        paths = (nodes.select("tree", "n", "pos", "node", _block(levels)).groupBy("tree", "block")
                 .cogroup(outer.select("tree", F.col("pos").alias("block"), "subroot", "root", "path").groupBy("tree", "block"))
                 .applyInPandas(_descender(levels), outer.schema))
        outer = written(_packed(paths, size), "merkle-paths")
    return outer


RESULT = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _finisher(levels: int) -> Callable:
    def run(key: tuple, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        leaves = rows["node"].tolist()
        tree = reduce_levels(leaves, min(levels, levels_of(rows["n"].iloc[0])))
        path, root = list(outer["path"].iloc[0]), outer["root"].iloc[0]
        proofs, folded = [], []
        for i, (leaf, read) in enumerate(zip(leaves, rows["read"].tolist())):
            proof = siblings(tree, i) + path
            proofs.append(hashed(*(s[1:] for s in proof)))
            folded.append(fold(read or leaf, proof))
        return pd.DataFrame({"doc_id": rows["doc_id"], "leaf": leaves, "subroot": outer["subroot"].iloc[0], "root": root,
                             "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded]})

    return run


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text; other columns ignored): the leaf, the subroot of
    its language, the root, a digest of its proof, and the root that the leaf folds to with this proof.

    ``tampered`` marks rows read back with n_chars + 1 (a null stays null): their leaf is recomputed from that before it
    is folded, so ``verified`` is false for them.

    Nulls in any column have a leaf of their own (``-``); a null lang is a subtree of its own and comes first, a null
    doc_id comes first in its subtree.  Rows that share a doc_id follow the hash of their leaf; equal rows are equal leaves
    at neighbouring places.  Empty and long texts are hashed whole.  An empty table gives no rows.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree")
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    read = F.when(tampered if tampered is not None else F.lit(False), leaf_hash(more)).alias("read")
    rows = docs.select(*FIELDS).select(tree, F.col("doc_id").cast("long").alias("doc_id"), leaf_hash().alias("node"), read)
    leaves = placed(rows, "tree", ["doc_id", "node"])
    rounds = climb(leaves, levels)
    tops = rounds[-1][0].select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "node")
    tops = placed(tops, "tree", ["lang"])
    top_rounds = climb(tops, levels)
    root = top_rounds[-1][0].select("tree", "pos", F.lit("").alias("subroot"), F.col("node").alias("root"),
                                 F.array().cast("array<string>").alias("path"))
    tops_out = descend(top_rounds, root, levels).select("pos", "root", "path").withColumnRenamed("pos", "t_pos")
    outer = (tops.join(tops_out, F.col("pos") == F.col("t_pos"))
             .select(F.col("lang").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("node").alias("subroot"), "root", "path"))
    # The nodes just above the leaves get their outer paths first; a subtree of one leaf is its own outer node.
    outer = descend(rounds[1:], outer, levels) if len(rounds) > 1 else outer
    out = (leaves.select("tree", "n", "pos", "node", "read", F.col("doc_id").cast("string").alias("doc_id"), _block(levels)).groupBy("tree", "block")
           .cogroup(outer.select("tree", F.col("pos").alias("block"), "subroot", "root", "path").groupBy("tree", "block"))
           .applyInPandas(_finisher(levels), RESULT))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
