"""Many text classifiers trained together (M1 with G5): one pass over hashed features serves every candidate.

Words are hashed once, at each width that a candidate uses, and stored as sparse counts.  A pass sends the stacked weights
of all candidates that still run to the tasks; each task returns the sum of its rows' gradients, cut into slices that Spark
adds up; the driver takes one accelerated proximal step per candidate.  So a pass costs one scan however many candidates
there are, and only weights and gradients (``STACK_BYTES``, set by the widths and not by the data) reach the driver.

Every smaller width folds the widest one, so a pass reads the counts at the widest width only and the factors that scale
each row, both stored once per training.  Its words' weights side by side make one matrix for all candidates: columns of
common words meet it as a dense product, rare ones entry by entry.  Candidates that differ in nothing but when they stop
(or in a rare-word limit that leaves no word out) walk the same path, which is computed once.

Model: multinomial logistic regression on tf-idf rows of length ``LENGTH``, intercepts unpenalised, objective
``mean log loss + reg * (l1_ratio * |W|_1 + (1 - l1_ratio) / 2 * |W|^2)``.  The step is 1 / (curvature + l2), where the
curvature is half a bound on the largest eigenvalue of the rows' mean outer product: for a matrix without negative entries
it is at most the largest ratio (Av)_i / v_i of any positive v, and a few rounds of v <- Av bring that near.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslab.functions import text as X
from newslab.session import remove, scratch_path

CLASSES = 3
#: Weights of the candidates that are trained together; more candidates are trained in groups, one after the other.
STACK_BYTES = 32 * 1024 * 1024
#: Gradients that meet in one place (the driver if all of them fit, else a task per slice), and features of rows taken up at
#: once, at most.
SLICE_BYTES, ENTRIES = 64 * 1024 * 1024, 200_000
#: Words in at least this share of the rows are columns of a dense block of at most so many cells (one row at least).
COMMON, CELLS = 1 / 64, 1 << 20
MAX_WIDTH = 1 << 18
#: Rows that a task takes at least, as every task sends a gradient, which costs about as much as so many rows.
TASK_ROWS = 2000
LENGTH = 8.0
#: Passes that bound the curvature.
ROUNDS = 4


@dataclass
class Candidate:
    """Parameters of one classifier and, after training, its weights (width + 1, classes; the last row is the intercept)."""

    key: str
    width: int
    min_df: int
    reg: float
    l1_ratio: float
    max_iter: int
    tol: float
    weights: np.ndarray | None = None
    iterations: int = 0
    seconds: float = 0.0
    curvature: float = 0.0
    error: str | None = None
    _ahead: np.ndarray | None = field(default=None, repr=False)
    _pace: float = field(default=1.0, repr=False)

    @classmethod
    def of(cls, key: str, params: dict) -> Candidate:
        """From parameters as named by Spark's classifiers; a wrong one makes a candidate with an error."""
        c = cls(key, params["numFeatures"], params["minDocFreq"], params["regParam"], params["elasticNetParam"], params["maxIter"], params["tol"])
        if not (0 < c.width <= MAX_WIDTH and c.width & (c.width - 1) == 0):
            c.error = f"numFeatures must be a power of two up to {MAX_WIDTH}, is {c.width}"
        elif not (c.reg >= 0 and 0 <= c.l1_ratio <= 1 and c.max_iter >= 0 and c.min_df >= 0):
            c.error = f"regParam {c.reg}, elasticNetParam {c.l1_ratio}, maxIter {c.max_iter} or minDocFreq {c.min_df} is out of range"
        return c

    @property
    def live(self) -> bool:
        return self.error is None

    def begin(self) -> None:
        self.weights = self._ahead = np.zeros((self.width + 1, CLASSES))

    def step(self, gradient: np.ndarray) -> float:
        """One accelerated proximal step; the largest change of a weight."""
        if not np.isfinite(gradient).all():
            self.error = f"gradient not finite at iteration {self.iterations + 1}"
            return 0.0
        l1, l2 = self.reg * self.l1_ratio, self.reg * (1 - self.l1_ratio)
        rate = 1 / (self.curvature + l2)
        penal = l2 * self._ahead
        penal[-1] = 0
        new = self._ahead - rate * (gradient + penal)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * l1, 0)
        pace = (1 + math.sqrt(1 + 4 * self._pace ** 2)) / 2
        moved = new - self.weights
        self._ahead = new + (self._pace - 1) / pace * moved
        self.weights, self._pace = new, pace
        self.iterations += 1
        return float(np.abs(moved).max())

    def follow(self, other: Candidate) -> None:
        """Take the place of a candidate on the same path."""
        self.weights, self._ahead, self._pace, self.iterations, self.error = other.weights, other._ahead, other._pace, other.iterations, other.error

    def done(self, moved: float) -> bool:
        return not self.live or self.iterations >= self.max_iter or moved <= self.tol


def _cols(width: int) -> tuple[str, str]:
    return f"i{width}", f"c{width}"


def hashed_features(df: DataFrame, widths: Sequence[int], keep: Sequence[str], text: str = "clean_text") -> DataFrame:
    """``keep`` columns and, per width, distinct hashed words (``i<width>``) and their counts (``c<width>``) of each row.

    Words are hashed next to the scan; widths are powers of two, so the smaller hash follows from the larger.
    """
    widths = sorted(set(widths))
    words = F.transform(X.tokens(F.col(text)), lambda t: F.pmod(F.hash(t), F.lit(max(widths))))
    rows = df.select(*keep, words.alias("words"))
    schema = rows.select(*keep).schema
    names = [c for w in widths for c in _cols(w)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, ids = _entries(batch.column(len(keep)))
            lists = []
            for w in widths:
                pairs, counts = np.unique(row * w + ids % w, return_counts=True)
                offsets = np.concatenate(([0], np.cumsum(np.bincount(pairs // w, minlength=len(batch)))))
                for values in (pairs % w, counts):
                    lists.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32())))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *lists], names=[*keep, *names])

    for c in names:
        schema = schema.add(c, T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(count, schema)


def _offsets(column: pa.Array) -> np.ndarray:
    """Where the elements of a list column, or of a binary one of packed 32-bit numbers, begin."""
    if pa.types.is_binary(column.type):
        return np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset) // 4 if len(column) else np.zeros(1, np.int32)
    return np.asarray(column.offsets)


def _entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of every element of a list column."""
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.values)[offsets[0]:offsets[-1]].astype(np.int64)
    return np.repeat(np.arange(len(column)), np.diff(offsets)), values


def _sums(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Sums of ``values`` (entries, columns) by row; entries are ordered by row."""
    out = np.zeros((rows, values.shape[1]))
    if len(row):
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[first]] = np.add.reduceat(values, first, axis=0)
    return out


@dataclass
class Stack:
    """Candidates grouped by what their rows look like (width and rare words left out), with idf by group.

    Limits that leave out the same words make one group, under the smallest of them; ``idf`` has them all.
    """

    groups: dict[tuple[int, int], list[int]]
    idf: dict[tuple[int, int], np.ndarray]

    @classmethod
    def of(cls, candidates: Sequence[Candidate], df: dict[int, np.ndarray], rows: int) -> Stack:
        kinds = sorted({(c.width, c.min_df) for c in candidates if c.live})
        idf = {(w, m): np.where(df[w] >= m, np.log((rows + 1) / (df[w] + 1)), 0.0) for w, m in kinds}
        first = {g: next(o for o in kinds if o[0] == g[0] and np.array_equal(idf[o], idf[g])) for g in kinds}
        groups: dict[tuple[int, int], list[int]] = {}
        for i, c in enumerate(candidates):
            if c.live:
                groups.setdefault(first[c.width, c.min_df], []).append(i)
        return cls(groups, idf)

    def only(self, members: Sequence[int]) -> Stack:
        """The groups of some candidates."""
        kept = {g: [i for i in m if i in members] for g, m in self.groups.items()}
        return Stack({g: m for g, m in kept.items() if m}, {g: self.idf[g] for g, m in kept.items() if m})

    def scaled(self, batch: pa.RecordBatch, names: list[str]):
        """(members, entries' rows, feature numbers, values, factor by row) of every group; ``names``: the batch's columns."""
        for (width, min_df), members in self.groups.items():
            i, c = _cols(width)
            row, ids = _entries(batch.column(names.index(i)))
            counts = _entries(batch.column(names.index(c)))[1]
            value = counts * self.idf[width, min_df][ids]
            length = np.sqrt(_sums((value * value)[:, None], row, len(batch))[:, 0])
            yield members, row, ids, value, LENGTH / np.where(length > 0, length, 1)

    def parts(self, batch: pa.RecordBatch, names: list[str]):
        """(members, entries' rows, feature numbers, values) of every group; ``names``: the batch's columns."""
        for members, row, ids, value, factor in self.scaled(batch, names):
            yield members, row, ids, value * factor[row]


def _probabilities(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=2, keepdims=True))
    return z / z.sum(axis=2, keepdims=True)


def _scores(weights: list[np.ndarray], row: np.ndarray, ids: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """Class probabilities (rows, candidates, classes) for stacked weights."""
    stacked = np.concatenate(weights, axis=1)
    return _probabilities((_sums(stacked[ids] * value[:, None], row, rows) + stacked[-1]).reshape(rows, len(weights), CLASSES))


def _slices(batch: pa.RecordBatch, lists: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in runs of a bounded number of features (one row at least)."""
    sizes = np.diff(_offsets(batch.column(lists)))
    run = np.cumsum(sizes) // ENTRIES
    first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(run) else []
    for a, b in zip(first, [*first[1:], len(batch)]):
        yield pa.RecordBatch.from_arrays([pa.concat_arrays([c.slice(a, b - a)]) for c in batch.columns], names=batch.schema.names)


def _packed(values: np.ndarray) -> bytes:
    """Numbers for the wire; features that a task's rows don't have are zeros, which take little room."""
    return pa.compress(values.tobytes(), codec="lz4_raw", asbytes=True)


def _unpacked(part, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(part, decompressed_size=8 * size, codec="lz4_raw", asbytes=True))


def _summed(features: DataFrame, names: list[str], total: int, over, rows: int) -> np.ndarray:
    """Sum over all tasks of the vector of length ``total`` that ``over`` makes of its batches; ``rows``: about the rows."""
    most = 2 * features.sparkSession.sparkContext.defaultParallelism  # a vector per task, not per file
    data = features.select(*names).coalesce(min(most, 1 + rows // TASK_ROWS))
    tasks = max(1, data.rdd.getNumPartitions())
    few = 8 * total * tasks <= SLICE_BYTES
    size = total if few else int(min(65_536, max(1024, SLICE_BYTES // (8 * tasks))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = over(batch for whole in batches for batch in _slices(whole, 1))
        cuts = range(0, total, size)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cuts)), pa.int32()), pa.array([len(out[a:a + size]) for a in cuts], pa.int32()),
                                          pa.array([_packed(out[a:a + size]) for a in cuts], pa.binary())], names=["slice", "n", "part"])

    def summed(group: pa.Table) -> np.ndarray:
        out = np.zeros(group.column("n")[0].as_py())
        for part in group.column("part"):
            out += _unpacked(part.as_buffer(), len(out))
        return out

    def add(group: pa.Table) -> pa.Table:
        return pa.table({"slice": group.column("slice")[:1], "n": group.column("n")[:1], "part": pa.array([_packed(summed(group))], pa.binary())})

    schema = "slice int, n int, part binary"
    parts = data.mapInArrow(run, schema)
    if few:
        return summed(parts.toArrow())
    found = parts.groupBy("slice").applyInArrow(add, schema).collect()
    return np.concatenate([_unpacked(r["part"], r["n"]) for r in sorted(found, key=lambda r: r["slice"])])


def _names(label: str, widths) -> list[str]:
    return [label, *[c for w in sorted(set(widths)) for c in _cols(w)]]


def _ints(column: pa.Array) -> np.ndarray:
    """All 32-bit numbers of a column of packed ones."""
    offsets = _offsets(column)
    return np.frombuffer(column.buffers()[2] or b"", np.int32)[offsets[0]:offsets[-1]]


def training_rows(features: DataFrame, stack: Stack, label: str) -> DataFrame:
    """What every pass reads: ``label``, hashed words at the widest width and their counts (packed 32-bit numbers), and per
    group of ``stack``, in order, the factor that makes the row ``LENGTH`` long."""
    groups = sorted(stack.groups)
    names = _names(label, [w for w, _ in groups])
    widest = [names.index(c) for c in _cols(max(w for w, _ in groups))]
    sent = features.sparkSession.sparkContext.broadcast(Stack({g: [k] for k, g in enumerate(groups)}, {g: stack.idf[g] for g in groups}))

    def packed(column: pa.Array) -> pa.Array:
        values = np.ascontiguousarray(_entries(column)[1], np.int32)
        offsets = np.ascontiguousarray(4 * (_offsets(column) - column.offsets[0].as_py()), np.int32)
        return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(offsets), pa.py_buffer(values)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, 1):
                factors = np.empty((len(batch), len(groups)))
                for (k,), *_, factor in sent.value.scaled(batch, names):
                    factors[:, k] = factor
                ends = pa.array(np.arange(len(batch) + 1) * len(groups), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0), *(packed(batch.column(c)) for c in widest),
                                                  pa.ListArray.from_arrays(ends, pa.array(factors.reshape(-1)))],
                                                 names=[label, "words", "counts", "factors"])

    schema = features.select(label).schema.add("words", T.BinaryType()).add("counts", T.BinaryType()).add("factors", T.ArrayType(T.DoubleType()))
    return features.select(*names).mapInArrow(run, schema)


@dataclass
class Columns:
    """Hashed words of the widest table, common ones first; words that no training row holds are left out."""

    width: int
    order: np.ndarray
    common: int
    groups: list[tuple[int, int]]

    @classmethod
    def of(cls, df: np.ndarray, rows: int, stack: Stack) -> Columns:
        order = np.argsort(-df, kind="stable")[:np.count_nonzero(df)]
        return cls(len(df), order, int(np.count_nonzero(df >= max(1, COMMON * rows))), sorted(stack.groups))


class _Sums:
    """For several models over some rows: the sums of x_r * t(x_r . w), with x_r the row's tf-idf and 1 for the intercept.

    ``kinds``: group and idf of each model; ``vectors``: its weights w, the intercept last; ``turn``: from (scores, labels)
    of rows to t, both (rows, models, columns of w).
    """

    def __init__(self, columns: Columns, kinds: list[tuple[tuple[int, int], np.ndarray]], vectors: list[np.ndarray], turn):
        self.columns, self.kinds, self.turn = columns, kinds, turn
        self.group = [columns.groups.index(g) for g, _ in kinds]
        self.place = np.empty(columns.width, np.int64)
        self.place[columns.order] = np.arange(len(columns.order))
        weights = np.concatenate([(idf[:, None] * v[:-1])[columns.order % w] for ((w, _), idf), v in zip(kinds, vectors)], axis=1)
        self.common, self.rare = weights[:columns.common], np.ascontiguousarray(weights[columns.common:].T)
        self.intercepts = np.stack([v[-1] for v in vectors])
        self.common_sums, self.rare_sums, self.intercept_sums = (np.zeros_like(a) for a in (self.common, self.rare, self.intercepts))
        self.block = np.zeros((0, columns.common))

    def add(self, batch: pa.RecordBatch) -> None:
        n, common = len(batch), self.columns.common
        if not n:
            return
        row = np.repeat(np.arange(n), np.diff(_offsets(batch.column(1))))
        place, counts = self.place[_ints(batch.column(1))], _ints(batch.column(2)).astype(float)
        y = np.asarray(batch.column(0)).astype(int)
        factors = batch.column(3).flatten().to_numpy().reshape(n, -1)[:, self.group]
        rare, dense = np.flatnonzero(place >= common), np.flatnonzero(place < common)
        where, rare_row, rare_count = place[rare] - common, row[rare], counts[rare]
        z = np.empty((n, len(self.rare)))
        for c, line in enumerate(self.rare):
            z[:, c] = np.bincount(rare_row, rare_count * line[where], n)
        cell_row, cell, cell_count = row[dense], place[dense], counts[dense]
        most = max(1, CELLS // max(1, common))
        cuts = [(a, min(n, a + most)) for a in range(0, n, most)]
        bounds = np.searchsorted(cell_row, [a for a, _ in cuts] + [n])
        away = np.empty((n, *self.intercepts.shape))
        for (a, b), lo, hi in zip(cuts, bounds, bounds[1:]):
            x = self._dense(b - a, cell_row[lo:hi] - a, cell[lo:hi], cell_count[lo:hi])
            scores = (z[a:b] + x @ self.common).reshape(b - a, *self.intercepts.shape) * factors[a:b, :, None] + self.intercepts
            away[a:b] = self.turn(scores, y[a:b])
            self.intercept_sums += away[a:b].sum(axis=0)
            away[a:b] *= factors[a:b, :, None]
            self.common_sums += x.T @ away[a:b].reshape(b - a, -1)
        for c, line in enumerate(np.ascontiguousarray(away.reshape(n, -1).T)):
            self.rare_sums[c] += np.bincount(where, rare_count * line[rare_row], self.rare_sums.shape[1])

    def _dense(self, n: int, row: np.ndarray, cell: np.ndarray, count: np.ndarray) -> np.ndarray:
        if len(self.block) < n:
            self.block = np.zeros((n, self.columns.common))
        x = self.block[:n]
        x.fill(0)
        x[row, cell] = count
        return x

    def result(self) -> np.ndarray:
        """Every model's sums, one after the other: words of the widest table folded to its own, scaled by idf."""
        out, size = [], self.intercepts.shape[1]
        for k, ((width, _), idf) in enumerate(self.kinds):
            whole = np.zeros((self.columns.width, size))
            mine = slice(size * k, size * (k + 1))
            whole[self.columns.order] = np.concatenate((self.common_sums[:, mine], self.rare_sums[mine].T))
            out += [(whole.reshape(-1, width, size).sum(axis=0) * idf[:, None]).reshape(-1), self.intercept_sums[k]]
        return np.concatenate(out)


def _away(scores: np.ndarray, y: np.ndarray) -> np.ndarray:
    return _probabilities(scores) - np.eye(CLASSES)[y][:, None, :]


def _along(scores: np.ndarray, y: np.ndarray) -> np.ndarray:
    return scores


def _passed(table: DataFrame, columns: Columns, kinds: list, vectors: list[np.ndarray], turn, rows: int) -> list[np.ndarray]:
    """``_Sums`` over all rows of ``training_rows``, a matrix shaped as its vector for every model."""
    sent = table.sparkSession.sparkContext.broadcast((columns, kinds, vectors, turn))

    def over(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        found = _Sums(*sent.value)
        for batch in batches:
            found.add(batch)
        return found.result()

    ends = np.cumsum([v.size for v in vectors])
    flat = _summed(table, table.columns, int(ends[-1]), over, rows)
    sent.unpersist()
    return [part.reshape(v.shape) for part, v in zip(np.split(flat, ends[:-1]), vectors)]


def gradients(table: DataFrame, columns: Columns, candidates: Sequence[Candidate], active: Sequence[int], stack: Stack,
              rows: int) -> list[np.ndarray]:
    """Sums over all rows of every active candidate's gradient of the log loss, at the weights it looks ahead to."""
    group_of = {i: g for g, members in stack.groups.items() for i in members}
    kinds = [(group_of[i], stack.idf[group_of[i]]) for i in active]
    return _passed(table, columns, kinds, [candidates[i]._ahead for i in active], _away, rows)


def curvatures(table: DataFrame, columns: Columns, stack: Stack, rows: int) -> dict[tuple[int, int], float]:
    """Per group of candidates a bound on the curvature of the mean log loss (a step's share of its inverse is safe)."""
    groups = sorted(stack.groups)
    kinds = [(g, stack.idf[g]) for g in groups]
    vectors = [np.ones((w + 1, 1)) for w, _ in groups]
    bound = np.full(len(groups), np.inf)
    for _ in range(ROUNDS):
        for k, new in enumerate(_passed(table, columns, kinds, vectors, _along, rows)):
            new, v = new / rows, vectors[k]
            there = new > 0
            bound[k] = min(bound[k], (new[there] / v[there]).max())
            vectors[k] = np.where(there, new / new.max(), v)
    return {g: bound[k] / 2 for k, g in enumerate(groups)}


def document_counts(features: DataFrame, widths: Sequence[int]) -> tuple[int, dict[int, np.ndarray]]:
    """Rows, and per width the rows that hold each hashed word (at most the width's sum of numbers reach the driver)."""
    out = {}
    for w in widths:
        counts = features.select(F.explode(_cols(w)[0]).alias("i")).groupBy("i").count().toArrow()
        out[w] = np.zeros(w, np.int64)
        out[w][counts["i"].to_numpy()] = counts["count"].to_numpy()
    return features.count(), out


def train(features: DataFrame, candidates: Sequence[Candidate], label: str = "label_id") -> Stack:
    """Train all candidates on rows of ``hashed_features`` with a label from 0 to 2; weights, iterations, seconds and
    errors are set on the candidates.  A candidate that fails keeps its error and leaves the passes; the others go on."""
    live = [c for c in candidates if c.live]
    rows, df = document_counts(features, sorted({c.width for c in live}))
    if not rows:
        for c in live:
            c.error = "no training rows"
    stack = Stack.of(candidates, df, rows)
    paths: dict[tuple, list[int]] = {}
    for g, members in stack.groups.items():
        for i in members:
            c = candidates[i]
            if c.live:
                paths.setdefault((g, c.reg * c.l1_ratio, c.reg * (1 - c.l1_ratio)), []).append(i)
    todo = sorted(paths.values())
    if not todo:
        return stack
    path = scratch_path(features.sparkSession, "training-rows")
    training_rows(features, stack, label).write.parquet(path)
    table = features.sparkSession.read.parquet(path)
    columns = Columns.of(df[max(w for w, _ in stack.groups)], rows, stack)
    for g, bound in curvatures(table, columns, stack, rows).items():
        for i in stack.groups[g]:
            candidates[i].curvature = bound
    while todo:
        group, size = [], 0
        while todo and (not group or size + 8 * CLASSES * (candidates[todo[0][0]].width + 1) <= STACK_BYTES):
            size += 8 * CLASSES * (candidates[todo[0][0]].width + 1)
            group.append(todo.pop(0))
        for i in (i for members in group for i in members):
            candidates[i].begin()
        active = [[i for i in members if candidates[i].max_iter > 0] for members in group]
        while active := [members for members in active if members]:
            t0 = time.time()
            found = gradients(table, columns, candidates, [members[0] for members in active], stack, rows)
            left = []
            for members, gradient in zip(active, found):
                first = candidates[members[0]]
                moved = first.step(gradient / rows)
                for i in members[1:]:
                    candidates[i].follow(first)
                left.append([i for i in members if not candidates[i].done(moved)])
            share = (time.time() - t0) / sum(len(members) for members in active)
            for i in (i for members in active for i in members):
                candidates[i].seconds += share
            active = left
    remove(features.sparkSession, path)
    return stack


def _trained(candidates: Sequence[Candidate]) -> list[int]:
    return [i for i, c in enumerate(candidates) if c.live and c.weights is not None]


def evaluate(features: DataFrame, candidates: Sequence[Candidate], stack: Stack, label: str = "label_id") -> DataFrame:
    """(cand_key, y, yhat, n): confusion counts of every trained candidate, in one pass; ties go to the smaller class."""
    use = _trained(candidates)
    names = _names(label, [candidates[i].width for i in use])
    sent = features.sparkSession.sparkContext.broadcast((stack.only(use), {i: candidates[i].weights for i in use}, [c.key for c in candidates]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, weights, keys = sent.value
        total = np.zeros((len(keys), CLASSES, CLASSES), np.int64)
        for whole in batches:
            for batch in _slices(whole, 1):
                y = np.asarray(batch.column(0)).astype(int)
                for members, row, ids, value in now.parts(batch, names):
                    best = _scores([weights[i] for i in members], row, ids, value, len(batch)).argmax(axis=2)
                    for j, i in enumerate(members):
                        total[i] += np.bincount(y * CLASSES + best[:, j], minlength=CLASSES * CLASSES).reshape(CLASSES, CLASSES)
        at = [(i, a, b) for i in weights for a in range(CLASSES) for b in range(CLASSES) if total[i, a, b]]
        yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i, _, _ in at], pa.string()), pa.array([a for _, a, _ in at], pa.int32()),
                                          pa.array([b for _, _, b in at], pa.int32()), pa.array([int(total[x]) for x in at], pa.int64())],
                                         names=["cand_key", "y", "yhat", "n"])

    if not use:
        return features.sparkSession.createDataFrame([], "cand_key string, y int, yhat int, n long")
    counts = features.select(*names).mapInArrow(run, "cand_key string, y int, yhat int, n long")
    return counts.groupBy("cand_key", "y", "yhat").agg(F.sum("n").alias("n"))


def score(features: DataFrame, candidate: Candidate, stack: Stack, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns with the predicted class and the three class probabilities of one trained candidate."""
    keep = list(keep)
    names = [*keep, *_cols(candidate.width)]
    group = (candidate.width, candidate.min_df)
    sent = features.sparkSession.sparkContext.broadcast((Stack({group: [0]}, {group: stack.idf[group]}), candidate.weights))
    schema = features.select(*keep).schema.add("pred_id", T.IntegerType()).add("probability", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, weights = sent.value
        for whole in batches:
            for batch in _slices(whole, len(keep)):
                for _, row, ids, value in now.parts(batch, names):
                    p = _scores([weights], row, ids, value, len(batch))[:, 0]
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * CLASSES, pa.int32()), pa.array(p.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(p.argmax(axis=1), pa.int32()), lists],
                                                     names=[*keep, "pred_id", "probability"])

    return features.select(*names).mapInArrow(run, schema)
