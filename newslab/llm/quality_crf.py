"""Operator 10, quality rules: a linear-chain conditional random field labels lines as content or boilerplate.

Viterbi decoding gives the most probable labels of a document's lines; the document stays if the share of its
characters in content lines reaches a threshold and it passes the base rules on words and repetition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslab.llm.common import WORD_GAP_CHARS, text_or_empty

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
REPEAT_WINDOW = 5
MAX_REPEAT_PERCENT = 20
#: Labelled documents per quality value that the field is fitted on, and the lines taken of each in fitting.
SAMPLE_DOCS, SAMPLE_LINES = 800, 100
MIN_CONTENT = 0.5
FEATURES = ("bias", "upper", "symbols", "exclaim", "digits", "punctuation", "words", "word_length", "duplicate", "ended",
            "stutter")
RESULT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, content_share double")
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
                     ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
                     ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("content_share", pa.float64())])
_ENDS = tuple(".!?:;\"”»…")
_GAP, _LOWER, _UPPER, _DIGIT, _SYMBOL, _EXCLAIM, _OTHER = range(7)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    out = np.full(0x110000, _OTHER, np.uint8)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            out[cp] = _UPPER if ch.isupper() else _LOWER
        elif ch.isdigit():
            out[cp] = _DIGIT
    for ch in SYMBOLS:
        out[ord(ch)] = _SYMBOL
    for ch in WORD_GAP_CHARS:
        out[ord(ch)] = _GAP
    out[ord("!")] = _EXCLAIM
    return out


def repeated_words(words: np.ndarray, width: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more, from the words' 64-bit hashes."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        h = words[:n].astype(np.uint64)
        for i in range(1, width):
            h = h * np.uint64(0x9E3779B97F4A7C15) + words[i:n + i].astype(np.uint64)
            h ^= h >> np.uint64(29)
    _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    if not len(starts):
        return 0
    step = np.zeros(len(words) + 1, np.int64)
    step[starts] += 1  # starts are distinct
    np.subtract.at(step, starts + width, 1)
    return int((np.cumsum(step[:-1]) > 0).sum())


@dataclass
class Measured:
    """Base measures of a text and the features of its lines that have a word, with their characters."""

    n_words: int = 0
    word_chars: int = 0
    n_symbols: int = 0
    n_dup_lines: int = 0
    n_repeat_words: int = 0
    features: np.ndarray = None
    weights: np.ndarray = None


def measure(text: str) -> Measured:
    words = text.encode("utf-8", "replace").split()  # on exactly the six ASCII white-space characters
    if not words:
        return Measured(features=np.empty((0, len(FEATURES))), weights=np.empty(0))
    kinds = _classes()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    hashes = np.fromiter(map(hash, words), np.int64, len(words))
    lines = text.split("\n")
    starts = np.concatenate(([0], np.cumsum([len(s) + 1 for s in lines[:-1]]))).astype(np.int64)
    kinds = np.concatenate((kinds, [_GAP])).astype(np.uint8)  # so that each line, even the last, has a character
    seen, duplicate, ended = set(), [], []
    for s in lines:
        duplicate.append(s in seen)
        seen.add(s)
        ended.append(s.rstrip(WORD_GAP_CHARS).endswith(_ENDS))
    by = {k: np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in range(7)}
    inside = kinds != _GAP
    first = inside & ~np.concatenate(([False], inside[:-1]))
    n_words = np.add.reduceat(first, starts, dtype=np.int64)
    chars = sum(by[k] for k in range(1, 7))
    same = np.concatenate(([False], hashes[1:] == hashes[:-1]))
    ends = np.cumsum(n_words)
    total_same = np.concatenate(([0], np.cumsum(same)))
    stutter = total_same[ends] - total_same[ends - n_words]
    letters = by[_LOWER] + by[_UPPER]
    filled = n_words > 0
    one = np.maximum(chars, 1)
    x = np.stack([np.ones(len(lines)), by[_UPPER] / np.maximum(letters, 1), np.minimum(5 * by[_SYMBOL] / one, 2),
                  np.minimum(5 * by[_EXCLAIM] / one, 2), by[_DIGIT] / one, by[_OTHER] / one, np.log1p(n_words) / 4,
                  np.minimum(chars / np.maximum(n_words, 1) / 10, 3), np.array(duplicate, float), np.array(ended, float),
                  stutter / np.maximum(n_words, 1)], axis=1)
    return Measured(len(words), int(chars.sum()), int(by[_SYMBOL].sum()), int((np.array(duplicate) & filled).sum()),
                    repeated_words(hashes), x[filled], chars[filled].astype(float))


@dataclass(frozen=True)
class LineField:
    """Two-state field: state 0 is content, state 1 boilerplate. ``emit`` (2, features), ``move`` (2, 2), ``begin`` (2)."""

    emit: np.ndarray
    move: np.ndarray
    begin: np.ndarray

    def viterbi(self, x: np.ndarray) -> np.ndarray:
        """Most probable states of the lines with features ``x``; ties go to content."""
        scores = (x @ self.emit.T).tolist()
        (a, b), (c, d) = self.move.tolist()
        s0, s1 = (scores[0][k] + float(self.begin[k]) for k in (0, 1))
        back = []
        for e0, e1 in scores[1:]:
            back.append((s1 + c > s0 + a, s1 + d >= s0 + b))
            s0, s1 = max(s0 + a, s1 + c) + e0, max(s0 + b, s1 + d) + e1
        state = int(s1 > s0)
        path = [state]
        for step in reversed(back):
            state = int(step[state])
            path.append(state)
        return np.array(path[::-1])


def train(sequences: list[np.ndarray], labels: list[np.ndarray], steps: int = 300, rate: float = 0.1,
          decay: float = 1e-3) -> LineField:
    """Maximum likelihood by gradient steps (Adam) on padded sequences; forward-backward gives the expectations."""
    n, longest, width = len(sequences), max(map(len, sequences)), sequences[0].shape[1]
    x, y, live = np.zeros((n, longest, width)), np.zeros((n, longest), int), np.zeros((n, longest))
    for i, (s, l) in enumerate(zip(sequences, labels)):
        x[i, :len(s)], y[i, :len(s)], live[i, :len(s)] = s, l, 1
    gold = np.eye(2)[y] * live[..., None]
    pair_live = live[:, 1:] * live[:, :-1]
    gold_move = np.einsum("nta,ntb->ab", gold[:, :-1] * pair_live[..., None], gold[:, 1:])
    total = live.sum()
    theta = {"emit": np.zeros((2, width)), "move": np.zeros((2, 2)), "begin": np.zeros(2)}
    m = {k: np.zeros_like(v) for k, v in theta.items()}
    v = {k: np.zeros_like(p) for k, p in theta.items()}
    for step in range(1, steps + 1):
        e = x @ theta["emit"].T
        e[:, 0] += theta["begin"]
        move = np.exp(theta["move"])
        ex = np.exp(e - e.max(axis=2, keepdims=True))
        f, b = np.zeros_like(ex), np.ones_like(ex)
        f[:, 0] = ex[:, 0] / ex[:, 0].sum(1, keepdims=True)
        for t in range(1, longest):
            g = (f[:, t - 1] @ move) * ex[:, t]
            f[:, t] = np.where(live[:, t, None] > 0, g / g.sum(1, keepdims=True), f[:, t - 1])
        for t in range(longest - 2, -1, -1):
            g = (ex[:, t + 1] * b[:, t + 1]) @ move.T
            b[:, t] = np.where(live[:, t + 1, None] > 0, g / g.sum(1, keepdims=True), 1.0)
        node = f * b
        node = node / node.sum(2, keepdims=True) * live[..., None]
        pair = f[:, :-1, :, None] * move * (ex[:, 1:] * b[:, 1:])[:, :, None, :]
        pair = pair / pair.sum((2, 3), keepdims=True) * pair_live[..., None, None]
        grad = {"emit": np.einsum("nts,ntw->sw", gold - node, x) / total, "move": (gold_move - pair.sum((0, 1))) / total,
                "begin": (gold[:, 0] - node[:, 0]).sum(0) / n}
        for k in theta:
            g = grad[k] - decay * theta[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            theta[k] = theta[k] + rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return LineField(theta["emit"], theta["move"], theta["begin"])


#: Used where there are no labelled documents of both kinds: capitals, symbols, calls and stutter mark boilerplate.
UNTRAINED = LineField(np.stack([np.zeros(len(FEATURES)), np.array([-3.0, 4, 4, 4, 2, 1, 0, 0, 2, -0.5, 4])]),
                      np.array([[0.5, 0.0], [0.0, 0.5]]), np.zeros(2))


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LineField:
    """A field fitted on the lines of a bounded sample of labelled documents.

    ``labels`` has doc_id and quality (1 good, 0 bad); a line takes the label of its document.  Only line features
    reach the driver (at most ``SAMPLE_LINES`` lines of about ``sample_docs`` documents per label).
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    sizes = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if set(sizes) != {0, 1}:
        return UNTRAINED
    drawn = (known.sampleBy("quality", {k: min(1.0, sample_docs / n) for k, n in sizes.items()}, seed=5)
             .limit(3 * sample_docs).withColumnRenamed("doc_id", "l_id"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(q, x.astype("<f4").tobytes()) for q, t in zip(batch.column(0).to_pylist(), batch.column(1))
                    if len(x := measure(t.as_py()).features[:SAMPLE_LINES])]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                              pa.array([r[1] for r in rows], pa.binary())], names=["quality", "x"])

    rows = (docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(drawn), F.col("doc_id") == F.col("l_id"))
            .select("quality", "text").mapInArrow(lines, "quality int, x binary").collect())
    if {r["quality"] for r in rows} != {0, 1}:
        return UNTRAINED
    rows.sort(key=lambda r: (r["quality"], bytes(r["x"])))
    sequences = [np.frombuffer(r["x"], "<f4").reshape(-1, len(FEATURES)).astype(float) for r in rows]
    return train(sequences, [np.full(len(s), 1 - r["quality"]) for r, s in zip(rows, sequences)])


def apply_rules(docs: DataFrame, field: LineField, min_content: float = MIN_CONTENT) -> DataFrame:
    """Measures and verdict for every row of ``docs`` (doc_id, text; other columns ignored).

    ``content_share`` is the share of word characters in lines labelled content (0 without words); ``kept`` needs it
    to reach ``min_content`` and ``base_failed`` to be false.  A null text has no words and fails; repeated rows get
    equal results; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            out = []
            for text in batch.column(1):
                m = measure(text.as_py())
                failed = m.n_words < MIN_WORDS or 100 * m.n_repeat_words > MAX_REPEAT_PERCENT * m.n_words
                share = float(m.weights[model.viterbi(m.features) == 0].sum() / m.weights.sum()) if m.n_words else 0.0
                out.append((m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, failed,
                            not failed and share >= min_content, share))
            cols = list(zip(*out)) if out else [()] * 8
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, _RESULT.types[1:]))],
                                             schema=_RESULT)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, RESULT)
