"""Operator 9, language identification with language-bitmask n-gram filters.

One bit-sliced Bloom filter holds the n-grams of all languages: a slot is a word with one bit per language, and the
AND of an n-gram's slots returns every language that contains it.  A document is decided by the popcount of each
language's bit over all its n-grams, corrected for the filter's false positives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslab.llm.common import discard, text_or_empty, written

N = 4
HASHES = 3
#: Slots of the filter: with one byte per slot for up to 8 languages, 2 MB.
SLOTS = 1 << 21
#: Labelled documents per language that the model is fitted on (a Bernoulli draw of this expected size).
SAMPLE_DOCS = 3_000
#: The rate of an n-gram in a language: its sampled documents that have it, in all its sampled documents and PRIOR_DOCS
#: more without it, so that the n-grams of few documents weigh little.
PRIOR_DOCS = 10
#: An n-gram belongs to a language if its rate is at least this ...
MIN_RATE = 0.004
#: ... and at least this part of its rate in the language where it is most common ...
MIN_RELATIVE = 0.2
#: ... and it is among so many of the language's most common ones: the filter's capacity, ties by hash.
NGRAMS_PER_LANGUAGE = 60_000
UNKNOWN = "und"
RESULT = "doc_id long, held_out boolean, lang_pred string, score double, coverage double"
_RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                     ("score", pa.float64()), ("coverage", pa.float64())])
_CHUNK = 1 << 20


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that the model never learns from: crc32 of the id, as text, leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point: its lower-case letter, or a space for everything that is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            low = ch.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


def ngram_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the character n-grams of the text's words, one space between words and at both ends.

    Empty if the text has no letter.
    """
    points = _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    points = np.concatenate(([32], points, [32] * (N - 1))).astype(np.uint64)
    gap = points == 32
    if gap.all():
        return np.empty(0, np.uint64)
    points = points[~(gap & np.concatenate(([False], gap[:-1])))]  # one space for each run of others
    points = np.concatenate((points, np.full(max(0, N - len(points)), 32, np.uint64)))
    with np.errstate(over="ignore"):
        h = points[:len(points) - N + 1].copy()
        for i in range(1, N):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += points[i:len(points) - N + 1 + i]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


@dataclass(frozen=True)
class LanguageFilters:
    """Bit-sliced filter: ``planes`` has a row of slots per 8 languages; ``false_positive`` the rate per language."""

    languages: tuple[str, ...]
    planes: np.ndarray
    false_positive: np.ndarray
    usual: int

    @staticmethod
    def build(languages: list[str], members: list[np.ndarray], usual: int = 0, slots: int = SLOTS) -> LanguageFilters:
        planes = np.zeros(((len(languages) + 7) // 8, slots), np.uint8)
        for i, grams in enumerate(members):
            for at in _slots(grams, slots):
                planes[i // 8, at] |= np.uint8(1 << i % 8)
        fill = np.array([(planes[i // 8] >> (i % 8) & 1).mean() for i in range(len(languages))])
        return LanguageFilters(tuple(languages), planes, fill ** HASHES, usual)

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Number of n-grams that the filter of each language returns."""
        total = np.zeros(8 * len(self.planes))
        for first in range(0, len(grams), _CHUNK):
            at = _slots(grams[first:first + _CHUNK], self.planes.shape[1])
            for p, plane in enumerate(self.planes):
                bits = plane[at[0]] & plane[at[1]] & plane[at[2]]
                total[8 * p:8 * p + 8] += np.bincount(bits, minlength=256) @ _BITS
        return total[:len(self.languages)]

    def decide(self, text: str) -> tuple[str, float, float]:
        """(language, its part of all languages' corrected shares, its corrected share of the n-grams)."""
        grams = ngram_hashes(text)
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0, 0.0
        share = self.counts(grams) / len(grams)
        share = np.clip((share - self.false_positive) / np.maximum(1 - self.false_positive, 1e-9), 0, 1)
        if not share.any():
            return self.languages[self.usual], 0.0, 0.0
        best = int(share.argmax())
        return self.languages[best], float(share[best] / share.sum()), float(share[best])


_BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.float64)


def _slots(grams: np.ndarray, slots: int) -> list[np.ndarray]:
    """``HASHES`` slots per n-gram, by double hashing."""
    step = (grams >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return [((grams + np.uint64(i) * step) & np.uint64(slots - 1)).astype(np.int64) for i in range(HASHES)]


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, min_rate: float = MIN_RATE) -> LanguageFilters:
    """Filters learned from text and non-null lang of the documents that are not held out.

    Document frequencies of n-grams are counted by Spark over a bounded sample per language, and ranked there: at most
    ``NGRAMS_PER_LANGUAGE`` n-grams of a language reach the driver, whatever the length of its texts.  The same rule holds
    for a language of one document and of many.
    """
    labelled = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageFilters.build([], [])
    sample = labelled.sampleBy("lang", {k: min(1.0, sample_docs / n) for k, n in sizes.items()}, seed=11)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                grams.setdefault(lang, []).append(np.unique(ngram_hashes(text.as_py())))
            for lang, sets in grams.items():
                gram, n = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram)), pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64)),
                     pa.array([len(sets) if not i else 0 for i in range(len(gram))], pa.int64())],
                    names=["lang", "gram", "n", "docs"])

    counted = written(sample.mapInArrow(frequencies, "lang string, gram long, n long, docs long"), "language-ngrams")
    drawn = counted.groupBy(F.col("lang").alias("d_lang")).agg(F.sum("docs").alias("drawn"))
    best = Window.partitionBy("lang").orderBy(F.desc("rate"), "gram")
    kept = (counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).join(drawn, F.col("lang") == F.col("d_lang"))
            .withColumn("rate", F.col("n") / (F.col("drawn") + PRIOR_DOCS)).filter(F.col("rate") >= min_rate)
            .withColumn("place", F.row_number().over(best)).filter(F.col("place") <= NGRAMS_PER_LANGUAGE)
            .select("lang", "gram", "rate").toArrow())
    languages = sorted(r["d_lang"] for r in drawn.select("d_lang").collect())
    discard(counted)
    return select(languages, kept["lang"].to_numpy(), kept["gram"].to_numpy().view(np.uint64), kept["rate"].to_numpy(), sizes)


def select(languages: list[str], lang: np.ndarray, gram: np.ndarray, rates: np.ndarray, sizes: dict) -> LanguageFilters:
    """Filters from the rates of (language, n-gram) pairs; ``sizes``: labelled documents per language."""
    values, inverse = np.unique(gram, return_inverse=True)
    top = np.zeros(len(values))
    np.maximum.at(top, inverse, rates)
    strong = rates >= MIN_RELATIVE * top[inverse]
    members = [gram[(lang == k) & strong] for k in languages]
    usual = max(range(len(languages)), key=lambda i: (sizes[languages[i]], -i)) if languages else 0
    return LanguageFilters.build(languages, members, usual)


#: A text is in no learned language if fewer than this share of its n-grams is known to the one named ...
MIN_COVERAGE = 0.2
#: ... and it has at least this many n-grams: of less, nothing can be said.
MIN_NGRAMS = 20


def keep_known(docs: DataFrame, filters: LanguageFilters, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text has a letter and is in a learned language.

    If no n-gram of any language was learned, nothing can be said of languages: every text with a letter stays.
    """
    learned = bool(filters.planes.any())
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    @F.arrow_udf("boolean")
    def known(texts: pa.Array) -> pa.Array:
        model, out = sent.value, []
        for t in texts:
            if not learned:
                out.append(len(ngram_hashes(t.as_py())) > 0)
                continue
            lang, _, coverage = model.decide(t.as_py())
            out.append(lang != UNKNOWN and (coverage >= min_coverage or len(ngram_hashes(t.as_py())) < MIN_NGRAMS))
        return pa.array(out, pa.bool_())

    return docs.filter(known(text_or_empty()))


def identify(docs: DataFrame, filters: LanguageFilters) -> DataFrame:
    """doc_id, held_out, lang_pred, score, coverage for every row of ``docs`` (doc_id, text; other columns ignored).

    ``lang_pred`` is ``und``, with score 0, where text is null, empty or without a letter (and everywhere if no
    language was learned).  If no n-gram is known, the most frequent learned language is named with score 0; equal
    shares go to the language first in code-point order.  A null doc_id is not held out.  Repeated rows get equal
    results; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            found = [model.decide(t.as_py()) for t in batch.column(2)]
            langs, scores, covers = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(covers, pa.float64())], schema=_RESULT)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       text_or_empty().alias("text")).mapInArrow(run, RESULT)
