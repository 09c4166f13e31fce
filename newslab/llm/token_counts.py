"""Operator 3, token counts: two-tier lookup on the map side, without any shuffle of words.

Tier one is a broadcast table of the most frequent pieces and their token counts, of fixed size and drawn from a
bounded sample of documents; tier two is a worker's cache, filled by encoding pieces that tier one lacks.  The table
only saves work: counts never depend on it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslab.llm.common import giving_back, text_or_empty
from newslab.llm.token_cache import PieceCache, load_tokenizer, pieces

LIMIT = 2048
#: Entries of the broadcast table: at most 2 MB of text and 32 kB of lengths.
TABLE_ENTRIES = 32_768
PIECE_CHARS = 64
#: Documents read for the table, and the most characters taken of each.
SAMPLE_DOCS, SAMPLE_CHARS = 2_000, 20_000
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                     ("over_limit", pa.bool_())])


def counter(path: str):
    """Exact token count of a string for the file's own library (no added begin or end tokens)."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda s: len(model.encode(s))
    tokenizer = load_tokenizer(path)
    return lambda s: len(tokenizer.encode(s, add_special_tokens=False).ids)


def frequent_pieces(docs: DataFrame, path: str, entries: int = TABLE_ENTRIES, sample_docs: int = SAMPLE_DOCS,
                    sample_chars: int = SAMPLE_CHARS) -> tuple[str, bytes]:
    """The sample's most frequent pieces, joined by spaces, and their token counts, a byte each.

    The sample is a seeded Bernoulli draw of about ``sample_docs`` documents, never more than twice as many.
    """
    n = docs.count()
    texts = (docs.select(F.substring(text_or_empty(), 1, sample_chars).alias("text"))
             .sample(False, min(1.0, sample_docs / max(n, 1)), seed=7).limit(2 * sample_docs))
    seen: Counter = Counter()
    for row in texts.toLocalIterator():
        seen.update(p for p in row.text.split(" ") if p and len(p) <= PIECE_CHARS and len(p.split()) == 1)
    count = counter(path)
    best = sorted(seen, key=lambda p: (-seen[p], p))[:entries]
    best = [(p, n) for p in best if p.strip() == p and (n := count(" " + p)) < 256]
    return " ".join(p for p, _ in best), bytes(n for _, n in best)


@lru_cache(maxsize=4)
def _worker_cache(path: str) -> tuple:
    count = counter(path)
    return count, PieceCache(lambda p: count(" " + p))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, table: tuple[str, bytes] | None = None) -> DataFrame:
    """Bytes and tokens of every whole text of ``docs`` (doc_id, text; other columns are ignored).

    A null text counts as empty, with 0 tokens; repeated rows are counted as often as they occur; an empty table
    gives no rows.  A ``.json`` file must be a word-level or byte-level BPE, whose tokens never cross a space; the
    pieces of a ``.model`` file may, so there whole texts are encoded.
    """
    whole = path.endswith(".model")
    words, lengths = ("", b"") if whole else table if table is not None else frequent_pieces(docs, path)
    sent = docs.sparkSession.sparkContext.broadcast((words, lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, cache = _worker_cache(path)
        first = dict(zip(*(sent.value[0].split(" "), sent.value[1]))) if sent.value[0] else {}
        cache.stock(first)  # both tiers answer from one dictionary: a miss in it is encoded once
        total = lambda head, rest: sum(head) + sum(rest)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in batch.column(1):
                s = text.as_py()
                n_bytes.append(len(s.encode()))
                n_tokens.append(0 if not s else count(s) if whole else pieces(s, cache, count, total))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_())], schema=_SCHEMA)
        cache.empty()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(giving_back(run), COUNTS)
