"""Operator 2, packing: best-fit decreasing over a segment tree indexed by remaining capacity.

Documents are tokenized where they are read.  Full windows are cut from overlong documents first; the remainders
wait in a buffer of bounded size, are sorted by length and put into the open window with the least room that holds
them.  Each task packs its own input split, so no text or token is shuffled.  A window's number is the number of the
split, shifted, plus a counter; splits and the order of rows in them are fixed by the input files, so a repeated task
gives the same windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslab.llm.common import giving_back, text_or_empty
from newslab.llm.token_cache import id_encoder

WINDOW = 2048
END_ID = 1
#: Tokens of remainders that a task holds before it packs and releases them (16 MB of ids).
BUFFER_TOKENS = 4_000_000
SPLIT_SHIFT = 40
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


class RoomTree:
    """Open windows by remaining room: a binary segment tree whose nodes count the windows below them."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, window) with the least room of at least ``need``; None if there is none."""
        count, node = self.count, need + self.leaves
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):  # climb until a right sibling has windows
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return room, self.windows[room].pop()


def best_fit_decreasing(lengths, capacity: int) -> tuple[list[int], list[int], int]:
    """Window number and offset for each length (1..capacity), and the number of windows.

    Ties keep the order given.
    """
    tree, used = RoomTree(capacity), 0
    window, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        found = tree.take_tightest(need)
        if found is None:
            found, used = (capacity, used), used + 1
        room, w = found
        window[i], offset[i] = w, capacity - room
        if room > need:
            tree.add(room - need, w)
    return window, offset, used


def pack_documents(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None,
                   window: int = WINDOW, end_id: int = END_ID, buffer_tokens: int = BUFFER_TOKENS) -> DataFrame:
    """Pieces of the documents with their window (``sequence_id``) and place in it (``offset``, gapless from 0).

    ``docs`` has doc_id and text; other columns are ignored.  ``ids`` holds a piece's token ids as little-endian
    unsigned 32-bit integers.  A null or empty text is one piece holding only ``end_id``; equal rows are packed as
    often as they occur; a null doc_id stays null; an empty table gives no rows.  The last windows of a buffer may
    be part-filled; fill them with padding on use.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
                       F.spark_partition_id().alias("split"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = id_encoder(tokenizer_path, ranks_path, pattern), np.array([end_id], "<u4").tobytes()
        held: list[tuple] = []
        held_tokens, next_window = 0, None
        out: list[tuple] = []
        out_bytes = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), _SCHEMA.types)], schema=_SCHEMA)

        def place() -> int:
            where, offsets, n = best_fit_decreasing([h[2] for h in held], window)
            for h, w, o in zip(held, where, offsets):
                out.append((*h, next_window + w, o))
            return n

        for batch in batches:
            doc_ids, splits = batch.column(0).to_pylist(), batch.column(2)
            if next_window is None and batch.num_rows:
                next_window = splits[0].as_py() << SPLIT_SHIFT
            for doc_id, text in zip(doc_ids, batch.column(1)):
                ids = encode(text.as_py()) + end
                n, at = len(ids) // 4, 0
                while n - at >= window:
                    out.append((doc_id, at, window, ids[4 * at:4 * (at + window)], n, next_window, 0))
                    at, next_window, out_bytes = at + window, next_window + 1, out_bytes + 4 * window
                if at < n:
                    held.append((doc_id, at, n - at, ids[4 * at:], n))
                    held_tokens += n - at
                if held_tokens >= buffer_tokens:
                    next_window += place()
                    held, held_tokens, out_bytes = [], 0, out_bytes + 4 * held_tokens
                if out_bytes > 16_000_000:
                    yield from flush()
                    out, out_bytes = [], 0
        if held:
            place()
        yield from flush()
        held, out = [], []
        encode.cache.empty()

    return rows.mapInArrow(giving_back(run), PIECES)
