"""Operator 6, repeated passages by distributed prefix doubling.

A byte goes if a ``LENGTH``-byte string over it also starts in a document with a smaller doc_id.  Suffix positions get
ranks for growing prefix lengths; a rank is the content hash of its prefix, made from the pair of ranks at half the
length (8 -> 16 -> 32 -> 50), so tasks agree on ranks without a sort of all positions, and positions are dropped as soon
as no other document shares their rank:

1. length 20.  Of every ``LENGTH``-byte string only the position with the smallest rank of its first ``FIRST`` bytes
   counts (a minimizer, chosen by content, so equal strings choose alike).  A rank found in one document only ends
   all strings that chose it.  Tasks send sorted ranks, cut into ``BUCKETS`` by their highest bits; those met twice are shared.
2. the zone: all bytes of the adjacent strings that share a chosen position.  Positions of a shared rank meet, sorted by
   rank.  Zones equal to another document's need no further look: the smallest doc_id of the zone decides for all its strings.
3. length 35, in the same place.  Where one rank has several zones, the first document of each zone stands for it.  Each of
   its strings holds 35 bytes ending or beginning with the chosen position's; a rank of those found in one document only
   ends the strings on that side.
4. length 50.  The strings that are left are ranked one by one.

Disk follows the input, however much of it is shared: rounds 2 and 3 take ``PASSES`` parts of the ranks and round 4 up to
``SLICES`` parts of the strings, one after the other.  A part leaves, per document, the spans found so far (merged) and the
strings still in question.  Positions are packed arrays in numpy, 8 bytes a rank in round 1, a row each in rounds 2 and 3;
equal runs that follow each other (a stretch of blanks) are one row.  Shared ranks are one row each and few beside the
positions, so they are hashed in their partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslab.llm.common import discard, giving_back, text_or_empty, written

#: Bytes of a string that counts as repeated, and of the first rank.
LENGTH, FIRST = 50, 20
_SPAN = LENGTH - FIRST + 1
#: A string holds the chosen FIRST bytes with _SIDE bytes before them, or else with _SIDE bytes after them.
_SIDE = _SPAN // 2
HALF = FIRST + _SIDE
#: Bytes handled at once: a document is cut into segments of this size, overlapping by LENGTH - 1 bytes.
BLOCK = 1 << 17
#: Rounds 2 and 3 handle the ranks in so many parts, one after the other, each with a part of their shuffle.
PASSES = 3
#: Round 4 handles the strings in at most so many parts, of SLICE_SIDES sides or more.
SLICES, SLICE_SIDES = 4, 250_000
#: Ranks of round 1 meet in so many buckets, each gathered by one task.
BUCKETS = 1 << 13
#: Bytes of text whose ranks a task sends at once, and rows that it judges or packs at once.
PORTION, ROWS = 1 << 23, 1 << 18
_PLACE = np.uint64((1 << 20) - 1)
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def pair(a: np.ndarray, b: np.ndarray, second: bool = False) -> np.ndarray:
    """Rank of the concatenation from the ranks of its two parts; ``second``: another, independent one."""
    c, d = _C[2:] if second else _C[:2]
    with np.errstate(over="ignore"):
        x = a * c
        x ^= x >> np.uint64(32)
        x += b
        x *= d
        x ^= x >> np.uint64(29)
    return x


class Block:
    """Ranks of the positions of several segments laid end to end."""

    def __init__(self, segments: list[bytes]):
        self.data = b"".join(segments) + bytes(64)
        n = len(self.data) - 64
        self.eight = np.ndarray((n + 56,), "<u8", self.data, strides=(1,)).copy()
        self.sixteen = pair(self.eight[:n + 40], self.eight[8:n + 48])
        ends = np.cumsum([len(s) for s in segments])
        #: Starts of whole strings: all positions but the last LENGTH - 1 of each segment.
        ok = np.ones(n, bool)
        for end, s in zip(ends, segments):
            ok[end - min(len(s), LENGTH - 1):end] = False
        self.starts = np.flatnonzero(ok)
        self.segment_of = lambda at: np.searchsorted(ends, at, side="right")
        self.begins = ends - [len(s) for s in segments]

    def chosen(self) -> tuple[np.ndarray, ...]:
        """(rank, first start, number of starts, place) for each run of adjacent strings that choose the same position.

        ``place`` is the chosen position's distance from the first start.
        """
        starts, n = self.starts, len(self.data) - 64
        if not len(starts):
            return np.empty(0, np.uint64), starts, starts, starts
        rank = pair(self.sixteen[:n], self.eight[12:n + 12])
        least = (rank & ~_PLACE) | np.arange(n, dtype=np.uint64)  # ties: the leftmost position
        width = 1
        while width < _SPAN:
            step = min(width, _SPAN - width)
            least = np.minimum(least[:len(least) - step], least[step:])
            width += step
        place = (least[starts] & _PLACE).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1))))
        return rank[place[new]], starts[new], np.diff(np.append(new, len(starts))), place[new] - starts[new]

    def whole(self, at: np.ndarray) -> np.ndarray:
        """Rank of the LENGTH bytes at ``at``."""
        s = self.sixteen
        return pair(pair(s[at], s[at + 16]), pair(s[at + 18], s[at + 34]))

    def half(self, at: np.ndarray) -> np.ndarray:
        """Rank of the HALF bytes at ``at``."""
        s = self.sixteen
        return pair(pair(s[at], s[at + 16]), self.eight[at + HALF - 8])

    def halves(self, chosen: np.ndarray) -> np.ndarray:
        """32 bits each of the ranks of the HALF bytes that end, and that begin, with the chosen position's."""
        left = self.half(np.maximum(chosen - _SIDE, 0))
        return left & ~np.uint64((1 << 32) - 1) | self.half(chosen) >> np.uint64(32)

    def zones(self, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Rank of the bytes from each run's first string to the end of its last one."""
        return pair(pair(self.whole(first), self.whole(first + count - 1)), count.astype(np.uint64))


def blocks(texts: Iterator[bytes]) -> Iterator[tuple[list[int], list[int], Block]]:
    """(index of the text, offset in the text) per segment, and the block, for texts in order."""
    index, offset, parts, size = [], [], [], 0
    for i, data in enumerate(texts):
        at = 0
        while len(data) - at >= LENGTH:
            part = data[at:at + BLOCK]
            index.append(i)
            offset.append(at)
            parts.append(part)
            size += len(part)
            at += len(part) - (LENGTH - 1)
            if size >= BLOCK // 2:
                yield index, offset, Block(parts)
                index, offset, parts, size = [], [], [], 0
    if parts:
        yield index, offset, Block(parts)


def heads_of(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new key begins in rows in which equal keys are adjacent."""
    if not len(sorted_keys[0]):
        return np.empty(0, np.int64)
    new = np.zeros(len(sorted_keys[0]) - 1, bool)
    for k in sorted_keys:
        new |= k[1:] != k[:-1]
    return np.flatnonzero(np.concatenate(([True], new)))


def runs_of(texts: list[bytes], zones: bool = True, part: int = 0, parts: int = 1) -> tuple[np.ndarray, ...]:
    """(text index, rank, zone, start in the text, number of strings, place, halves, times) of every run in ``texts`` whose rank is in ``part``.

    ``halves`` has 32 bits of the left and of the right side's rank of length HALF.  Equal runs of which each begins where
    the one before ends are one, ``times`` over.  Without ``zones``, zone and halves are the rank.
    """
    out = []
    for index, offset, block in blocks(iter(texts)):
        rank, first, count, place = block.chosen()
        mine = np.flatnonzero(rank % np.uint64(parts) == part)
        rank, first, count, place = rank[mine], first[mine], count[mine], place[mine]
        seg = block.segment_of(first)
        zone = block.zones(first, count) if zones else rank
        halves = block.halves(first + place) if zones else rank
        head = heads_of(seg, rank, zone, count, place, first - np.cumsum(count) + count)
        times = np.diff(np.append(head, len(rank)))
        seg, rank, zone, first, count, place, halves = (c[head] for c in (seg, rank, zone, first, count, place, halves))
        out.append((np.array(index)[seg], rank, zone, first - block.begins[seg] + np.array(offset)[seg], count, place, halves, times))
    kinds = (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64, np.uint64, np.int64)
    return tuple(np.concatenate(c) for c in zip(*out)) if out else tuple(np.empty(0, k) for k in kinds)


def _least(values: np.ndarray, heads: np.ndarray, most: bool = False) -> np.ndarray:
    return (np.maximum if most else np.minimum).reduceat(values, heads) if len(heads) else values[:0]


def _bytes_of(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """doc_id, text_hash and text of the batch's rows, about PORTION bytes of text at a time."""
    ids, sums, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _bytes_of(batch, 2)
    size, lo = 0, 0
    for hi, text in enumerate(texts, 1):
        size += len(text)
        if size >= PORTION or hi == len(texts):
            yield ids[lo:hi], sums[lo:hi], texts[lo:hi]
            size, lo = 0, hi


_HIGH = np.uint64(64 - (BUCKETS - 1).bit_length())


def _cut(ranks: np.ndarray) -> pa.Array:
    """Sorted ranks as one binary value per bucket."""
    ends = np.searchsorted(ranks >> _HIGH, np.arange(BUCKETS + 1, dtype=np.uint64)).astype(np.int32) * np.int32(8)
    return pa.Array.from_buffers(pa.binary(), BUCKETS, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(ranks))])


def _first_ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per portion and bucket: the ranks of length FIRST found in one document of the portion, and those found in several."""
    for batch in batches:
        for ids, _, texts in _portions(batch):
            index, rank, *_ = runs_of(texts, False)
            order = np.argsort(rank)
            rank, doc = rank[order], ids[index[order]]
            head = heads_of(rank)
            several = _least(doc, head) != _least(doc, head, True)
            once, more = _cut(rank[head][~several]), _cut(rank[head][several])
            out = pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS, dtype=np.int32)), once, more], names=["bucket", "once", "several"])
            if len(rank):
                yield out.filter(pc.greater(pc.add(pc.binary_length(once), pc.binary_length(more)), 0))


def _ranks_in(column: pa.Array, lo: int, hi: int) -> np.ndarray:
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset + lo:column.offset + hi + 1]
    return np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]].view(np.uint64) if ends[-1] > ends[0] else np.empty(0, np.uint64)


def _shared_ranks(parts: int):
    """From rows sorted by bucket: the ranks that came from several documents, or from two portions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shared(found: list[np.ndarray]) -> np.ndarray:
            ranks = np.sort(np.concatenate(found))
            ranks = ranks[1:][ranks[1:] == ranks[:-1]]
            return ranks[heads_of(ranks)]

        current, found = None, []
        for batch in batches:
            bucket, done = batch.column(0).to_numpy(), [np.empty(0, np.uint64)]
            heads = heads_of(bucket)
            for lo, hi in zip(heads, np.append(heads[1:], len(bucket))):
                if bucket[lo] != current and found:
                    done.append(shared(found))
                    found = []
                current = bucket[lo]
                several = _ranks_in(batch.column(2), lo, hi).copy()  # not a view: the batch goes
                found += [_ranks_in(batch.column(1), lo, hi).copy(), several, several]
            yield rows(np.concatenate(done))
        if found:
            yield rows(shared(found))

    def rows(ranks: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ranks.view(np.int64)), pa.array((ranks % np.uint64(parts)).astype(np.int32))], names=["rank", "part"])
    return run


RUNS = "rank long, zone long, halves long, doc_id long, text_hash int, at long, times int"


def _all_runs(part: int, parts: int):
    """Every run: rank, zone, halves, document, its place packed as start * 4096 + strings * 64 + place, and how often it comes in a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sums, texts in _portions(batch):
                index, rank, zone, start, count, place, halves, times = runs_of(texts, True, part, parts)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c.view(np.int64)) for c in (rank, zone, halves)), pa.array(ids[index]), pa.array(sums[index]),
                     pa.array(start << 12 | count << 6 | place), pa.array(times.astype(np.int32))],
                    names=["rank", "zone", "halves", "doc_id", "text_hash", "at", "times"])
    return run


def _together(batches: Iterator[pa.RecordBatch], by: int | None = None) -> Iterator[list[np.ndarray]]:
    """Columns of about ROWS rows at a time; rows with the same value in column ``by``, if adjacent, stay together."""
    held: list[list[np.ndarray]] = []
    enough = ROWS
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if sum(len(h[0]) for h in held) < enough:
            continue
        cols = [np.concatenate(c) for c in zip(*held)]
        cut = len(cols[0]) if by is None else heads_of(cols[by])[-1]
        if cut:
            yield [c[:cut] for c in cols]
        held = [[c[cut:].copy() for c in cols]]
        enough = max(ROWS, 2 * len(held[0][0]))  # a value of many rows is not put together again for each batch
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


FOUND = "doc_id long, text_hash int, repeated boolean, at long, n long"


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rounds 2 and 3 for runs sorted by rank: strings from ``at`` that are repeated, or sides still in question.

    ``at`` is a start, or for a side start * 4096 + strings * 64 + distance of the half's first byte.
    """
    for rank, zone, halves, doc, sums, at, times in _together(batches, 0):
        order = np.lexsort((zone, rank))
        rank, zone, halves, doc, sums, at, times = (c[order] for c in (rank, zone, halves, doc, sums, at, times))
        group = heads_of(rank)
        last = np.append(group[1:], len(rank)) - 1
        size = last - group + 1
        several = np.repeat(zone[group] != zone[last], size)
        same = heads_of(rank, zone)
        repeated = doc > np.repeat(_least(doc, same), np.diff(np.append(same, len(rank))))
        start, count, place = at >> 12, at >> 6 & 63, at & 63

        # Zones' first documents: their strings may still start in a smaller document, in another zone.
        mine = np.flatnonzero(~repeated & several)
        left = np.clip(place - _SIDE + 1, 0, count)[mine]  # strings with _SIDE bytes or more before the chosen ones
        of = np.concatenate((mine, mine))
        n = np.concatenate((left, count[mine] - left))
        begin = np.concatenate((start[mine], start[mine] + left))
        half_at = np.concatenate(((start + place)[mine] - _SIDE, (start + place)[mine]))
        low32 = np.uint64((1 << 32) - 1)
        half = np.concatenate((halves.view(np.uint64)[mine] >> np.uint64(32), halves.view(np.uint64)[mine] & low32 | np.uint64(1 << 32)))
        key = np.repeat(np.arange(len(group), dtype=np.uint64), size)[of] << np.uint64(33) | half
        full = np.flatnonzero(n > 0)
        full = full[np.argsort(key[full])]
        same = heads_of(key[full])
        sizes = np.diff(np.append(same, len(full)))
        docs = doc[of[full]]
        full = full[np.repeat(_least(docs, same) < _least(docs, same, True), sizes)]
        # Equal runs in a row are taken apart again.
        copies = times[of[full]].astype(np.int64)
        full, nth = np.repeat(full, copies), np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        open_, packed = of[full], (begin[full] + nth * count[of[full]]) << 12 | n[full] << 6 | (half_at - begin)[full]

        gone = np.flatnonzero(repeated)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in ((doc[gone], doc[open_]), (sums[gone], sums[open_]),
             (np.ones(len(gone), bool), np.zeros(len(open_), bool)), (start[gone], packed),
             (count[gone] * times[gone], np.zeros(len(open_), np.int64)))], names=["doc_id", "text_hash", "repeated", "at", "n"])


PACKED = "doc_id long, text_hash int, spans array<struct<start:long,end:long>>, sides array<long>"


def merged(start: np.ndarray, end: np.ndarray, key: np.ndarray | int = 0) -> tuple[np.ndarray, ...]:
    """Index of the first row, start and end of the unions of a key's spans that overlap or touch; rows sorted by key and start."""
    shift = key * (end.max(initial=0) + 1)  # the keys one after the other on one line
    reach = np.maximum.accumulate(end + shift)
    head = np.flatnonzero(np.concatenate((np.ones(min(len(start), 1), bool), (start + shift)[1:] > reach[:-1])))
    return head, start[head], (reach - shift)[np.append(head[1:], len(start)) - 1] if len(start) else end


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document of the rows at hand: the merged spans of its repeated strings and its sides in question."""
    for doc, sums, repeated, at, n in _together(batches):
        order = np.lexsort((at, ~repeated, sums, doc))
        doc, sums, repeated, at, n = (c[order] for c in (doc, sums, repeated, at, n))
        new = heads_of(doc, sums)
        which = np.cumsum(np.bincount(new, minlength=len(doc))) - 1
        gone, side = np.flatnonzero(repeated), np.flatnonzero(~repeated)
        head, start, end = merged(at[gone], at[gone] + n[gone] + (LENGTH - 1), which[gone])
        side = side[heads_of(which[side], at[side])]
        lists = lambda owner, values: pa.ListArray.from_arrays(
            pa.array(np.searchsorted(owner, np.arange(len(new) + 1)).astype(np.int32)), values)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[new]), pa.array(sums[new]),
             lists(which[gone][head], pa.StructArray.from_arrays([pa.array(start), pa.array(end)], names=["start", "end"])),
             lists(which[side], pa.array(at[side]))], names=["doc_id", "text_hash", "spans", "sides"])


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the sides asked for: rank of length HALF, first start, and the ranks of the side's strings."""
    names = ["half", "doc_id", "text_hash", "start", "strings"]
    for batch in batches:
        ids, sums, texts, lists = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _bytes_of(batch, 2), batch.column(3)
        bounds, at = lists.offsets.to_numpy(), lists.values.to_numpy()
        first_doc = 0
        while first_doc < len(texts):
            end_doc, size = first_doc, 0
            while end_doc < len(texts) and size < BLOCK:
                size += len(texts[end_doc])
                end_doc += 1
            block = Block(texts[first_doc:end_doc])
            doc = np.repeat(np.arange(first_doc, end_doc), np.diff(bounds[first_doc:end_doc + 1]))
            asked = at[bounds[first_doc]:bounds[end_doc]]
            start, n = asked >> 12, asked >> 6 & 63
            begin = block.begins[doc - first_doc] + start
            offsets = np.concatenate(([0], np.cumsum(n)))
            inside = np.arange(offsets[-1]) - np.repeat(offsets[:-1], n)
            strings = block.whole(np.repeat(begin, n) + inside)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.half(begin + (asked & 63)).view(np.int64)), pa.array(ids[doc]), pa.array(sums[doc]), pa.array(start),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(strings.view(np.int64)))], names=names)
            first_doc = end_doc


def _per_document(packed: list[DataFrame], column: str) -> DataFrame:
    """(r_id, r_hash, ``column``): the lists of several packed tables, put together."""
    rows = reduce(DataFrame.unionByName, (t.select(F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash"), column) for t in packed))
    return rows.filter(F.size(column) > 0).groupBy("r_id", "r_hash").agg(F.flatten(F.collect_list(column)).alias(column))


def repeated_spans(docs: DataFrame) -> list[DataFrame]:
    """Tables (doc_id, text_hash, spans) made by ``written``: bytes under strings that also start in a smaller doc_id.

    ``docs`` has doc_id (not null), text_hash and text.  A document may come in several rows.
    """
    shared = written(docs.mapInArrow(giving_back(_first_ranks), "bucket int, once binary, several binary").repartition("bucket")
                     .sortWithinPartitions("bucket").mapInArrow(giving_back(_shared_ranks(PASSES)), "rank long, part int"), "repeats-ranks")
    parts = []
    for part in range(PASSES):
        # repartition() keeps a rank's runs in one task: adaptive execution doesn't split what it deals out.
        runs = (docs.mapInArrow(giving_back(_all_runs(part, PASSES)), RUNS).repartition("rank")
                .join(shared.filter(F.col("part") == part).select("rank").hint("shuffle_hash"), "rank", "left_semi")
                .sortWithinPartitions("rank"))
        parts.append(written(runs.mapInArrow(giving_back(_judged), FOUND).repartition("doc_id", "text_hash").mapInArrow(giving_back(_packed), PACKED), "repeats-runs"))
    discard(shared)

    asked = _per_document(parts, "sides").hint("shuffle_hash")
    open_ = written(docs.join(asked, (F.col("doc_id") == F.col("r_id")) & (F.col("text_hash") == F.col("r_hash")))
                    .select("doc_id", "text_hash", "text", "sides")
                    .mapInArrow(giving_back(_sides), "half long, doc_id long, text_hash int, start long, strings array<long>"), "repeats-open")
    slices = min(SLICES, 1 + open_.count() // SLICE_SIDES)
    for part in range(slices):
        strings = (open_.filter(F.pmod("half", F.lit(slices)) == part)
                   .select("half", "doc_id", "text_hash", "start", F.posexplode("strings").alias("i", "string"))
                   .select("half", "string", "doc_id", "text_hash", (F.col("start") + F.col("i")).alias("start")))
        lowest = (strings.groupBy(F.col("half").alias("l_half"), F.col("string").alias("l_string"))
                  .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").drop("high"))
        single = (strings.join(lowest.hint("shuffle_hash"), (F.col("half") == F.col("l_half")) & (F.col("string") == F.col("l_string")) & (F.col("doc_id") > F.col("low")))
                  .select("doc_id", "text_hash", F.lit(True).alias("repeated"), F.col("start").alias("at"), F.lit(1).cast("long").alias("n")))
        parts.append(written(single.repartition("doc_id", "text_hash").mapInArrow(giving_back(_packed), PACKED), "repeats-single"))
    discard(open_)
    return parts


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns ignored): doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the
    UTF-8 bytes that are left, and the removed ``spans`` as [start, end) in bytes.

    Strings are judged on the input.  A null text counts as empty; texts under ``LENGTH`` bytes lose nothing; rows
    that share a doc_id never cause each other's bytes to go; a row with a null doc_id keeps all its bytes and causes
    none to go; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.select("doc_id", F.hash("text").alias("text_hash"), "text")
    parts = repeated_spans(rows.filter("doc_id is not null"))
    found = written(_per_document(parts, "spans"), "repeats-spans")
    discard(*parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, found in zip(_bytes_of(batch, 1), batch.column(2)):
                spans = []
                if found.is_valid:
                    start, end = (found.values.field(i).to_numpy() for i in range(2))
                    order = np.argsort(start)
                    _, start, end = merged(start[order], end[order])
                    spans = list(zip(start.tolist(), end.tolist()))
                kept, at = hashlib.sha256(), 0
                for b, e in spans:
                    kept.update(data[at:b])
                    at = e
                kept.update(data[at:])
                out.append((len(data), sum(e - b for b, e in spans), len(spans), kept.hexdigest(),
                            [{"start": b, "end": e} for b, e in spans]))
            cols = list(zip(*out)) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return (rows.join(found, (F.col("doc_id") == F.col("r_id")) & (F.col("text_hash") == F.col("r_hash")), "left")
            .select("doc_id", "text", "spans").mapInArrow(run, RESULT))
