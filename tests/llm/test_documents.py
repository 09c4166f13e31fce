"""Operators 4 to 10: brute force, held-out accuracy and defined results for edge cases."""

import hashlib
import pathlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newslab.llm import exact_dedup, jaccard_join, language_id, mixing, quality_crf, repeats, url_filter
from newslab.llm.components import components
from newslab.llm.queries import ORACLE, QUERIES
from tests.conftest import SF001, SF01
from tests.llm.conftest import BASE, DOCS, documents
from tests.oracle_check import duck, rows_of

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text):
    w = WORDS.findall(lower(text))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def link_components(rows):
    """doc_id -> smallest doc_id reachable, comparing all pairs."""
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    top = {i: i for i, _ in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            common = len(a & b)
            if common and 100 * common >= 75 * len(a | b):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return {i: find(i) for i in top}


def check_links(df, rows):
    got = df.collect()
    exp = link_components(rows)
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((i, len(shingle_set(t))) for i, t in rows)
    assert all(r.component_id == (None if r.doc_id is None else exp[r.doc_id]) for r in got)


def random_texts(seed, n, words=40, sizes=(0, 30)):
    """Families of texts with edits, so that many pairs lie near the threshold."""
    rng, out = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(words)]
    while len(out) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.randint(*sizes))]
        for _ in range(rng.randint(1, 6)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randint(0, len(text))
                text[at:at + rng.choice([0, 1])] = [rng.choice(vocabulary)] * rng.choice([0, 1])
            out.append((len(out), " ".join(text)))
    return out[:n]


def test_links_on_edges(docs, clashing, empty):
    check_links(jaccard_join.link_documents(clashing), [(r[0], r[1]) for r in documents()])
    assert jaccard_join.link_documents(empty).count() == 0


@pytest.mark.parametrize("case", ["light", "large", "hub"])
def test_links_equal_all_pairs(spark, case):
    rows = {"light": lambda: random_texts(1, 160, 6, (1, 14)), "large": lambda: random_texts(2, 200, 40, (5, 60)),
            "hub": lambda: [(i, " ".join(f"h{k}" for k in range(40)) + f" own{i % 7} " + " ".join(f"x{i % 25}y{k}" for k in range(i % 50)))
                            for i in range(150)]}[case]()
    split_list, jaccard_join.SPLIT_LIST = jaccard_join.SPLIT_LIST, 3
    salt, jaccard_join.SALT_ROWS = jaccard_join.SALT_ROWS, 10
    try:
        check_links(jaccard_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)), rows)
    finally:
        jaccard_join.SPLIT_LIST, jaccard_join.SALT_ROWS = split_list, salt


def test_every_boundary_finds_all_links(spark, monkeypatch):
    rows = random_texts(5, 120, 5, (1, 13))
    for boundary in (0, 4, 9):
        monkeypatch.setattr(jaccard_join, "choose_boundary", lambda sizes: boundary)
        check_links(jaccard_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_prefix_and_subset_sizes_are_enough():
    for s in range(1, 60):
        for t in range(s, 60):
            c = jaccard_join.needed(s, t)
            assert jaccard_join.similar(c, s, t) and not jaccard_join.similar(c - 1, s, t)
            if c <= s:
                assert jaccard_join.prefix_length(s) >= s - c + 1 and jaccard_join.prefix_length(t) >= t - c + 1
                if t <= 20:
                    assert c in jaccard_join.subset_sizes(s, 20) and c in jaccard_join.subset_sizes(t, 20)


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)]
    top = {}
    for a, b in links:
        top.setdefault(a, a), top.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(top[a], top[b])
            changed |= top[a] != low or top[b] != low
            top[a] = top[b] = low
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: v for k, v in top.items() if any(a != b and k in (a, b) for a, b in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ 5


def test_url_filter_as_of(spark):
    entries = spark.createDataFrame(
        [("l", "Bad.com", "2024-01-10", "add"), ("l", "bad.com", "2024-01-20", "remove"), ("l", "bad.com", "2024-02-01", "add"),
         ("l", "bad.com", "2024-02-01", "remove"), ("m", "sub.bad.com", "2024-01-01", "add"), ("m", "sub.bad.com", "2024-01-01", "add"),
         ("m", None, "2024-01-01", "add"), ("m", "x.org", None, "add"), ("m", "com", "2024-01-01", "add"), ("m", "x.org", "2024-01-01", "note")],
        "list_name string, domain string, entry_date string, action string")
    rows = [("http://BAD.com/a", "2024-01-09", 0, None), ("http://bad.com/a", "2024-01-10", 1, "l"), ("http://bad.com:80/", "2024-01-19", 1, "l"),
            ("http://bad.com", "2024-01-20", 0, None), ("https://u@sub.bad.com./q", "2024-01-15", 2, "l"), ("http://sub.bad.com", "2024-01-25", 1, "m"),
            ("http://notbad.com", "2024-01-15", 0, None), ("http://bad.com", "2024-05-05", 1, "l"), (None, "2024-01-15", 0, None),
            ("ftp://bad.com", "2024-01-15", 0, None), ("http://bad.com", None, 0, None), ("http://x.org", "2024-03-01", 0, None), ("http://com/", "2024-01-15", 1, "m")]
    captures = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)] * 2,
                                     "page_id long, url string, fetch_date string, n long, f string").withColumn("host", F.lit("x")).withColumn("blocked", F.lit(7))
    got = url_filter.filter_captures(captures, entries).collect()
    assert len(got) == 2 * len(rows)
    for r in got:
        assert (r.n_lists, r.first_list, r.blocked) == (r.n, r.f, r.n > 0), r
    assert url_filter.filter_captures(captures.limit(0), entries).count() == 0
    assert url_filter.filter_captures(captures, entries.limit(0)).filter("blocked").count() == 0


# ------------------------------------------------------------------ 6


def brute_repeats(rows, length=repeats.LENGTH):
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for s in range(len(b) - length + 1):
            if i is not None:
                w = b[s:s + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if i is not None and first[b[s:s + length]] < i:
                gone[s:s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_parts_of_runs_are_all_runs():
    texts = [t.encode() for _, t, *_ in documents() if t] + [bytes(range(256)) * 3]
    whole = Counter(zip(*(c.tolist() for c in repeats.runs_of(texts))))
    parts = [Counter(zip(*(c.tolist() for c in repeats.runs_of(texts, True, k, 3)))) for k in range(3)]
    assert sum(whole.values()) > 3 and sum(parts, Counter()) == whole
    assert all(run[1] % 3 == k for k, part in enumerate(parts) for run in part)


def test_positions_are_hashed_not_sorted_against_shared_ranks(spark, monkeypatch):
    plans, write = [], repeats.written
    monkeypatch.setattr(repeats, "written", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or write(df, name))
    text = "a passage of more than fifty bytes that two documents share, word for word"
    repeats.remove_repeats(spark.createDataFrame([(1, text), (2, "x " + text)], "doc_id long, text string")).collect()
    named = [(n, p) for n, p in plans if n in ("repeats-runs", "repeats-open", "repeats-single")]
    assert len(named) == repeats.PASSES + 2 and all("ShuffledHashJoin" in p and "SortMergeJoin" not in p for _, p in named)


def check_repeats(df, rows):
    got = repeats.remove_repeats(df).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(rows)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)


def test_repeats_on_edges(docs, clashing, empty):
    check_repeats(clashing, [(r[0], r[1]) for r in documents()])
    assert repeats.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("block", [repeats.BLOCK, 200])
def test_repeats_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(repeats, "BLOCK", block)
    rng = random.Random(9)
    word = lambda: rng.choice(["ab", "abc", "äö", "x", "longer", "word", "aaaa"])
    passages = [" ".join(word() for _ in range(rng.randint(8, 60))) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = [rng.choice(passages)[rng.choice([0, 0, 3]):rng.choice([None, None, -2, 60])] if rng.random() < 0.6 else
                 " ".join(word() for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(0, 4))]
        rows.append((i, rng.choice([" ", "", "\n"]).join(parts)))
    rows += [(200, "z" * 400), (201, "z" * 120), (202, "z" * 49), (203, "zy" * 80), (203, "zy" * 70), (204, "yz" * 60)]
    check_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows)


def test_stretches_equal_brute_force(spark):
    rng = random.Random(4)
    piece = lambda: rng.choice(["z", "y", "zy", "xyz"]) * rng.randint(1, 120) + rng.choice(["", "end", "abc def"])
    rows = [(rng.randint(0, 40), "".join(piece() for _ in range(rng.randint(0, 4)))) for _ in range(60)]
    check_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_equal_runs_in_a_row_are_one():
    blanks = b" " * 100_000
    _, _, _, start, count, _, _, times = repeats.runs_of([b"x" + blanks + b"y"])
    assert len(start) < 200 and (count * times).sum() == len(blanks) + 2 - (repeats.LENGTH - 1)


def test_disk_is_bounded_when_all_text_is_shared(spark, monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefghij klmnop", k=20_000)) for _ in range(60)]
    live, most, write, drop = {}, [0], repeats.written, repeats.discard

    def written(df, name):
        out = write(df, name)
        live[out.scratch] = sum(p.stat().st_size for p in pathlib.Path(out.scratch.removeprefix("file:")).rglob("*.parquet"))
        most[0] = max(most[0], sum(live.values()))
        return out

    monkeypatch.setattr(repeats, "written", written)
    monkeypatch.setattr(repeats, "discard", lambda *tables: [live.pop(t.scratch) for t in tables] and drop(*tables))
    rows = [(i, t) for i, t in enumerate(texts * 2)]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: 20_000 * (i >= 60) for i, _ in rows}
    assert 0 < most[0] < 0.5 * sum(len(t) for _, t in rows)


def test_ranks_met_twice_are_shared(monkeypatch):
    monkeypatch.setattr(repeats, "PORTION", 300)
    rng = random.Random(6)
    passages = ["".join(rng.choices("abcdef ", k=rng.randint(50, 150))) for _ in range(20)]
    rows = [(i, 0, "".join(rng.choices(passages, k=rng.randint(1, 3)))) for i in range(30)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("doc_id", "text_hash", "text"), r)) for r in rows[k:k + 7]]) for k in range(0, 30, 7)]
    sent = pa.Table.from_batches(repeats._first_ranks(iter(batches))).sort_by("bucket").combine_chunks()
    got = pa.Table.from_batches(repeats._shared_ranks(3)(sent.to_batches(max_chunksize=11)))
    docs = defaultdict(set)
    for i, _, text in rows:
        for rank in repeats.runs_of([text.encode()], False)[1].tolist():
            docs[rank].add(i)
    ranks = got["rank"].to_numpy().view("uint64").tolist()
    assert len(ranks) == len(set(ranks)) and set(ranks) == {r for r, d in docs.items() if len(d) > 1}
    assert got["part"].to_pylist() == [r % 3 for r in ranks]


def test_rows_of_a_key_stay_together(monkeypatch):
    monkeypatch.setattr(repeats, "ROWS", 10)
    keys = [k for k, n in enumerate([1, 3, 50, 2, 9, 10, 11, 1]) for _ in range(n)]
    batches = [pa.RecordBatch.from_pydict({"key": keys[i:i + 4], "row": list(range(i, min(i + 4, len(keys))))}) for i in range(0, len(keys), 4)]
    parts = list(repeats._together(iter(batches), 0))
    assert [x for p in parts for x in p[1].tolist()] == list(range(len(keys))) and len(parts) > 3
    assert all(a[0][-1] != b[0][0] for a, b in zip(parts, parts[1:]))


# ------------------------------------------------------------------ 7


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return groups


@pytest.mark.parametrize("capacity", [1, 3, exact_dedup.BUCKET_KEYS])
def test_exact_dedup(docs, clashing, empty, capacity):
    groups = brute_exact([(r[0], r[1]) for r in documents()])
    for limit in (0, exact_dedup.BROADCAST_KEYS):
        got = exact_dedup.dedup_exact(clashing, capacity, limit).collect()
        assert len(got) == len(documents())
        by = defaultdict(list)
        for r in got:
            by[r.text_sha256].append(r)
        for text, ids in groups.items():
            found = by[hashlib.sha256(text.encode()).hexdigest()]
            keep = min((i for i in ids if i is not None), default=None)
            assert Counter(r.doc_id for r in found) == Counter(ids)
            assert {(r.keep_id, r.group_size) for r in found} == {(keep, len(ids))}
            assert [r.doc_id for r in found if r.kept] == [keep]
    assert exact_dedup.dedup_exact(empty).count() == 0


def test_keep_first_keeps_whole_rows(docs, monkeypatch):
    groups = brute_exact([(r[0], r[1]) for r in documents()])
    for limit in (0, 100):
        monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", limit)
        got = exact_dedup.keep_first(docs)
        assert got.columns == docs.columns
        assert Counter(r.doc_id for r in got.collect()) == Counter(min((i for i in ids if i is not None), default=None) for ids in groups.values())


def test_colliding_keys_are_told_apart_by_their_bytes(spark, docs, monkeypatch):
    """All texts in one chain, then in two: groups come from comparing texts, not from the hash."""
    groups = brute_exact([(r[0], r[1]) for r in documents()])
    for key in (lambda c: F.lit(7).cast("long"), lambda c: F.xxhash64(F.length(c) % 2)):
        monkeypatch.setattr(exact_dedup, "text_key", key)
        got = exact_dedup.dedup_exact(docs, 3).collect()
        assert Counter((r.text_sha256, r.group_size) for r in got) == Counter(
            (hashlib.sha256(t.encode()).hexdigest(), len(ids)) for t, ids in groups.items() for _ in ids)


def test_groups_come_from_the_owners_buckets(spark, monkeypatch):
    """Without one bucket of the index its groups fall apart and no other does; owners hold ranges of buckets."""
    rows = spark.createDataFrame([(i, f"text {i % 60}") for i in range(180)], "doc_id long, text string").repartition(4)
    whole = {r.doc_id: r.group_size for r in exact_dedup.dedup_exact(rows, 8).collect()}
    assert set(whole.values()) == {3}
    chains, lost = exact_dedup.owned_chains, []

    def without_one(texts, depth, slots):
        found = chains(texts, depth, slots)
        tasks = found.groupBy(F.spark_partition_id().alias("t")).agg(F.min("bucket").alias("low"), F.max("bucket").alias("high")).orderBy("low").collect()
        assert len(tasks) > 1 and all(a.high <= b.low for a, b in zip(tasks, tasks[1:]))
        lost.extend(r.keep_id for r in found.filter("bucket = 2").collect())
        return found.filter("bucket <> 2")

    monkeypatch.setattr(exact_dedup, "owned_chains", without_one)
    got = {r.doc_id: r.group_size for r in exact_dedup.dedup_exact(rows, 8).collect()}
    assert lost and {i for i, n in got.items() if n == 1} == {i for i in range(180) if i % 60 in lost}


#: Every name that the row-keeping functions use beside the caller's columns.
HELPERS = ["g_id", "sha", "_sha", "d_id", "d_sha", "row", "_row", "p_row", "copies", "_copies", "copy", "_copy", "stays", "times", "position",
           "m_host", "m_day", "m_domain", "day", "_day", "domain", "valid_from", "list_name", "host_", "g_id_", "Sha"]


def test_helper_names_of_the_caller_survive(spark, docs):
    extra = docs.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for c in HELPERS if c != "Sha"})
    for fn in (exact_dedup.keep_first, jaccard_join.keep_one, mixing.mixed_rows):
        got = fn(extra)
        assert got.columns == extra.columns, fn.__name__
        assert Counter(got.select(docs.columns).collect()) == Counter(fn(docs).collect()), fn.__name__
        assert all(r[c] == c + ("" if r.doc_id is None else str(r.doc_id)) for r in got.collect() for c in HELPERS if c != "Sha")
    pages = spark.createDataFrame([(1, "http://a.b.c/x", "2024-01-05"), (2, None, None)], "page_id long, url string, fetch_date string")
    more = pages.withColumns({c: F.lit(c) for c in HELPERS if c != "Sha"})
    entries = spark.createDataFrame([("l", "b.c", "2024-01-01", "add")], "list_name string, domain string, entry_date string, action string")
    got = {r.page_id: r for r in url_filter.filter_captures(more, entries).collect()}
    assert got[1].blocked and not got[2].blocked and all(r[c] == c for r in got.values() for c in HELPERS if c != "Sha")


def test_directory_covers_every_key_once(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    depth, slots = exact_dedup.directory(keys, 40)
    found = exact_dedup.with_bucket(keys, "key", depth, slots).groupBy("bucket").count().collect()
    assert len(slots) == 1 << depth and sum(r["count"] for r in found) == 5000
    assert max(r["count"] for r in found) <= 40 and {r["bucket"] for r in found} <= set(slots)


# ------------------------------------------------------------------ 8


def waterfill(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, full, left = {}, set(), float(sum(sizes.values()))
    while True:
        rest = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            full.add(s)
            left -= target[s]


def test_mix_targets_and_limits(docs, clashing, empty):
    plan = mixing.plan_mix(clashing, range_rows=2)
    got = plan.collect()
    assert len(got) == len(documents())
    sizes = Counter()
    for r in documents():
        sizes[r[3]] += len(WORDS.findall(r[1] or ""))
    target = waterfill(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size and r.taken == sum(c.words for c in r.copies)
        assert all(0 <= c.position <= 1 for c in r.copies)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)
    order = [(r.position, r.doc_id if r.doc_id is not None else -1) for r in mixing.schedule(plan).collect()]
    assert order == sorted(order)
    assert sorted(map(str, got)) == sorted(map(str, mixing.plan_mix(docs.repartition(7), range_rows=1000).collect()))
    assert mixing.plan_mix(empty).count() == 0


def test_taken_comes_from_the_schedule(spark, docs, clashing, empty, monkeypatch):
    """Ordinals number the copies in order of position; a range missing from the schedule is missing from what is taken."""
    more = clashing.withColumns({c: F.lit("x") for c in ("m_row", "h_row", "words", "epoch", "ordinal", "s_id", "shift")})
    got = mixing.mix_documents(more).collect()
    key = lambda r: (str(r.doc_id), r["size"], str(r.source), r.taken)
    assert sorted(map(key, got)) == sorted(map(key, mixing.plan_mix(docs).collect()))
    plan = mixing.plan_mix(docs)
    rows = sorted(mixing.schedule(plan).collect())
    assert [r.ordinal for r in rows] == list(range(len(rows))) and [r.position for r in rows] == sorted(r.position for r in rows)
    assert mixing.mix_documents(empty).count() == 0
    whole = mixing.schedule
    monkeypatch.setattr(mixing, "schedule", lambda plan, row: whole(plan, row).filter("position < 0.5"))
    cut = mixing.mix_documents(docs).collect()
    assert sum(r.taken for r in cut) < sum(r.taken for r in got)
    assert all(r.taken == sum(c.words for c in r.copies if c.position < 0.5) for r in cut)


def test_mixed_rows_tell_rows_of_one_id_apart(spark):
    """Different texts with a null or repeated doc_id, one source and one size: each has its own copies."""
    texts = [f"t{i} two three four" for i in range(40)]
    rows = ([(None, t, "en", "a", 1) for t in texts] + [(5, t + " five", "en", "a", 1) for t in texts]
            + [(100 + i, "x " * 30, "en", s, 1) for i, s in enumerate("bbbbc")])
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = [Counter(map(tuple, mixing.mixed_rows(d).collect())) for d in (docs, docs.repartition(5))]
    assert got[0] == got[1]
    exp = Counter(n for r in mixing.plan_mix(docs).collect() if r.source == "a"
                  if (n := sum(2 * c.words >= r["size"] for c in r.copies)))
    assert Counter(n for r, n in got[0].items() if r[3] == "a") == exp and 0 < sum(exp.values()) < 80


def test_many_sources_are_in_no_single_task(spark):
    sizes = {(f"s{i:03}" if i else None): i * 7919 % 101 + i // 350 * 5000 for i in range(400)}
    table = spark.createDataFrame(list(sizes.items()), "source STRING, source_size LONG").repartition(5)
    got = mixing.source_targets(table, range_rows=50)
    target = waterfill(sizes)
    rows = {r.source: r for r in got.collect()}
    assert len(rows) == 400 and all(abs(rows[s].target - target[s]) < 1e-6 for s in sizes)
    assert {s: r.weight for s, r in rows.items()} == {s: i % 3 + 1.0 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    plans = [got, mixing.sums_before(table, [F.col("source")], ["source_size"], 50)]
    assert all("SinglePartition" not in p._jdf.queryExecution().executedPlan().toString() for p in plans)


def test_demand_is_inverted(spark):
    rows = spark.range(11).select((F.col("id") / 10).alias("q"))
    for a, b in mixing.SCHEDULES:
        for r in rows.select("q", mixing.invert_demand(F.col("q"), F.lit(a), F.lit(b)).alias("t")).collect():
            assert abs((a * r.t + (b - a) * r.t ** 2 / 2) / ((a + b) / 2) - r.q) < 1e-9


# ------------------------------------------------------------------ 9


def test_language_held_out_accuracy_and_leakage(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    filters = language_id.fit(docs)
    got = {r.doc_id: r for r in language_id.identify(docs, filters).collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (i in set(held)) for i in lang)
    assert sum(got[i].lang_pred == lang[i] for i in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    swapped = docs.withColumn("lang", F.when(language_id.held_out(), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("z"))
    again = {r.doc_id: r.lang_pred for r in language_id.identify(swapped, language_id.fit(swapped)).collect()}
    assert again == {i: r.lang_pred for i, r in got.items()}


def test_language_edges(spark, docs, clashing, empty):
    filters = language_id.fit(docs, min_rate=0.01)
    got = language_id.identify(clashing, filters).collect()
    assert len(got) == len(documents())
    for r in got:
        text = next((d[1] for d in documents() if d[0] == r.doc_id), None)
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
    assert language_id.identify(empty, filters).count() == 0
    none = language_id.fit(empty)
    assert {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"}
    assert language_id.keep_known(docs, filters).columns == docs.columns


def test_few_or_no_labels_keep_documents(spark):
    """Production thresholds: without a usable label texts with a letter stay, and one labelled document is enough."""
    en = "the quick brown fox jumps over the lazy dog while many other animals look on from the hill number"
    fi = "yksi kaksi kolme nelja viisi kuusi seitseman kahdeksan yhdeksan kymmenen on hyvin pitka lause talosta"
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2][:40]
    rows = [(i, f"{en} {i}", None, "a", 1) for i in ids] + [(900, "12 34", None, "a", 1), (901, None, None, "a", 1)]
    for lang, kept in ((None, ids), ("en", ids)):
        docs = spark.createDataFrame([(i, t, lang if i in ids else None, s, n) for i, t, _, s, n in rows], DOCS)
        assert sorted(r.doc_id for r in language_id.keep_known(docs, language_id.fit(docs)).collect()) == kept
    bare = spark.createDataFrame([(i, f"{en} {i}", None, "a", 1) for i in ids] + [(ids[0], "12 34", "en", "a", 1)], DOCS)
    assert language_id.keep_known(bare, language_id.fit(bare)).count() == len(ids)
    one = spark.createDataFrame([(i, f"{en} {i}", "en", "a", 1) for i in ids[1:]] + [(ids[0], fi, "fi", "a", 1), (900, fi[20:], None, "a", 1)], DOCS)
    filters = language_id.fit(one)
    assert language_id.keep_known(one, filters).count() == len(ids) + 1
    assert {r.doc_id for r in language_id.identify(one, filters).collect() if r.lang_pred == "fi"} == {ids[0], 900}


def brute_grams(text):
    """Character 4-grams as strings: letters lower-cased, one space for every run of others and at both ends."""
    low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
    s = re.sub(" +", " ", f" {low} ").ljust(4)
    return [s[i:i + 4] for i in range(len(s) - 3)] if s.strip() else []


def test_language_equals_plain_sets(spark):
    """Learned and decided with sets of strings, without filters: the same languages, and scores up to false positives."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    got = {r.doc_id: r for r in language_id.identify(docs, language_id.fit(docs)).collect()}
    drawn, holds = Counter(), defaultdict(Counter)
    for i, text, lang in rows:
        if lang is not None and text is not None and zlib.crc32(str(i).encode()) % 4 != 2 and (grams := set(brute_grams(text))):
            drawn[lang] += 1
            holds[lang].update(grams)
    rate = {k: {g: n / (drawn[k] + 10) for g, n in c.items() if n / (drawn[k] + 10) >= 0.004} for k, c in holds.items()}
    top = Counter()
    for r in rate.values():
        for g, x in r.items():
            top[g] = max(top[g], x)
    sets = {k: {g for g, x in r.items() if x >= 0.2 * top[g]} for k, r in rate.items()}
    assert max(map(len, sets.values())) <= language_id.NGRAMS_PER_LANGUAGE
    for i, text, _ in rows:
        grams = brute_grams(text)
        share = {k: sum(g in s for g in grams) / max(len(grams), 1) for k, s in sorted(sets.items())}
        if not grams:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        best = max(share, key=lambda k: share[k])
        second = sorted(share.values())[-2]
        assert got[i].lang_pred == best or share[best] - second < 0.02
        if got[i].lang_pred == best and share[best]:
            assert abs(got[i].coverage - share[best]) < 0.02 and abs(got[i].score - share[best] / sum(share.values())) < 0.02


def test_language_fit_is_bounded_by_its_capacity(spark, monkeypatch):
    monkeypatch.setattr(language_id, "NGRAMS_PER_LANGUAGE", 50)
    rows = [(i, "".join(chr(97 + (i * 7 + k * k) % 26) for k in range(3000)), f"l{i % 12}", "s", 1) for i in range(40)]
    built = []
    build = language_id.LanguageFilters.build
    monkeypatch.setattr(language_id.LanguageFilters, "build", staticmethod(lambda names, members, *a: built.append(list(map(len, members))) or build(names, members, *a)))
    language_id.fit(spark.createDataFrame(rows, DOCS))
    assert built and max(built[0]) <= 50


def test_filters_return_all_languages_of_an_ngram():
    rng = np.random.default_rng(1)
    members = [rng.integers(0, 2 ** 63, 2000).astype(np.uint64) for _ in range(11)]
    members[3] = members[0]
    filters = language_id.LanguageFilters.build([f"l{i:02}" for i in range(11)], members, slots=1 << 16)
    assert filters.counts(members[0])[[0, 3]].tolist() == [2000, 2000]
    stray = rng.integers(0, 2 ** 63, 200_000).astype(np.uint64)
    assert np.allclose(filters.counts(stray) / 200_000, filters.false_positive, atol=0.002)


# ------------------------------------------------------------------ 10


def test_kept_equals_every_labelling_tried(spark):
    """On documents of up to eight lines: the best of all labellings of the lines, weighed out line by line."""
    from itertools import product

    field = quality_crf.fit(*(spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels")))
    texts = [r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect() if r.text and r.text.count("\n") < 8][:150]
    texts += [t or "" for _, t, *_ in documents() if (t or "").count("\n") < 8] + ["$$$ BUY!!! NOW!!!\nA plain line of text follows here.\n### *** ###"] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in quality_crf.apply_rules(df, field).collect()}
    for i, text in enumerate(texts):
        lines = [line for line in text.split("\n") if WORDS.search(line)]
        x = quality_crf.measure(text).features
        assert len(lines) == len(x)
        if not lines:
            assert (got[i].content_share, got[i].kept) == (0.0, False)
            continue

        def weight(states):
            total = float(field.begin[states[0]]) + sum(float(x[k] @ field.emit[s]) for k, s in enumerate(states))
            return total + sum(float(field.move[a, b]) for a, b in zip(states, states[1:]))

        ways = sorted(product((0, 1), repeat=len(lines)), key=weight, reverse=True)
        if len(ways) > 1 and weight(ways[0]) - weight(ways[1]) < 1e-6:
            continue
        chars = [sum(map(len, WORDS.findall(line))) for line in lines]
        share = sum(c for c, s in zip(chars, ways[0]) if s == 0) / sum(chars)
        assert abs(got[i].content_share - share) < 1e-9
        assert got[i].kept == (not brute_measures(text)[5] and share >= quality_crf.MIN_CONTENT)


def brute_measures(text):
    text = text or ""
    words = WORDS.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        dup += bool(WORDS.search(line)) and line in seen
        seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n)


@pytest.mark.parametrize("source", ["edges", "sf0.001"])
def test_quality_measures(spark, clashing, source):
    df = clashing if source == "edges" else spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    got = quality_crf.apply_rules(df, quality_crf.UNTRAINED).collect()
    rows = df.select("doc_id", "text").collect()
    assert (Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
            == Counter((r.doc_id, *brute_measures(r.text)) for r in rows))
    assert not any(r.kept and r.base_failed for r in got)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(4)
    for _ in range(40):
        field = quality_crf.LineField(rng.normal(size=(2, 3)), rng.normal(size=(2, 2)), rng.normal(size=2))
        x = rng.normal(size=(6, 3))
        e = x @ field.emit.T

        def score(path):
            return field.begin[path[0]] + sum(e[t, s] for t, s in enumerate(path)) + sum(field.move[a, b] for a, b in zip(path, path[1:]))

        best = max((tuple(k >> t & 1 for t in range(6)) for k in range(64)), key=score)
        assert tuple(field.viterbi(x)) == best


def test_training_learns_labels_and_content_decides(spark, empty):
    rng = np.random.default_rng(2)
    xs = [np.c_[np.ones(8), rng.normal(k, 0.3, (8, 2))] for k in (0, 1) * 20]
    field = quality_crf.train(xs, [np.full(8, k) for k in (0, 1) * 20], steps=120)
    assert all((field.viterbi(x) == k).all() for x, k in zip(xs, (0, 1) * 20))
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    got = (quality_crf.apply_rules(docs, quality_crf.fit(docs, labels)).join(labels, "doc_id").filter("not base_failed")
           .groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect())
    kept = {r.quality: r.kept for r in got}
    assert kept[1] > 0.97 and kept[0] < 0.1
    assert quality_crf.fit(docs, labels.limit(0)) is quality_crf.UNTRAINED
    assert quality_crf.apply_rules(empty, quality_crf.UNTRAINED).count() == 0


# ------------------------------------------------------------------ queries


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_its_sql(spark, key):
    got = QUERIES[key](spark, SF001).toPandas()
    exp = duck(SF001).execute(ORACLE[key]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert rows_of(got) == rows_of(exp)


def test_queries_without_sql_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    check_links(QUERIES["op4_jaccard_join"](spark, SF001), rows)
    got = QUERIES["op6_repeats"](spark, SF001).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(rows)
