"""The corpus pipeline against a brute-force version of each stage on that stage's own input."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from newslab.llm import language_id
from newslab.llm.token_cache import load_tokenizer
from tests.conftest import SF001
from tests.llm.conftest import DOCS, documents
from tests.llm.test_documents import HELPERS, WORDS, brute_exact, brute_grams, link_components, waterfill


def stages(spark, docs, tmp_path):
    """(name, input rows, output rows) of every stage, written and read again as the driver does."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF001).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        out.append((name, docs, after))
        docs = after
    return out


def check(done):
    by = {name: (before, after) for name, before, after in done}
    columns = done[0][1].columns
    for name in ("language", "exact_dedup", "near_dedup", "mixing"):
        assert by[name][1].columns == columns
    before, after = by["language"]
    filters = language_id.fit(before)
    covered = {}
    for r in before.select("text").distinct().collect():
        lang, _, coverage = filters.decide(r.text or "")
        grams = len(brute_grams(r.text))
        assert (lang == "und") == (not any(c.isalpha() for c in r.text or ""))
        covered[r.text] = lang != "und" and (coverage >= language_id.MIN_COVERAGE or grams < language_id.MIN_NGRAMS)
    assert Counter((r.doc_id, r.text) for r in after.collect()) == Counter((r.doc_id, r.text) for r in before.collect() if covered[r.text])
    before, after = by["exact_dedup"]
    groups = brute_exact([(r.doc_id, r.text) for r in before.collect()])
    assert Counter(r.doc_id for r in after.collect()) == Counter(min((i for i in g if i is not None), default=None) for g in groups.values())
    before, after = by["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    found = link_components(rows)
    assert Counter(r.doc_id for r in after.collect()) == Counter(i for i, _ in rows if i is None or found[i] == i)
    before, after = by["mixing"]
    sizes, largest, copies = Counter(), Counter(), Counter((r.doc_id, r.text) for r in after.collect())
    for r in before.collect():
        n = len(WORDS.findall(r.text or ""))
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    target, taken = waterfill(sizes), Counter()
    for r in after.collect():
        taken[r.source] += len(WORDS.findall(r.text))
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in sizes)
    assert max(copies.values()) <= 3
    before, after = by["packing"]
    library = load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [(r.doc_id, np.array(library.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")) for r in before.collect()]
    pieces = after.collect()
    whole, held = Counter(), Counter()
    for i, v in ids:
        whole[i] += len(v)
    for p in pieces:
        held[p.doc_id] += p.length
    assert whole == held
    # Every piece is a run of the ids of a document with its doc_id.
    runs = {}
    for i, v in ids:
        runs.setdefault(i, []).append(v)
    for p in pieces:
        assert any(len(v) == p.doc_tokens and zlib.crc32(v[p.start:p.start + p.length].tobytes()) == p.ids_crc32 for v in runs[p.doc_id])
    windows = {}
    for p in pieces:
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in windows.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 2048


def test_stages_on_documents(spark, tmp_path):
    check(stages(spark, spark.read.parquet(f"{SF001}/documents.parquet"), tmp_path))


def test_stages_on_edges(spark, docs, tmp_path):
    """Nulls in every column, repeated ids and rows, ties, empty and very long texts, production thresholds."""
    more = [(7, "another text of the same id as others", "de", "c", 1), (None, "no id but a text of its own", None, None, None),
            (None, "no id but a second text of its own", None, "a", None), (20, "word " * 20_000, "en", "b", 1)]
    every = docs.unionByName(spark.createDataFrame(more, DOCS))
    done = stages(spark, every, tmp_path)
    check(done)
    assert done[-1][2].count() > 10


def test_stages_with_extra_columns(spark, docs, tmp_path):
    extra = docs.withColumns({c: F.lit(c) for c in HELPERS if c != "Sha"}).withColumns({c: F.lit(1) for c in ("key", "n", "kept", "size", "target", "taken", "component_id", "lang_pred")})
    done = stages(spark, extra, tmp_path)
    check(done)
    rows = done[3][2].collect()
    assert rows and all(r[c] == c for r in rows for c in HELPERS if c != "Sha")


def test_empty_table_and_run(spark, empty, tmp_path):
    assert stages(spark, empty, tmp_path)[-1][2].count() == 0
    rows = corpus_pipeline.run(spark, SF001)
    assert rows.count() > 100 and rows.filter(F.col("length") > 2048).count() == 0
    assert documents()
