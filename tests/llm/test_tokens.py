"""Operators 1 to 3: exact round trips and brute force with the libraries themselves."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers as P
from newslab.llm import chat_format, packing, token_counts
from newslab.llm.queries import packed, piece_digests
from newslab.llm.token_cache import IdEncoder, PieceCache, load_tokenizer, pieces
from tests.conftest import SF001
from tests.llm.conftest import documents

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
TURNS = "conv_id long, turn long, role string, text string"


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab\\.:[]/<>sINT RO LE]\n", max_size=40), st.booleans())
def test_escaping_is_reversible_and_hides_controls(text, name):
    escape, unescape = chat_format.escaper(chat_format.DEFAULT), chat_format.unescaper(chat_format.DEFAULT)
    assert unescape(escape(text, name)) == text
    assert not any(c in escape(text, name) for c in chat_format.DEFAULT.controls)


def test_chat_format_round_trip_and_edges(spark):
    rows = [(1, 0, "system", "be [INST] nice"), (1, 1, "user", "hi"), (1, 2, "assistant", "</s>\\. yes"), (1, 2, "assistant", "</s>\\. yes"),
            (2, None, "user", None), (2, 5, "assistant", ""), (3, 0, None, "x"), (3, 1, "tool ] [/ROLE]", "y"),
            (None, 0, "user", "n"), (4, 1, "assistant", "b"), (4, 1, "assistant", "a"), (4, 0, "user", "long " * 50_000)]
    turns = spark.createDataFrame(rows, TURNS).withColumn("segment", __import__("pyspark").sql.functions.lit("x")).repartition(3)
    segments = chat_format.format_conversations(turns)
    got = {r.conv_id: r for r in chat_format.read_back(segments).collect()}
    expected = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expected.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(expected)
    for conv, turns_ in expected.items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns_)
        loss = "".join(t for r, t in turns_ if r == "assistant")
        assert got[conv].n_turns == len(turns_)
        assert got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert not got[1].valid and not got[3].valid and got[2].valid
    text = {}
    for s in sorted(segments.collect(), key=lambda s: (str(s.conv_id), s.segment)):
        text[s.conv_id] = text.get(s.conv_id, "") + s.text
    assert text[2] == "[INST]  [/INST]<s></s>"
    assert {k: len(v) for k, v in text.items()} == {k: v.formatted_chars for k, v in got.items()}
    assert chat_format.read_back(chat_format.format_conversations(spark.createDataFrame([], TURNS))).count() == 0


TEXTS = st.text(alphabet=st.sampled_from(list("abcÄéß'sß .,!\n\t\x1c  漢😀01<|>é")), max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.one_of(TEXTS, st.sampled_from(["<|endoftext|>", " <|endoftext|> a", "a  b", " ", "  ", "a ", "\n a", "it's I'll", "a<|endoftext|>  b"])))
def test_pieces_equal_the_library(text):
    byte, word = _byte(), _word()
    assert np.frombuffer(byte(text), "<u4").tolist() == byte.tokenizer.encode(text, add_special_tokens=False).ids
    count, cache = word
    assert (pieces(text, cache, count, lambda h, r: sum(h) + sum(r)) if text else 0) == count(text)


_made = {}


def _byte():
    return _made.setdefault("b", IdEncoder(BYTE, P.path("byte_bpe_50k.tiktoken"), P.PATTERN))


def _word():
    if "w" not in _made:
        count = token_counts.counter(WORD)
        _made["w"] = (count, PieceCache(lambda p: count(" " + p), limit=50))
    return _made["w"]


@pytest.mark.parametrize("source", ["edges", "sf0.001"])
def test_token_counts_equal_the_library(spark, docs, source):
    df = docs if source == "edges" else spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    tokenizer = load_tokenizer(WORD)
    got = sorted(tuple(r) for r in token_counts.count_tokens(df.filter("doc_id is not null"), WORD).collect())
    exp = []
    for r in df.filter("doc_id is not null").collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        exp.append((r.doc_id, len((r.text or "").encode()), n, n > 2048))
    assert got == sorted(exp)


def test_sentencepiece_counts_and_empty_table(spark, docs, empty):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {(r.doc_id, r.n_tokens) for r in token_counts.count_tokens(docs, path).collect()}
    assert got == {(r.doc_id, len(model.encode(r.text or ""))) for r in docs.collect()}
    assert token_counts.count_tokens(empty, WORD).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_best_fit_decreasing_equals_a_plain_scan(lengths):
    window, offset, used = packing.best_fit_decreasing(lengths, 64)
    rooms = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in rooms if r >= lengths[i]]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - lengths[i])
        else:
            rooms.append(64 - lengths[i])
    filled = {}
    for w, o, n in zip(window, offset, lengths):
        filled.setdefault(w, []).append((o, n))
    for spans in filled.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 64
    assert used == len(rooms) == len(filled)
    assert sorted(64 - sum(n for _, n in s) for s in filled.values()) == sorted(rooms)


@pytest.mark.parametrize("buffer", [packing.BUFFER_TOKENS, 3000])
def test_packing_holds_every_id_once(spark, docs, clashing, empty, buffer):
    tokenizer = load_tokenizer(BYTE)
    got = packing.pack_documents(clashing, BYTE, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, buffer_tokens=buffer).collect()
    by_doc, by_window = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_window.setdefault(r.sequence_id, []).append(r)
    counts = {}
    for r in documents():
        counts[r[0]] = counts.get(r[0], 0) + 1
    assert set(by_doc) == set(counts)
    texts = {r[0]: r[1] or "" for r in documents() if counts[r[0]] == 1}
    for doc, text in texts.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        found = sorted(by_doc[doc], key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in found) == np.array(ids, "<u4").tobytes()
        assert all(r.doc_tokens == len(ids) and r.length * 4 == len(r.ids) for r in found)
        assert [r.start for r in found] == np.cumsum([0] + [r.length for r in found[:-1]]).tolist()
    for rows in by_window.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW
    assert packed(empty).count() == 0


def test_packing_pads_little_and_digests_agree(spark):
    rows = piece_digests(packed(spark.read.parquet(f"{SF001}/documents.parquet"))).collect()
    used, windows = sum(r.length for r in rows), len({r.sequence_id for r in rows})
    assert used / (windows * packing.WINDOW) > 0.97
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    tokenizer = load_tokenizer(BYTE)
    whole = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in text.items()}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(whole[r.doc_id][r.start:r.start + r.length], "<u4").tobytes())
        assert r.doc_tokens == len(whole[r.doc_id])
    assert {i: sum(r.length for r in rows if r.doc_id == i) for i in whole} == {i: len(ids) for i, ids in whole.items()}
