"""Column functions against golden rows (FIXTURES.md section 2)."""

import math

import pytest
from pyspark.sql import functions as F

from newslab import schema as S
from newslab.functions import text as X
from newslab.operators import intel as N
from newslab.operators import search as G

CLEAN_CASES = [
    (None, "", 0),
    ("", "", 0),
    ("Saham BBCA naik 20% http://x.y/z?q=1 www.kontan.co.id ok", "saham bbca naik ok", 4),
    ("xhttp a", "xhttp a", 2),
    ("www. x", "www x", 2),
    ("http", "http", 1),
    ("a-b_c9d", "a b c d", 4),
    ("café BBCA", "caf bbca", 2),
    ("http BBCA naik", "http bbca naik", 3),
    ("HTTPS://A.B C d", "c d", 2),
]


def test_clean_text_golden(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(CLEAN_CASES)], "i INT, t STRING")
    out = df.select("i", X.clean_text(F.col("t")).alias("c")).withColumn("w", X.word_count(F.col("c")))
    got = {r.i: (r.c, r.w) for r in out.collect()}
    for i, (_, clean, words) in enumerate(CLEAN_CASES):
        assert got[i] == (clean, words), CLEAN_CASES[i]


def test_clean_text_idempotent_and_alphabet(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    c = docs.select(X.clean_text(F.col("text")).alias("c"))
    twice = c.select("c", X.clean_text(F.col("c")).alias("c2"))
    assert twice.filter(F.col("c") != F.col("c2")).count() == 0
    assert c.filter(~F.col("c").rlike("^[a-z ]*$")).count() == 0


HEADLINES = [
    ("Laba BBCA tumbuh dan harganya menguat pada sesi pagi.", "positif", 0.82, ["BBCA"],
     "WATCH"),
    ("Pelaku pasar menunggu kabar dari BBRI serta BMRI pekan depan.", "netral", 0.65, ["BBRI", "BMRI"], "MONITOR"),
    ("Harga GOTO melemah sampai akhir sesi kedua.", "negatif", 0.78, ["GOTO"], "RISK ALERT"),
    ("Indeks gabungan melemah menjelang libur panjang.", "negatif", 0.78, [], "RISK ALERT"),
]


def _features(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "news_id LONG, text STRING")
    return N.news_features(df)


def test_headline_features_golden(spark):
    rows = {r.news_id: r for r in _features(spark, [h[0] for h in HEADLINES]).collect()}
    for i, (_, sent, conf, tickers, sig) in enumerate(HEADLINES):
        r = rows[i]
        assert (r.sentiment, r.tickers, r.signal) == (sent, tickers, sig)
        assert math.isclose(r.confidence, conf)


def test_positive_wins_and_ticker_tie(spark):
    f = _features(spark, ["BBCA naik lalu turun tajam hari ini", "BBCA turun tajam sekali hari ini"])
    got = [r.sentiment for r in f.orderBy("news_id").collect()]
    assert got == ["positif", "negatif"]
    dom = N.ticker_dominant(f).collect()
    assert [(r.ticker, r.dominant) for r in dom] == [("BBCA", "negatif")]


def test_briefing_golden(spark):
    f = _features(spark, [h[0] for h in HEADLINES[:3]])
    rows = [(r.section, r.ord, r.key, r.value) for r in N.market_briefing(f).orderBy("section", "ord").collect()]
    assert ("total", 0, "total", "3") in rows
    assert [r for r in rows if r[0] == "sentiment"] == [
        ("sentiment", 1, "positif", "1"), ("sentiment", 2, "netral", "1"), ("sentiment", 3, "negatif", "1")]
    assert [(r[2], r[3]) for r in rows if r[0] == "ticker"] == [
        ("BBCA", "positif"), ("BBRI", "netral"), ("BMRI", "netral"), ("GOTO", "negatif")]


def test_briefing_without_tickers(spark):
    f = _features(spark, ["Indeks gabungan melemah menjelang libur panjang."])
    rows = [(r.section, r.key, r.value) for r in N.market_briefing(f).collect()]
    assert ("ticker", "none", "No ticker detected") in rows


def test_dashboard_golden(spark):
    df = spark.createDataFrame([(s,) for s in ["positif", "negatif", "netral", "positif", "negatif", "netral"]],
                               "sentiment STRING")
    r = N.dashboard_stats(df).first()
    assert (r.positif, r.negatif, r.netral, r.total) == (2, 2, 2, 6)


def test_alert_text(spark):
    f = _features(spark, ["Laba BBCA tumbuh, harganya menguat."])
    a = f.select(X.alert_text(F.col("text"), F.col("tickers"), F.col("sentiment"), F.col("confidence"),
                              F.col("signal")).alias("a")).first().a
    assert a.split("\n")[1:] == ["Tickers: BBCA", "Sentiment: positif", "Confidence: 82.00%",
                                 "Experimental Signal: WATCH",
                                 "News: Laba BBCA tumbuh, harganya menguat."]


def test_ticker_boundaries(spark):
    df = spark.createDataFrame([("ÉBBCA x",), ("(BBCA)",), ("BBCA_1",), ("bbca.",)], "t STRING")
    got = [r.k for r in df.select(X.detect_tickers(F.col("t")).alias("k")).collect()]
    assert got == [[], ["BBCA"], [], ["BBCA"]]


def test_candidate_features_default(spark):
    c = G.candidate_features(G.default_candidate(spark)).first()
    got = [c[f"f{k}"] for k in range(10)]
    want = [1 / 3, 0.5, 0.5, 0.5, 0.5, 0.5, math.log10(2e-5), 8.0, 16.0, 2.0]
    assert all(math.isclose(a, b) for a, b in zip(got, want))


def test_early_stop_golden(spark):
    log = spark.createDataFrame([(1, 0.50), (2, 0.57), (3, 0.57), (4, -1.0), (5, 0.55), (6, 0.56)],
                                "gen INT, best_f1 DOUBLE")
    rows = {r.gen: r for r in G.early_stop(log, 3).collect()}
    assert [rows[g].streak for g in range(1, 7)] == [0, 0, 1, 1, 2, 3]
    assert [g for g in rows if rows[g].stop] == [6]


def test_resolve_link(spark):
    df = spark.createDataFrame([("https://u:p@a.b:8080/x/y?q=1", "/z"), ("http://a.b/", "http://c.d/e")],
                               "u STRING, h STRING")
    got = [r.l for r in df.select(X.resolve_link(F.col("u"), F.col("h")).alias("l")).collect()]
    assert got == ["https://u:p@a.b:8080/z", "http://c.d/e"]


@pytest.mark.parametrize("label,expected", [("  Positif ", "positif"), ("NETRAL", "netral"), (None, None)])
def test_normalise_label(spark, label, expected):
    df = spark.createDataFrame([(label,)], "l STRING")
    assert df.select(X.normalise_label(F.col("l")).alias("x")).first().x == expected


def test_space_size():
    assert S.SPACE_SIZE == 972
    assert S.default_indices() == (1, 1, 1, 1, 1, 1)
