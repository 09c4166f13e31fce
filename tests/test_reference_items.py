"""Large dictionaries and lexicons, paged lists, stored news, tolerant sources, sub-words: edges and brute force."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newslab import schema as S
from newslab.functions import text as X
from newslab.operators import ingest as I
from newslab.operators import intel as N
from newslab.operators.encode import encode_subwords
from newslab.plans import context as C
from newslab.plans.queries import SUBWORDS
from newslab.session import scratch_path
from newslab.sources import files
from newslab.sources.tables import read_table
from tests.conftest import SF001, SF01

# ---------------------------------------------------------------- J3


@pytest.mark.parametrize("frequent", [1, 5, 2000])
def test_large_lexicon_equals_brute_force(spark, frequent):
    r = random.Random(frequent)
    words = [f"w{i}" for i in range(60)]
    rows = [(i % 40 if i % 9 else None, " ".join(r.choices(words, [1 / (k + 1) for k in range(60)], k=r.randrange(6)))) for i in range(150)]
    rows += [(7, "w59 x"), (7, "x y"), (None, "w59"), (None, None)]
    lexicon = ["w3", "w40", "w59", "absent", "w3"]
    df = spark.createDataFrame(rows, "news_id long, clean_text string").withColumn("l_id", F.lit(1)).withColumn("word", F.lit("w3"))
    lex = spark.createDataFrame([(w,) for w in lexicon], "word string")
    got = X.lexicon_semi_join(df, lex, frequent=frequent).select("news_id", "clean_text").collect()
    want = [x for x in rows if set((x[1] or "").split()) & set(lexicon)]
    assert Counter(map(tuple, got)) == Counter(want)
    assert X.lexicon_semi_join(df, lex.limit(0)).count() == 0 == X.lexicon_semi_join(df.limit(0), lex).count()


def test_large_lexicon_ships_few_words(spark):
    news = C.news(spark, SF01)
    lex = read_table(spark, SF01, "benchmark").select(F.explode(X.tokens(X.clean_text(F.col("text")))).alias("word"))
    hit, rare = X.rare_words(news, lex, "clean_text")
    shipped = news.filter(~hit).select(F.sum(F.size(rare))).first()[0] or 0
    assert shipped < news.select(F.sum("words")).first()[0] / 10

# ---------------------------------------------------------------- F5


def brute_names(text, names):
    words = re.findall(r"[^\W]+", (text or "").upper())
    at = lambda n: any(words[i:i + len(n)] == n for i in range(len(words)))
    return [c for _, c, n in sorted(names) if (w := re.findall(r"[^\W]+", n.upper())) and at(w)]


def test_names_of_several_words(spark):
    names = [(0, "BBCA", "Bank Central Asia"), (1, "BBRI", "bank rakyat"), (2, "B", "Bank"), (3, "X", "..."), (4, "ASII", "Astra"), (5, "AA", "a a"),
             (6, "TWO", "Central"), (7, "Ü", "über uns")]
    rows = [(1, "The bank, central - ASIA and bank Rakyat!"), (2, "bank central"), (3, "centralasia bankcentral asia"), (4, None), (5, ""),
            (6, "a a a"), (6, "Bank Central Asia Bank Central Asia"), (None, "astra"), (None, "ÜBER\nuns"), (7, "bank " * 3000 + "central asia")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("pos", "word", "hits", "n_id", "words")})
    got = X.detect_names(df, spark.createDataFrame(names, "ord int, code string, name string")).collect()
    assert Counter((r.doc_id, tuple(r.names)) for r in got) == Counter((i, tuple(brute_names(t, names))) for i, t in rows)


def test_single_words_equal_the_alternation_and_a_large_dictionary(spark):
    docs = read_table(spark, SF001, "documents").select("doc_id", "text")
    few = spark.createDataFrame([(i, w, w) for i, w in enumerate(C.TICKER_WORDS)], "ord int, code string, name string")
    want = {r.doc_id: r.t for r in docs.select("doc_id", X.detect_tickers(F.col("text"), C.TICKER_WORDS).alias("t")).collect()}
    assert {r.doc_id: r.names for r in X.detect_names(docs, few).collect()} == want
    many = few.unionByName(spark.range(100_000).select((F.col("id") + 10).cast("int").alias("ord"), F.concat(F.lit("c"), "id").alias("code"),
                                                       F.concat(F.lit("the zz"), "id").alias("name")))
    assert {r.doc_id: r.names for r in X.detect_names(docs, many).collect()} == want


def test_company_names_of_the_ticker_table(spark):
    names = spark.createDataFrame([(i, t, n) for i, (t, n) in enumerate(S.TICKERS)], "ord int, code string, name string")
    rows = [(i, f"Laba {n} naik") for i, (_, n) in enumerate(S.TICKERS)]
    got = {r.doc_id: r.names for r in X.detect_names(spark.createDataFrame(rows, "doc_id long, text string"), names).collect()}
    assert all(S.TICKERS[i][0] in found for i, found in got.items())

# ---------------------------------------------------------------- A9


@pytest.mark.parametrize("page", [1, 3, 1000])
def test_pages_hold_the_whole_list(spark, page):
    r = random.Random(page)
    rows = [(i % 50 if i % 7 else None, r.choice([["A"], ["A", "B"], [], None, ["C", "A"]]), r.choice(["x", "y", None])) for i in range(200)]
    df = spark.createDataFrame(rows, "news_id long, tickers array<string>, sentiment string").repartition(5)
    lists = {}
    for seq, tickers, s in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[2] is not None, x[2] or "")):
        for t in tickers or ():
            lists.setdefault(t, []).append(s)
    want = {(t, k): v[k * page:(k + 1) * page] for t, v in lists.items() for k in range(-(-len(v) // page))}
    assert {(x.ticker, x.page): x.sentiments for x in N.ticker_sentiment_pages(df, page_rows=page).collect()} == want


def test_hot_ticker_is_many_tasks(spark):
    df = spark.range(40_000).select(F.col("id").alias("news_id"), F.array(F.lit("HOT")).alias("tickers"), F.lit("x").alias("sentiment"))
    pages = N.ticker_sentiment_pages(df).collect()
    assert sorted(p.page for p in pages) == list(range(40)) and all(len(p.sentiments) == 1000 for p in pages)
    from newslab.operators.encode import global_rank

    tied = df.withColumn("tie", F.monotonically_increasing_id()).select("tickers", "sentiment", "tie")
    assert global_rank(tied, ["tickers", "sentiment", "tie"]).groupBy(F.spark_partition_id()).count().count() > 1

# ---------------------------------------------------------------- K2


def test_recent_rows_read_only_the_newest_days(spark):
    store = scratch_path(spark, "recent")
    rows = [(i, "t", "netral", f"2024-{1 + i % 9:02d}-{1 + i % 27:02d} 0{i % 10}:00:00") for i in range(300)] + [(900, "t", "netral", None), (901, None, "netral", "2025-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "seq long, title string, sentiment string, ts string").withColumn("created_at", F.to_timestamp("ts")).drop("ts")
    files.append_news(df, store, "run-1")
    valid = df.filter("title is not null")
    for n in (1, 7, 20, 301, 1000):
        assert N.recent_from_store(spark, store, n).select("seq").collect() == N.recent(valid, n, id_col="seq").select("seq").collect()
    days = files.store_days(spark, store)
    assert days[-1] is None and days[:-1] == sorted(days[:-1], reverse=True) and "2025-01-01" not in days
    read = N.recent_from_store(spark, store, 7).inputFiles()
    assert {f.split("date=")[1].split("/")[0] for f in read} < set(days[:15]) and any(days[0] in f for f in read)
    assert N.recent_from_store(spark, store, 5).count() == 5

# ---------------------------------------------------------------- S1, S5


def test_a_broken_record_costs_itself(spark):
    path, quarantine = scratch_path(spark, "csv"), scratch_path(spark, "quarantine")
    lines = ["doc_id,judul,tanggal,sentimen", '1,"a ""quoted""\nline",2024-01-01,positif', "x2,b,2024-01-01,netral", "3,c", '4,d,2024-01-02,negatif,extra',
             "5,e,,", '6,"",2024-01-03,netral']
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    from pyspark.sql import types as T

    good = files.read_news_tolerant(spark, path, quarantine, T.StructType([T.StructField("doc_id", T.LongType()), *S.RAW_NEWS.fields]))
    assert sorted(map(tuple, good.collect())) == [(1, 'a "quoted"\nline', "2024-01-01", "positif"), (5, "e", None, None), (6, None, "2024-01-03", "netral")]
    bad = spark.read.parquet(quarantine).collect()
    assert sorted(r.record for r in bad) == ["3,c", "4,d,2024-01-02,negatif,extra", "x2,b,2024-01-01,netral"] and all(path.split("/")[-1] in r.file for r in bad)


def test_listings_of_any_shape(spark):
    title = "a title that is long enough"
    pages = ['{"data":{"children":[{"data":{"title":"%s","permalink":"/p"}},{"data":{"title":7}},5,null,{"data":{"title":"%s"}},{"other":1}]}}' % (title, title),
             '{"data":{"children":{"data":{"title":"%s"}}}}' % title, '{"data":[]}', "[]", "", "{", None, '{"data":{"children":[{"data":{"title":["%s"],"permalink":{}}}]}}' % title,
             '{"data":{"children":[{"data":{"title":"%s","permalink":3}}]}}' % title]
    df = spark.createDataFrame([(i, 0, p) for i, p in enumerate(pages)], "conv_id long, start long, json string")
    got = sorted(map(tuple, I.json_posts_of_any_shape(df).select("conv_id", "pos", "title", "url").collect()))
    link = S.JSON_LINK_PREFIX
    assert got == [(0, 0, title, link + "/p"), (0, 4, title, link), (8, 0, title, link)]
    assert I.feed_shape(df.filter("conv_id = 8")) == "OBJECT<data: OBJECT<children: ARRAY<OBJECT<data: OBJECT<permalink: BIGINT, title: STRING>>>>>"
    assert I.feed_shape(df.limit(0)) is None


def test_todays_listings_are_read_as_before(spark):
    feeds = I.feed_json(read_table(spark, SF01, "conversations").select("conv_id", "turn", "text"))
    assert Counter(I.json_posts(feeds).collect()) == Counter(I.json_posts_of_any_shape(feeds).collect())

# ---------------------------------------------------------------- F14


def test_subwords_equal_the_library_on_whole_texts(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(SUBWORDS)
    news = C.news(spark, SF001)
    rows = news.select("news_id", "clean_text").unionByName(spark.createDataFrame([(-1, ""), (-2, None), (-3, "x " * 500), (-4, "unbelievablyunsplittable")], "news_id long, clean_text string"))
    got = {r.news_id: r for r in encode_subwords(rows, SUBWORDS).collect()}
    for r in rows.collect():
        ids = library.encode(r.clean_text or "", add_special_tokens=False).ids[:S.MAX_LENGTH]
        pad = S.MAX_LENGTH - len(ids)
        assert (got[r.news_id].input_ids, got[r.news_id].attention_mask) == (ids + [0] * pad, [1] * len(ids) + [0] * pad)
