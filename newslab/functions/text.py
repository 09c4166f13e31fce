"""Column functions (pure expressions, no Python workers).

Every function takes and returns ``Column`` objects so Catalyst keeps them
inside whole-stage codegen and can push the surrounding filters down.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslab import schema as S

# Regex dialect notes (Java): ``(?U)`` makes ``\S`` / ``\s`` Unicode aware, so a
# URL stops at a no-break space exactly like Python's ``\S``.
_URL = r"(?U)http\S+|www\.\S+"
_EDGE_SPACE = r"(?U)^\s+|\s+$"
# Python's ``\b`` treats every Unicode letter or digit (and ``_``) as a word
# character; spell that out so the rule does not depend on the JDK version.
_WORD_CHAR = r"[\p{L}\p{N}_]"


def clean_text(c: Column) -> Column:
    """Lower-case, drop URLs, keep only ``a-z`` words separated by one space.

    Null becomes the empty string.  After ``lower`` the original three steps
    (non-letters to space, collapse whitespace, strip) equal one replace of
    ``[^a-z]+`` by a space and a trim.
    """
    lowered = F.lower(F.coalesce(c.cast("string"), F.lit("")))
    no_urls = F.regexp_replace(lowered, _URL, " ")
    return F.trim(F.regexp_replace(no_urls, "[^a-z]+", " "))


def word_count(clean: Column) -> Column:
    """Number of words of a cleaned text (empty text has none).

    The text is referenced once, so the cleaning chain under it is evaluated
    once per row even after Catalyst inlines it into a pushed-down filter.
    """
    return F.size(tokens(clean))


def tokens(clean: Column) -> Column:
    """Token array of a cleaned text; empty text gives an empty array."""
    return F.filter(F.split(clean, " "), lambda t: t != "")


def normalise_label(c: Column) -> Column:
    """Text, lower case, stripped of surrounding whitespace."""
    return F.lower(F.regexp_replace(c.cast("string"), _EDGE_SPACE, ""))


def label_id(label: Column) -> Column:
    expr = None
    for i, name in enumerate(S.LABELS):
        expr = F.when(label == name, F.lit(i)) if expr is None else expr.when(label == name, F.lit(i))
    return expr


def label_name(idx: Column) -> Column:
    expr = None
    for i, name in enumerate(S.LABELS):
        expr = F.when(idx == i, F.lit(name)) if expr is None else expr.when(idx == i, F.lit(name))
    return expr


def _str_array(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def lexicon_hit(clean: Column, words: Sequence[str]) -> Column:
    """True when any token of the cleaned text is in the lexicon."""
    return F.coalesce(F.arrays_overlap(tokens(clean), _str_array(words)), F.lit(False))


def lexicon_count(clean: Column, words: Sequence[str]) -> Column:
    """Number of tokens (with repeats) of the cleaned text found in the lexicon."""
    lex = _str_array(words)
    return F.size(F.filter(tokens(clean), lambda t: F.array_contains(lex, t)))


#: Words of the texts that are decided next to the scan in a large-lexicon join.
FREQUENT_WORDS = 2000


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores behind it as it takes to clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def _frequent(words: DataFrame, most: int) -> list[str]:
    """About the ``most`` most frequent values of column ``word``, by a sketch next to the scan."""
    top = words.agg(F.expr(f"approx_top_k(word, {most}, {1 << max(12, (4 * most).bit_length())})").alias("top")).first()["top"]
    return [r["item"] for r in top or []]


def rare_words(df: DataFrame, lexicon: DataFrame, clean_col: str, frequent: int = FREQUENT_WORDS) -> tuple[Column, Column]:
    """(hit, rare): whether one of the frequent words of a row is in the lexicon, and the row's other distinct words.

    A frequency sketch finds the frequent words in one pass without a shuffle; any set of words would do, so its errors
    change cost only.  Which of them are in the lexicon reaches the driver (at most ``frequent`` words).
    """
    known = _frequent(df.select(F.explode(tokens(F.col(clean_col))).alias("word")), frequent)
    hits = [r["word"] for r in lexicon.filter(F.col("word").isin(known)).select("word").distinct().collect()] if known else []
    row = tokens(F.col(clean_col))
    return F.coalesce(F.arrays_overlap(row, _str_array(hits)), F.lit(False)), F.array_except(row, _str_array(known))


def lexicon_semi_join(df: DataFrame, lexicon: DataFrame, clean_col: str = "clean_text", id_col: str = "news_id",
                      frequent: int = FREQUENT_WORDS) -> DataFrame:
    """Rows with at least one token in a lexicon table (column ``word``) of any size.

    Frequent words are decided next to the scan, so neither they nor the rows that hold a frequent lexicon word enter a
    shuffle; the distinct rare words of the other rows meet the lexicon in a join, and the rows hit are found again by id
    and text hash.  Null and repeated ids are rows of their own.
    """
    hit, rare = rare_words(df, lexicon, clean_col, frequent)
    left = df.filter(~hit)
    l_id, l_text = free_names(df, "l_id", "l_text")
    row = [F.col(id_col).alias(l_id), F.xxhash64(F.col(clean_col)).alias(l_text)]
    found = (left.select(*row, F.explode(rare).alias("word"))
             .join(lexicon.select("word").distinct(), "word", "left_semi").select(l_id, l_text).distinct())
    same = F.col(id_col).eqNullSafe(F.col(l_id)) & (F.xxhash64(F.col(clean_col)) == F.col(l_text))
    return df.filter(hit).unionByName(left.join(found, same, "left_semi"))


def lexicon_sentiment(clean: Column, positive: Sequence[str] = S.POSITIVE_WORDS,
                      negative: Sequence[str] = S.NEGATIVE_WORDS) -> tuple[Column, Column]:
    """(sentiment, confidence); a positive hit wins over a negative hit."""
    pos = lexicon_hit(clean, positive)
    neg = lexicon_hit(clean, negative)
    sentiment = F.when(pos, F.lit("positif")).when(neg, F.lit("negatif")).otherwise(F.lit("netral"))
    confidence = (
        F.when(pos, F.lit(S.CONF_POSITIVE)).when(neg, F.lit(S.CONF_NEGATIVE)).otherwise(F.lit(S.CONF_NEUTRAL))
    )
    return sentiment, confidence


def detect_tickers(text: Column, tickers: Sequence[str] = tuple(t for t, _ in S.TICKERS)) -> Column:
    """Whole-word tickers found in the upper-cased text, in dictionary order, no repeats.

    One pass: a single literal alternation (compiled once per task) finds
    every whole-word occurrence; whole-word matches cannot overlap, so this
    equals one search per ticker.  Dictionary order comes from filtering the
    fixed list.
    """
    up = F.upper(F.coalesce(text, F.lit("")))
    alt = "|".join(re.escape(t) for t in sorted(tickers, key=len, reverse=True))
    found = F.regexp_extract_all(up, F.lit(rf"(?<!{_WORD_CHAR})({alt})(?!{_WORD_CHAR})"), 1)
    return F.filter(_str_array(tickers), lambda t: F.array_contains(found, t))


def name_words(text: Column) -> Column:
    """Upper-cased words of a text: runs of letters, digits and ``_``."""
    return F.regexp_extract_all(F.upper(F.coalesce(text.cast("string"), F.lit(""))), F.lit(r"([\p{L}\p{N}_]+)"), 1)


def detect_names(df: DataFrame, dictionary: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """F5 for dictionaries of any size and names of several words: ``id_col`` and ``names`` of every row of ``df``.

    ``dictionary``: ord (position), code and name.  A name is found where its words follow each other in the text, whatever
    stands between two words; ``names`` are the codes found, each once, in dictionary order.  Names meet the texts by their
    first word: a position carries as many words as the longest name has, and positions of frequent words that start no
    name are left out at the scan, so a text is never shuffled whole.  First words are broadcast if Spark measures them
    small.  A name without a word is never found; rows are told apart by id and text, so null and repeated ids are rows of
    their own and equal rows have equal names.
    """
    names = (dictionary.select("ord", "code", name_words(F.col("name")).alias("d_words")).filter(F.size("d_words") > 0)
             .withColumn("first", F.col("d_words")[0]))
    longest = names.agg(F.max(F.size("d_words"))).first()[0] or 0
    rows = df.select(F.col(id_col), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("t_hash"), name_words(F.col(text_col)).alias("words"))
    known = _frequent(rows.select(F.explode("words").alias("word")), FREQUENT_WORDS)
    starts = {r["first"] for r in names.filter(F.col("first").isin(known)).select("first").distinct().collect()} if known else set()
    idle = [w for w in known if w not in starts]
    at = rows.select(F.col(id_col).alias("n_id"), F.col("t_hash").alias("n_hash"), "words", F.posexplode("words").alias("pos", "word"))
    at = (at.filter(~F.col("word").isin(idle)) if idle else at).select(
        "n_id", "n_hash", "word", F.slice("words", F.col("pos") + 1, max(longest, 1)).alias("ahead"))
    found = (at.join(names, F.col("word") == F.col("first"))
             .filter(F.slice("ahead", F.lit(1), F.size("d_words")) == F.col("d_words"))
             .groupBy("n_id", "n_hash").agg(F.collect_set(F.struct("ord", "code")).alias("hits")))
    found = found.select("n_id", "n_hash", F.transform(F.array_sort("hits"), lambda h: h["code"]).alias("hits"))
    return (rows.select(F.col(id_col), "t_hash")
            .join(found, F.col(id_col).eqNullSafe(F.col("n_id")) & (F.col("t_hash") == F.col("n_hash")), "left")
            .select(F.col(id_col), F.coalesce("hits", F.array().cast("array<string>")).alias("names")))


def signal(sentiment: Column, confidence: Column) -> Column:
    return (
        F.when((sentiment == "positif") & (confidence >= S.SIGNAL_THRESHOLD), F.lit("WATCH"))
        .when((sentiment == "negatif") & (confidence >= S.SIGNAL_THRESHOLD), F.lit("RISK ALERT"))
        .otherwise(F.lit("MONITOR"))
    )


def percent_text(fraction: Column) -> Column:
    """``{:.2%}`` from integer basis points (formatted last, no float halves)."""
    bp = F.round(fraction * 10000).cast("long")
    return F.concat(
        (bp / 100).cast("long").cast("string"), F.lit("."), F.lpad((bp % 100).cast("string"), 2, "0"), F.lit("%")
    )


def alert_text(news: Column, tickers: Column, sentiment: Column, confidence: Column, sig: Column,
               header: str = "News Alert") -> Column:
    ticker_text = F.when(F.size(tickers) == 0, F.lit("Not detected")).otherwise(F.array_join(tickers, ", "))
    return F.concat(
        F.lit(header + "\nTickers: "), ticker_text,
        F.lit("\nSentiment: "), sentiment,
        F.lit("\nConfidence: "), percent_text(confidence),
        F.lit("\nExperimental Signal: "), sig,
        F.lit("\nNews: "), news,
    )


def badge_text(sentiment: Column, title: Column) -> Column:
    """One broadcast line: ``[SENTIMENT] title``."""
    return F.concat(F.lit("["), F.upper(sentiment), F.lit("] "), title)


def softmax(logits: Column) -> Column:
    """Numerically stable softmax of a double array."""
    m = F.array_max(logits)
    ex = F.transform(logits, lambda x: F.exp(x - m))
    total = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(ex, lambda x: x / total)


def argmax(values: Column) -> Column:
    """0-based index of the first maximum."""
    return F.array_position(values, F.array_max(values)) - 1


def first_href(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<a\s[^>]*?href=\"([^\"]*)\"", 1)


def resolve_link(page_url: Column, href: Column) -> Column:
    """Relative ``/x`` links get the page's scheme and netloc (host, port, user).

    A malformed page URL yields null instead of failing the job.
    """
    base = F.concat(F.try_parse_url(page_url, F.lit("PROTOCOL")), F.lit("://"),
                    F.try_parse_url(page_url, F.lit("AUTHORITY")))
    return F.when(href.startswith("/"), F.concat(base, href)).otherwise(href)


def url_host(page_url: Column) -> Column:
    return F.try_parse_url(page_url, F.lit("HOST"))
