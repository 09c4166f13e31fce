"""Listing extraction, de-duplication, per-source caps and the news store.

Input is a table of fetched pages (``page_id, url, html``) or of JSON
listings; fetching itself is outside Spark.  Order of operations per run:
length filter -> first-wins title de-duplication -> at most ``cap`` items
per source in arrival order.

Skew: first-per-title and the per-source cap are ``row_number <= k``, which
Spark plans as a ``WindowGroupLimit`` before the shuffle, so a title or a
source holding a third of all rows ships only ``k`` rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslab import schema as S
from newslab.functions import text as X

HEADINGS = ("h2", "h3")
RULES = (("article", HEADINGS), ("li", HEADINGS), ("div", HEADINGS))
ARRIVAL = ("page_id", "pos")


class _Listing(HTMLParser):
    """Containers of one page in document order: (heading text or None, href of the first anchor or None).

    A heading belongs to every container open around it that has none yet; the first anchor likewise.  Tags left open
    end with the element around them.
    """

    def __init__(self, rules: dict[str, tuple[str, ...]], limit: int):
        super().__init__(convert_charrefs=True)
        self.rules, self.limit = rules, limit
        self.headings = {h for hs in rules.values() for h in hs}
        self.found: list[dict] = []
        self.open: list[tuple[str, dict | None]] = []
        self.reading: list[tuple[str, list[dict], list[str]]] = []

    def handle_starttag(self, tag, attrs):
        if tag in self.rules:
            box = None
            if len(self.found) < self.limit:
                box = {"tag": tag, "title": None, "link": None}
                self.found.append(box)
            self.open.append((tag, box))
        if tag == "a":
            href = dict(attrs).get("href")
            for _, box in self.open:
                if box is not None and box["link"] is None:
                    box["link"] = (href,)
        if tag in self.headings:
            boxes = [b for t, b in self.open if b is not None and b["title"] is None and tag in self.rules[t]]
            for b in boxes:
                b["title"] = ""
            self.reading.append((tag, boxes, []))

    def handle_data(self, data):
        for _, _, parts in self.reading:
            parts.append(data)

    def handle_endtag(self, tag):
        if any(t == tag for t, _, _ in self.reading):
            while self.reading:
                t, boxes, parts = self.reading.pop()
                for b in boxes:
                    b["title"] = "".join(parts)
                if t == tag:
                    break
        if tag in self.rules and any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def close(self):
        super().close()
        for tag in [t for t, _, _ in self.reading[::-1]]:
            self.handle_endtag(tag)


def headlines_from_pages(pages: DataFrame, rules: Sequence[tuple[str, Sequence[str]]] = RULES,
                         min_len: int = S.HTML_MIN_TITLE, max_containers: int = S.MAX_CONTAINERS) -> DataFrame:
    """S4 + F12 + P8: candidate headlines of the first ``max_containers`` containers of every page.

    ``rules`` name the container elements and the heading elements looked for in each.  A container gives a headline
    if it holds a heading and its first anchor has an ``href``; relative links are made absolute with the page's
    scheme and netloc.  Nested containers may repeat a heading: title de-duplication keeps the first.

    Returns page_id, pos (place of the container in the page), title, url, source (the page's host).  Pages are parsed
    where they are read, in Arrow batches; nothing is shuffled.
    """
    by_tag = {tag: tuple(heads) for tag, heads in rules}

    @F.arrow_udf("array<struct<pos:int,title:string,href:string>>")
    def listed(html: pa.Array) -> pa.Array:
        out = []
        for page in html.to_pylist():
            parser = _Listing(by_tag, max_containers)
            parser.feed(page or "")
            parser.close()
            out.append([{"pos": i, "title": b["title"].strip(), "href": b["link"][0]} for i, b in enumerate(parser.found)
                        if b["title"] is not None and b["link"] is not None and b["link"][0] is not None])
        return pa.array(out, pa.list_(pa.struct([("pos", pa.int32()), ("title", pa.string()), ("href", pa.string())])))

    items = pages.select("page_id", "url", F.explode(listed(F.col("html"))).alias("h"))
    out = items.select("page_id", "h.pos", "h.title", X.resolve_link(F.col("url"), F.col("h.href")).alias("url"),
                       X.url_host(F.col("url")).alias("source"))
    return out.filter((F.col("title") != "") & (F.length("title") > min_len))


def feed_json(conversations: DataFrame, page_size: int = 100) -> DataFrame:
    """JSON listing pages per conversation (``data.children[].data.{title,permalink}``), with the position of the first post.

    A page holds the turns of one range of ``page_size`` turn numbers, so a collected group is bounded even when one
    conversation holds a third of all rows; ``start`` counts the posts on earlier pages, so positions do not depend on
    the page size or on gaps in the turn numbers.
    """
    page = F.floor(F.col("turn") / page_size).cast("long")
    posts = F.array_sort(F.collect_list(F.struct("turn", "text")))
    children = F.transform(
        posts,
        lambda p: F.struct(
            F.struct(
                p["text"].alias("title"),
                F.concat(F.lit("/c/"), F.col("conv_id").cast("string"), F.lit("/"), p["turn"].cast("string"))
                .alias("permalink"),
            ).alias("data")
        ),
    )
    pages = conversations.groupBy("conv_id", page.alias("page")).agg(
        F.to_json(F.struct(F.struct(children.alias("children")).alias("data"))).alias("json"),
        F.count(F.lit(1)).alias("posts"))
    sizes = pages.select("conv_id", "page", "posts")
    earlier = Window.partitionBy("conv_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("conv_id").alias("s_id"), F.col("page").alias("s_page"),
                          F.coalesce(F.sum("posts").over(earlier), F.lit(0)).alias("start"))
    return pages.join(starts, F.col("conv_id").eqNullSafe(F.col("s_id")) & F.col("page").eqNullSafe(F.col("s_page"))).select(
        "conv_id", "page", "start", "json")


def json_posts(feeds: DataFrame, json_col: str = "json", source_col: str = "conv_id",
               min_len: int = S.JSON_MIN_TITLE, prefix: str = S.JSON_LINK_PREFIX) -> DataFrame:
    """S5 + P8: posts of JSON listing pages (conv_id, pos, title, url, source); missing keys default to ''.

    ``pos`` is the post's place in its listing: the page's ``start`` plus its index.
    """
    parsed = feeds.select(F.col(source_col).alias("conv_id"), "start",
                          F.from_json(F.col(json_col), S.JSON_FEED).alias("j"))
    posts = parsed.select("conv_id", "start", F.posexplode(F.col("j.data.children")).alias("idx", "child"))
    out = posts.select(
        "conv_id", (F.col("start") + F.col("idx")).cast("int").alias("pos"),
        F.coalesce(F.col("child.data.title"), F.lit("")).alias("title"),
        F.concat(F.lit(prefix), F.coalesce(F.col("child.data.permalink"), F.lit(""))).alias("url"),
        F.col("conv_id").cast("string").alias("source"),
    )
    return out.filter(F.length("title") > min_len)


def _text_of(value: Column) -> Column:
    """The text of a VARIANT that holds one, else null (numbers, objects and lists are no titles)."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def json_posts_of_any_shape(feeds: DataFrame, json_col: str = "json", source_col: str = "conv_id",
                            min_len: int = S.JSON_MIN_TITLE, prefix: str = S.JSON_LINK_PREFIX) -> DataFrame:
    """S5 for listings whose shape drifts: as ``json_posts``, but nothing in a page can end the job or shift its posts.

    A page is read as VARIANT.  Broken JSON, a page without ``data.children``, or children that are no list give no posts; a
    child that is no object, or whose title is missing or no text, keeps its place and has an empty title; a permalink that
    is missing or no text is empty.
    """
    pages = feeds.select(F.col(source_col).alias("conv_id"), "start", F.try_parse_json(F.col(json_col)).alias("page"))
    posts = pages.select("conv_id", "start", F.posexplode(F.try_variant_get("page", "$.data.children", "array<variant>")).alias("idx", "child"))

    def text(path: str) -> Column:
        return F.coalesce(_text_of(F.try_variant_get("child", path, "variant")), F.lit(""))

    out = posts.select("conv_id", (F.col("start") + F.col("idx")).cast("int").alias("pos"), text("$.data.title").alias("title"),
                       F.concat(F.lit(prefix), text("$.data.permalink")).alias("url"), F.col("conv_id").cast("string").alias("source"))
    return out.filter(F.length("title") > min_len)


def feed_shape(feeds: DataFrame, json_col: str = "json") -> str | None:
    """The common schema of all listing pages, as Spark merges their VARIANT schemas; null without a page that parses."""
    found = feeds.select(F.try_parse_json(F.col(json_col)).alias("v")).filter("v is not null")
    row = found.agg(F.schema_of_variant_agg("v").alias("shape"), F.count(F.lit(1)).alias("n")).first()
    return row["shape"] if row["n"] else None


def dedup_titles(items: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """U4: the first occurrence, in arrival order, of every exact title wins."""
    w = Window.partitionBy("title").orderBy(*order)
    return items.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def cap_per_source(items: DataFrame, cap: int = S.ITEMS_PER_SOURCE, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """At most ``cap`` items per source in arrival order."""
    w = Window.partitionBy("source").orderBy(*order)
    return items.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= cap).drop("_rn")


def collect_headlines(items: DataFrame, cap: int = S.ITEMS_PER_SOURCE, order: Sequence[str] = ARRIVAL) -> DataFrame:
    return cap_per_source(dedup_titles(items, order), cap, order)


def score_items(items: DataFrame, positive: Sequence[str] = S.POSITIVE_WORDS,
                negative: Sequence[str] = S.NEGATIVE_WORDS, title_col: str = "title") -> DataFrame:
    """M2 (lexicon form): sentiment and confidence per title, plus the broadcast line."""
    clean = X.clean_text(F.col(title_col))
    sentiment, confidence = X.lexicon_sentiment(clean, positive, negative)
    out = items.withColumns({"sentiment": sentiment, "confidence": confidence})
    return out.withColumn("badge", X.badge_text(F.col("sentiment"), F.col(title_col)))
