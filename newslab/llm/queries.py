"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them.

Each ``opN_<name>`` applies its operator, with production parameters, to the whole table named in its contract.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslab.llm import (ball_search, chat_format, exact_dedup, jaccard_join, language_id, merkle, mixing, packing, quality_crf,
                         repeats, token_counts, toxicity, url_filter)
from newslab.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ------------------------------------------------------------------ 1

CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query
def op1_chat_format(spark, d):
    """All conversations and conversation -1, formatted and read back."""
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.read_back(chat_format.format_conversations(turns))


def _controls_in(text: str) -> str:
    return " + ".join(f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in chat_format.DEFAULT.controls)


_T = chat_format.DEFAULT
_MARKS = " ".join(f"WHEN role = '{r}' THEN {len(m.open) + len(m.close)}" for r, m in _T.roles.items())
_LEGAL = " OR ".join(f"(before = '{a}' AND role IN ({', '.join(repr(b) for b in to)}))" for a, to in _T.moves.items())
ORACLE["op1_chat_format"] = f"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}') u),
o AS (
  SELECT *, row_number() OVER w AS rn, coalesce(lag(role) OVER w, 'start') AS before,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS last_rn
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (
  SELECT *, CASE {_MARKS} ELSE {sum(map(len, _T.other_open)) + len(_T.other_close)} + length(role) END + length(text)
            + (length(text) - length(replace(text, '\\', ''))) + 2 * ({_controls_in('text')}) AS chars,
         ({_LEGAL}) AS legal
  FROM o)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY rn), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars, 3 * count(*) AS n_segments,
       bool_and(legal) AND max(CASE WHEN last_rn = 1 THEN role END) = 'assistant' AS valid
FROM p GROUP BY conv_id"""

# ------------------------------------------------------------------ 2


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op2_packing(spark, d):
    """All documents in windows of 2048 tokens."""
    return piece_digests(packed(table(spark, d, "documents")))


# ------------------------------------------------------------------ 3


@query
def op3_token_counts(spark, d):
    """Tokens of every document under the word-level tokenizer."""
    return token_counts.count_tokens(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


# ------------------------------------------------------------------ 4


@query
def op4_jaccard_join(spark, d):
    """Shingle sets and link components of all documents."""
    return jaccard_join.link_documents(table(spark, d, "documents"))


# ------------------------------------------------------------------ 5

FIRST_DAY, DAYS = "2024-01-01", 180


def captures(spark, d) -> DataFrame:
    """Pages as captures: the day of a fetch follows from page_id."""
    pages = table(spark, d, "pages").select("page_id", "url")
    return pages.withColumn("fetch_date", F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod("page_id", F.lit(DAYS)).cast("int")))


def list_entries(pages: DataFrame) -> DataFrame:
    """Two dated lists derived from the hosts of the pages: hosts come, go and some come back; domains come for good."""
    host = (pages.select(url_filter.host_of(F.col("url")).alias("host")).filter("host is not null").distinct()
            .withColumn("k", F.conv(F.substring(F.md5(F.col("host").cast("binary")), 1, 6), 16, 10).cast("long")))
    day = lambda c: F.date_add(F.lit(FIRST_DAY).cast("date"), c.cast("int"))
    k = F.col("k")
    came, stay = F.pmod(k, F.lit(120)), F.lit(10) + F.pmod(k, F.lit(40))
    hosts = host.filter(F.pmod(k, F.lit(3)) == 0).select(
        F.lit("hosts").alias("list_name"), F.col("host").alias("domain"),
        F.explode(F.array(F.struct(day(came).alias("entry_date"), F.lit("add").alias("action")),
                          F.struct(day(came + stay).alias("entry_date"), F.lit("remove").alias("action")),
                          F.struct(day(came + stay * F.pmod(k, F.lit(4))).alias("entry_date"), F.lit("add").alias("action")))).alias("e"))
    domains = (host.select(F.array_join(F.slice(F.split("host", r"\."), -2, 2), ".").alias("domain"), "k")
               .filter("instr(domain, '.') > 0").groupBy("domain").agg(F.max("k").alias("k"))
               .select(F.lit("domains").alias("list_name"), "domain",
                       F.struct(day(F.lit(60) + F.pmod(k, F.lit(100))).alias("entry_date"), F.lit("add").alias("action")).alias("e")))
    return hosts.unionByName(domains).select("list_name", "domain", "e.entry_date", "e.action")


@query
def op5_url_filter(spark, d):
    """Every page's verdict against the list entries active on its day."""
    found = url_filter.filter_captures(captures(spark, d), list_entries(table(spark, d, "pages")))
    return found.select("page_id", "host", F.col("fetch_date").cast("string").alias("fetch_date"), "blocked", "n_lists", "first_list")


_HOST = (r"regexp_replace(regexp_replace(regexp_replace(regexp_extract(lower(url), '^[ \t]*https?://([^/?#]*)', 1), "
         r"'^.*@', ''), ':[0-9]*$', ''), '\.$', '')")
ORACLE["op5_url_filter"] = f"""
WITH c AS (
  SELECT page_id, nullif({_HOST}, '') AS host,
         CAST(DATE '{FIRST_DAY}' + CAST(((page_id % {DAYS}) + {DAYS}) % {DAYS} AS INTEGER) AS DATE) AS fetch_date FROM pages),
h AS (SELECT host, CAST('0x' || substr(md5(host), 1, 6) AS BIGINT) AS k FROM (SELECT DISTINCT host FROM c WHERE host IS NOT NULL)),
raw AS (
  SELECT 'hosts' AS list_name, host AS domain, unnest([k % 120, k % 120 + (10 + k % 40), k % 120 + (10 + k % 40) * (k % 4)]) AS n,
         unnest(['add', 'remove', 'add']) AS action FROM h WHERE k % 3 = 0
  UNION ALL
  SELECT 'domains', domain, 60 + max(k) % 100, 'add'
  FROM (SELECT regexp_extract(host, '([^.]*\\.[^.]*)$', 1) AS domain, k FROM h) WHERE contains(domain, '.') GROUP BY domain),
day AS (SELECT list_name, domain, CAST(DATE '{FIRST_DAY}' + CAST(n AS INTEGER) AS DATE) AS valid_from, bool_or(action = 'add') AS is_on
        FROM raw GROUP BY ALL),
iv AS (SELECT *, coalesce(lead(valid_from) OVER (PARTITION BY list_name, domain ORDER BY valid_from), DATE '9999-12-31') AS valid_to FROM day),
hit AS (
  SELECT c.page_id, count(DISTINCT iv.list_name) AS n, min(iv.list_name) AS first_list
  FROM c JOIN iv ON iv.is_on AND c.fetch_date >= iv.valid_from AND c.fetch_date < iv.valid_to
   AND (c.host = iv.domain OR (ends_with(c.host, '.' || iv.domain) AND contains(iv.domain, '.')))
  GROUP BY c.page_id)
SELECT c.page_id, c.host, CAST(c.fetch_date AS VARCHAR) AS fetch_date, hit.page_id IS NOT NULL AS blocked, coalesce(hit.n, 0) AS n_lists, hit.first_list
FROM c LEFT JOIN hit USING (page_id)"""

# ------------------------------------------------------------------ 6


@query
def op6_repeats(spark, d):
    """Bytes of repeated passages that go from every document."""
    return repeats.remove_repeats(table(spark, d, "documents")).drop("spans")


# ------------------------------------------------------------------ 7


@query
def op7_exact_dedup(spark, d):
    """Groups of equal normalised texts over all documents."""
    return exact_dedup.dedup_exact(table(spark, d, "documents"))


ORACLE["op7_exact_dedup"] = """
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM n WINDOW g AS (PARTITION BY text_sha256)"""

# ------------------------------------------------------------------ 8


@query
def op8_mixing(spark, d):
    """Words that the mix takes of every document."""
    plan = mixing.mix_documents(table(spark, d, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken",
                       F.coalesce(F.get("copies", F.lit(0))["position"], F.lit(-1.0)).alias("first_position"))


def mix_sql(docs: str, seed: int = 17) -> str:
    """Common table expressions ending in ``mixed``: doc_id, source, size, source_size, weight, target, quota, place."""
    return f"""
sized AS (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM {docs}),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM sized GROUP BY source),
filled AS (SELECT *, 3.0 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / weight AS fill FROM ranked),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM ranked) - coalesce(sum(cap) OVER (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY fill, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM filled),
targets AS (
  SELECT source, source_size, weight, least(CAST(cap AS DOUBLE), weight * (SELECT max(level) FROM levels WHERE fill >= level)) AS target FROM levels),
mixed AS (
  SELECT s.*, t.source_size, t.weight, t.target, CAST(round(t.target) AS BIGINT) AS quota,
         CAST(coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)"""


def _start_end() -> tuple[str, str]:
    return tuple("CASE weight " + " ".join(f"WHEN {i + 1} THEN {s[j]}" for i, s in enumerate(mixing.SCHEDULES)) + " END" for j in (0, 1))


_A, _B = _start_end()
_TAKE = "greatest(least(size, quota - (source_size * {e} + place)), 0)"
ORACLE["op8_mixing"] = f"""
WITH {mix_sql('documents')},
p AS (SELECT *, {' + '.join(_TAKE.format(e=e) for e in range(3))} AS taken, {_A} AS a, {_B} AS b,
             least(CAST(place AS DOUBLE) / greatest(quota, 1), 1.0) AS q, {_TAKE.format(e=0)} AS t0 FROM mixed)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN t0 > 0 THEN q * (a + b) / (a + sqrt(a * a + (b * b - a * a) * q)) ELSE -1.0 END AS first_position
FROM p"""

# ------------------------------------------------------------------ 9


@query
def op9_language_id(spark, d):
    """Predicted language of every document, learned from the labels that are not held out."""
    docs = table(spark, d, "documents")
    return language_id.identify(docs, language_id.fit(docs))


# ------------------------------------------------------------------ 10


@query
def op10_quality_rules(spark, d):
    """Line labels, base rules and verdict for every document."""
    docs = table(spark, d, "documents")
    return quality_crf.apply_rules(docs, quality_crf.fit(docs, table(spark, d, "labels")))


# ------------------------------------------------------------------ 11


@query
def op11_ranked_search(spark, d):
    """The ten best documents for every benchmark item."""
    return ball_search.search(table(spark, d, "documents"), table(spark, d, "benchmark"))


def _terms_sql(rows: str, key: str) -> str:
    return f"""SELECT r, {key}, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM (SELECT *, row_number() OVER () AS r FROM {rows})"""


ORACLE["op11_ranked_search"] = f"""
WITH tf AS MATERIALIZED (SELECT r, doc_id, term, count(*) AS tf FROM ({_terms_sql('documents', 'doc_id')}) GROUP BY ALL),
lengths AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * (SELECT docs FROM total) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf GROUP BY term),
q AS (SELECT r AS item, item_id, term, count(*) AS repeats FROM ({_terms_sql('benchmark', 'item_id')}) GROUP BY ALL),
scores AS (
  SELECT item, item_id, tf.r, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN lengths ON lengths.r = tf.r, total GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""

# ------------------------------------------------------------------ 12


@query
def op12_merkle_manifest(spark, d):
    """Manifest of all documents, folded back from rows of which every seventh or so is tampered with."""
    return merkle.manifest(table(spark, d, "documents"), merkle.every_seventh())


#: Tree levels that the SQL spells out: enough for a million leaves a language and as many languages.
SQL_LEVELS = 20
_CRC = """list_reduce(list_concat([4294967295::BIGINT], flatten([[(ascii(x) >> b) & 1 for b in range(8)] for x in string_split(CAST(doc_id AS VARCHAR), '')])),
       lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))"""


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _tree_sql(name: str, level: int) -> str:
    """Nodes one level up: pairs hashed together, a last one alone, a finished tree unchanged."""
    return f"""{name}{level + 1} AS (
  SELECT tree, pos // 2 AS pos, (max(n) + 1) // 2 AS n, max(n) > 1 AS live,
         CASE WHEN max(n) > 1 THEN sha256(string_agg(node, '' ORDER BY pos)) ELSE max(node) END AS node
  FROM {name}{level} GROUP BY tree, pos // 2)"""


def _levels_sql(half: int, name: str) -> str:
    return " UNION ALL ".join(f"SELECT {half} AS half, {k} AS k, tree, pos, node FROM {name}{k}" for k in range(SQL_LEVELS))


ORACLE["op12_merkle_manifest"] = f"""
WITH rows AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql('n_chars')} AS node,
         CASE WHEN xor({_CRC}, 4294967295) % 7 = 0 THEN {_leaf_sql('n_chars + 1')} END AS read FROM documents),
u0 AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM rows),
{', '.join(_tree_sql('u', k).replace(' AS (', ' AS MATERIALIZED (', 1) for k in range(SQL_LEVELS))},
t0 AS MATERIALIZED (
  SELECT '' AS tree, tree AS lang, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, node FROM u{SQL_LEVELS}),
{', '.join(_tree_sql('t', k).replace(' AS (', ' AS MATERIALIZED (', 1) for k in range(SQL_LEVELS))},
lv AS ({_levels_sql(0, 'u')} UNION ALL {_levels_sql(1, 't')}),
need AS (
  SELECT r.tree AS in_tree, r.pos AS in_pos, 0 AS half, k, r.tree, r.pos >> k AS place FROM u0 r, range({SQL_LEVELS}) s(k) WHERE (r.n - 1) >> k > 0
  UNION ALL
  SELECT r.tree, r.pos, 1, k, '', t.pos >> k FROM u0 r JOIN t0 t ON t.lang = r.tree, range({SQL_LEVELS}) s(k) WHERE (t.n - 1) >> k > 0),
sides AS (
  SELECT in_tree, in_pos, list(CASE WHEN lv.node IS NULL THEN '' WHEN lv.pos < place THEN 'L' || lv.node ELSE 'R' || lv.node END ORDER BY need.half, need.k) AS path
  FROM need LEFT JOIN lv ON lv.half = need.half AND lv.k = need.k AND lv.tree = need.tree AND lv.pos = xor(place, 1) GROUP BY in_tree, in_pos),
paths AS (
  SELECT r.doc_id, r.node, r.read, t.node AS subroot, (SELECT node FROM t{SQL_LEVELS}) AS root, coalesce(path, []) AS path
  FROM u0 r JOIN t0 t ON t.lang = r.tree LEFT JOIN sides ON in_tree = r.tree AND in_pos = r.pos),
folded AS (
  SELECT *, list_reduce(list_concat([coalesce(read, node)], path), lambda h, s:
         CASE WHEN s[1] = 'L' THEN sha256(s[2:] || h) ELSE sha256(h || s[2:]) END) AS folded_root FROM paths)
SELECT doc_id, node AS leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified FROM folded"""

# ------------------------------------------------------------------ 13


@query
def op13_toxicity(spark, d):
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = table(spark, d, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, d, "labels")))
