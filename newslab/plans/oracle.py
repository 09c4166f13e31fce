"""Oracle SQL (DuckDB) for every deterministic query key.

Written independently of the Spark code paths: window-form splits instead
of the bucket form, a grid lookup instead of the generation loop's sweeps,
string functions instead of Java regex look-arounds.  Tables are the
pre-registered views of the supplied Parquet files.
"""

from __future__ import annotations

from newslab import schema as S
from newslab.functions.draws import draw_sql, rate_threshold
from newslab.plans import context as C

GENES = S.GENES
IG = [f"i_{g}" for g in GENES]
SEED = str(S.SEED)
POP = S.POPULATION_SIZE
GENS = S.GENERATIONS


def _lst(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def clean_sql(x: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), 'http\\S+|www\\.\\S+', ' ', 'g'), "
        f"'[^a-z]+', ' ', 'g'))"
    )


def tokens_sql(c: str) -> str:
    return f"(CASE WHEN {c} = '' THEN []::VARCHAR[] ELSE string_split({c}, ' ') END)"


def words_sql(c: str) -> str:
    return f"(CASE WHEN {c} = '' THEN 0 ELSE len(string_split({c}, ' ')) END)"


def hit_sql(c: str, words) -> str:
    return f"list_has_any({tokens_sql(c)}, {_lst(words)})"


def count_sql(c: str, words) -> str:
    return f"len(list_filter({tokens_sql(c)}, lambda t: list_contains({_lst(words)}, t)))"


def sentiment_sql(c: str, pos=C.POSITIVE, neg=C.NEGATIVE) -> tuple[str, str]:
    s = f"(CASE WHEN {hit_sql(c, pos)} THEN 'positif' WHEN {hit_sql(c, neg)} THEN 'negatif' ELSE 'netral' END)"
    conf = (
        f"(CASE WHEN {hit_sql(c, pos)} THEN {S.CONF_POSITIVE} WHEN {hit_sql(c, neg)} THEN {S.CONF_NEGATIVE} "
        f"ELSE {S.CONF_NEUTRAL} END)::DOUBLE"
    )
    return s, conf


def label_id_sql(c: str) -> str:
    return f"(CASE {c} WHEN 'negatif' THEN 0 WHEN 'netral' THEN 1 WHEN 'positif' THEN 2 END)"


def label_name_sql(c: str) -> str:
    return f"(CASE {c} WHEN 0 THEN 'negatif' WHEN 1 THEN 'netral' WHEN 2 THEN 'positif' END)"


def tickers_sql(text: str, tickers=C.TICKER_WORDS) -> str:
    parts = [
        f"CASE WHEN regexp_matches(upper(coalesce({text}, '')), '(^|[^\\pL\\pN_]){t}([^\\pL\\pN_]|$)') THEN '{t}' END"
        for t in tickers
    ]
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


def signal_sql(s: str, c: str) -> str:
    th = S.SIGNAL_THRESHOLD
    return (
        f"(CASE WHEN {s} = 'positif' AND {c} >= {th} THEN 'WATCH' WHEN {s} = 'negatif' AND {c} >= {th} "
        f"THEN 'RISK ALERT' ELSE 'MONITOR' END)"
    )


def key_sql(prefix: str = "") -> str:
    return "concat_ws('-', " + ", ".join(f"{prefix}{c}" for c in IG) + ")"

# --------------------------------------------------------------------------- base CTEs


_BASE = f"""
news_raw AS (
  SELECT d.doc_id, d.text AS judul, strftime(e.ts, '%Y-%m-%d') AS tanggal,
         CASE WHEN l.doc_id IS NULL THEN NULL
              WHEN d.doc_id % 2 = 0 THEN upper(l.lbl)
              ELSE '  ' || l.lbl || ' ' END AS sentimen,
         d.source, e.ts AS created_at
  FROM documents d
  LEFT JOIN (SELECT doc_id, CASE WHEN toxic = 1 THEN 'negatif' WHEN quality = 1 THEN 'positif' ELSE 'netral' END AS lbl
             FROM labels) l ON l.doc_id = d.doc_id
  LEFT JOIN events e ON e.event_id = d.doc_id
),
prepared AS (
  SELECT doc_id, judul AS text, tanggal AS date,
         lower(regexp_replace(sentimen, '^\\s+|\\s+$', '', 'g')) AS label, source, created_at
  FROM news_raw
),
labelled AS (
  SELECT *, {label_id_sql('label')} AS label_id FROM prepared WHERE label IN ('negatif', 'netral', 'positif')
),
cleaned AS (SELECT *, {clean_sql('text')} AS clean_text FROM labelled),
worded AS (SELECT *, {words_sql('clean_text')} AS words FROM cleaned),
news AS (
  SELECT doc_id AS news_id, text, label, label_id, clean_text, words, source, created_at
  FROM worded WHERE words >= {S.MIN_WORDS}
),
hashed AS (SELECT *, {draw_sql(SEED, 'news_id')} AS h FROM news),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, news_id) AS r,
         count(*) OVER (PARTITION BY label) AS n_label
  FROM hashed
),
split AS (
  SELECT *, CASE WHEN r * 10 <= n_label * 8 THEN 'train' WHEN r * 10 <= n_label * 9 THEN 'val' ELSE 'test' END AS split
  FROM ranked
),
proxy AS (SELECT * FROM ranked WHERE r <= greatest(1, (n_label * {S.SUBSET_FRACTION[0]}) // {S.SUBSET_FRACTION[1]})),
scored AS (
  SELECT *, {sentiment_sql('clean_text')[0]} AS sentiment, {sentiment_sql('clean_text')[1]} AS confidence
  FROM news
),
scored2 AS (SELECT *, {label_id_sql('sentiment')} AS pred_id FROM scored),
feat AS (
  SELECT *, {tickers_sql('text')} AS tickers, {signal_sql('sentiment', 'confidence')} AS signal FROM scored2
)
"""


def _vectors(src: str) -> str:
    return f"""
  SELECT label_id,
         {count_sql('clean_text', C.POSITIVE)} AS ph,
         {count_sql('clean_text', C.NEGATIVE)} AS nh,
         least(words, 7) AS wm,
         words // 100 AS lb,
         count(*) AS cnt
  FROM {src} GROUP BY ALL"""


def _grid() -> str:
    parts, names = [], []
    for k, (g, vals) in enumerate(S.SPACE):
        parts.append(f"(SELECT CAST(range AS INTEGER) AS i_{g} FROM range({len(vals)})) g{k}")
        names.append(f"i_{g}")
    return f"SELECT {key_sql()} AS cand_key, {', '.join(names)} FROM " + " CROSS JOIN ".join(parts)


def _metrics_select(src: str) -> str:
    n = [f"(c{i}0 + c{i}1 + c{i}2)" for i in range(3)]
    p = [f"(c0{j} + c1{j} + c2{j})" for j in range(3)]
    tp = [f"c{i}{i}" for i in range(3)]
    tot = f"({n[0]} + {n[1]} + {n[2]})"
    prec = " + ".join(f"{n[c]} * (CASE WHEN {p[c]} > 0 THEN {tp[c]} / {p[c]} ELSE 0.0 END)" for c in range(3))
    f1 = " + ".join(
        f"{n[c]} * (CASE WHEN {n[c]} + {p[c]} > 0 THEN ({tp[c]} * 2) / ({n[c]} + {p[c]}) ELSE 0.0 END)" for c in range(3)
    )
    acc = f"({tp[0]} + {tp[1]} + {tp[2]})"
    return f"""SELECT *, {tot} AS n,
         CASE WHEN {tot} > 0 THEN {acc} / {tot} END AS accuracy,
         CASE WHEN {tot} > 0 THEN ({prec}) / {tot} END AS precision,
         CASE WHEN {tot} > 0 THEN {acc} / {tot} END AS recall,
         CASE WHEN {tot} > 0 THEN ({f1}) / {tot} END AS f1
  FROM {src}"""


def _counts(src: str, y: str, yhat: str, by: str = "", weight: str = "1") -> str:
    cols = ", ".join(
        f"CAST(sum(CASE WHEN {y} = {i} AND {yhat} = {j} THEN {weight} ELSE 0 END) AS BIGINT) AS c{i}{j}"
        for i in range(3) for j in range(3)
    )
    sel_by = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return f"SELECT {sel_by}{cols} FROM {src}{grp}"


def _sweep(cands: str, vectors: str) -> str:
    g = {name: f"c.i_{name}" for name in GENES}
    s = f"(v.ph * ({g['learning_rate']} + 1) - v.nh * ({g['batch_size']} + 1))"
    m = f"({g['lora_dropout']} * v.lb)"
    pred = (
        f"CASE WHEN v.wm < {g['weight_decay']} * 2 + 3 THEN 1 WHEN {s} > {g['lora_rank']} + {m} THEN 2 "
        f"WHEN -{s} > {g['lora_alpha']} + {m} THEN 0 ELSE 1 END"
    )
    pairs = f"(SELECT c.cand_key, v.label_id, v.cnt, {pred} AS pred FROM {cands} c CROSS JOIN {vectors} v)"
    counts = _counts(pairs, "label_id", "pred", "cand_key", "cnt")
    allc = f"(SELECT c.cand_key, {', '.join('c.' + x for x in IG)}, " + ", ".join(
        f"coalesce(k.c{i}{j}, 0) AS c{i}{j}" for i in range(3) for j in range(3)
    ) + f" FROM {cands} c LEFT JOIN ({counts}) k ON k.cand_key = c.cand_key)"
    met = _metrics_select(allc)
    return f"""SELECT cand_key, {', '.join(IG)}, n, accuracy, precision, recall,
         CASE WHEN f1 IS NULL THEN -1.0 ELSE f1 END AS fitness, CAST(n AS DOUBLE) AS rows_scored,
         CASE WHEN f1 IS NULL THEN 'empty evaluation set' END AS error
  FROM ({met})"""


def _population(gen: int, n: int, tag: str) -> str:
    genes = ", ".join(
        f"CAST({draw_sql(SEED, str(gen), 'slot', repr(tag), repr(g))} % {len(v)} AS INTEGER) AS i_{g}"
        for g, v in S.SPACE
    )
    inner = f"SELECT slot, {genes} FROM (SELECT CAST(range AS INTEGER) AS slot FROM range({n}))"
    return f"SELECT {gen} AS gen, slot, {key_sql()} AS cand_key, {', '.join(IG)} FROM ({inner})"


def _next_gen(k: int) -> str:
    """CTEs producing pop_{k+1} from pop_{k} evaluated via the grid scores ``gs``."""
    nk = k + 1
    cut = rate_threshold(S.MUTATION_RATE)
    cx = ", ".join(
        f"CASE WHEN {draw_sql(SEED, str(nk), 'kd.slot', repr('x'), repr(g))} % 2 = 0 THEN a.i_{g} ELSE b.i_{g} END "
        f"AS i_{g}"
        for g in GENES
    )
    mut = ", ".join(
        f"CASE WHEN {draw_sql(SEED, str(nk), 'slot', repr('m'), repr(g))} < {cut} "
        f"THEN CAST({draw_sql(SEED, str(nk), 'slot', repr('v'), repr(g))} % {len(v)} AS INTEGER) ELSE i_{g} END AS i_{g}"
        for g, v in S.SPACE
    )
    return f""",
ev_{k} AS (SELECT DISTINCT p.cand_key, {', '.join('p.' + x for x in IG)}, g.fitness
           FROM pop_{k} p JOIN gs g ON g.cand_key = p.cand_key WHERE g.fitness >= 0),
rk_{k} AS (SELECT *, row_number() OVER (ORDER BY fitness DESC, cand_key) AS rk FROM ev_{k}),
np_{k} AS (SELECT greatest(count(*) // 2, 1) AS np FROM ev_{k}),
par_{k} AS (SELECT r.* FROM rk_{k} r, np_{k} WHERE r.rk <= np_{k}.np),
kids_{nk} AS (
  SELECT s.slot,
         CAST({draw_sql(SEED, str(nk), 's.slot', repr('p1'))} % np_{k}.np + 1 AS INTEGER) AS r1,
         CAST({draw_sql(SEED, str(nk), 's.slot', repr('p2'))} % np_{k}.np + 1 AS INTEGER) AS r2
  FROM (SELECT CAST(range AS INTEGER) AS slot FROM range(1, {POP})) s, np_{k}),
cx_{nk} AS (SELECT kd.slot, {cx} FROM kids_{nk} kd JOIN par_{k} a ON a.rk = kd.r1 JOIN par_{k} b ON b.rk = kd.r2),
mut_{nk} AS (SELECT slot, {mut} FROM cx_{nk}),
raw_{nk} AS (SELECT 0 AS slot, {', '.join(IG)} FROM rk_{k} WHERE rk = 1
             UNION ALL SELECT slot, {', '.join(IG)} FROM mut_{nk}),
pop_{nk} AS (SELECT {nk} AS gen, slot, {key_sql()} AS cand_key, {', '.join(IG)} FROM raw_{nk})"""


def _search() -> str:
    chain = "".join(_next_gen(k) for k in range(1, GENS))
    pops = " UNION ALL ".join(f"SELECT * FROM pop_{k}" for k in range(1, GENS + 1))
    valid = "(SELECT * FROM trials WHERE fitness >= 0)"
    effects = " UNION ALL ".join(f"SELECT '{c}' AS gene, {c} AS value, avg(fitness) AS effect FROM {valid} GROUP BY {c}" for c in IG)
    guess = " + ".join(f"coalesce((SELECT effect FROM effects WHERE gene = '{c}' AND value = p.{c}), "
                       f"(SELECT avg(fitness) FROM {valid}), 0.0)" for c in IG)
    return f""",
vec_proxy AS ({_vectors('proxy')}),
vec_full AS ({_vectors('news')}),
grid AS ({_grid()}),
gs AS ({_sweep('grid', 'vec_proxy')}),
gs_full AS ({_sweep('grid', 'vec_full')}),
pop_1 AS ({_population(1, POP, 'init')}){chain},
pops AS ({pops}),
firsts AS (SELECT cand_key, min(gen) AS gen FROM pops GROUP BY cand_key),
trials AS (SELECT f.cand_key, f.gen, {', '.join('g.' + x for x in IG)}, g.fitness, g.accuracy, g.precision,
                  g.recall, g.n, g.rows_scored, g.error
           FROM firsts f JOIN gs g ON g.cand_key = f.cand_key),
glog_base AS (
  SELECT p.gen, count(DISTINCT CASE WHEN t.gen = p.gen THEN p.cand_key END) AS new_evals, count(*) AS slots,
         max(CASE WHEN t.fitness >= 0 THEN t.fitness END) AS best
  FROM pops p LEFT JOIN trials t ON t.cand_key = p.cand_key GROUP BY p.gen),
gcost AS (SELECT gen, sum(rows_scored) AS rows_scored FROM trials GROUP BY gen),
glog AS (SELECT b.gen, b.new_evals, b.slots - b.new_evals AS cache_hits, coalesce(b.best, -1.0) AS best_f1,
                coalesce(c.rows_scored, 0.0) AS rows_scored
         FROM glog_base b LEFT JOIN gcost c ON c.gen = b.gen),
top3 AS (
  SELECT cand_key, {', '.join(IG)}, fitness, row_number() OVER (ORDER BY fitness DESC, cand_key) AS proxy_rank
  FROM (SELECT cand_key, {', '.join(IG)}, max(fitness) AS fitness FROM trials WHERE fitness >= 0 GROUP BY ALL)
  ORDER BY fitness DESC, cand_key LIMIT 3),
pool_3 AS ({_population(3, S.SURROGATE_POOL, 'pool')}),
pool_d AS (SELECT * FROM pool_3 QUALIFY row_number() OVER (PARTITION BY cand_key ORDER BY slot) = 1),
effects AS ({effects}),
screened AS (SELECT p.cand_key, round(({guess}) / {len(IG)}, 12) AS predicted FROM pool_d p),
topk5 AS (SELECT * FROM screened ORDER BY predicted DESC, cand_key LIMIT {S.SURROGATE_TOPK})"""


def _default_key() -> str:
    return "-".join(str(i) for i in S.default_indices())


def _headlines() -> str:
    """Items (<li> with its first link) and the page heading (<h1> with the first link of the body).

    States the rule for the markup of the supplied pages, where items are not nested.
    """
    def text(x):
        x = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
        for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
            x = f"replace({x}, '{ent}', '{ch}')"
        return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"

    def href(x):
        return f"regexp_extract({x}, '(?is)<a\\s[^>]*?href=\"([^\"]*)\"', 1)"

    scheme = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)"
    auth = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
    host = f"regexp_extract({auth}, '^(?:[^@]*@)?([^:]*)', 1)"

    def link(h):
        return f"CASE WHEN starts_with({h}, '/') THEN {scheme} || '://' || {auth} || {h} ELSE {h} END"

    item = "(?is)<li(?:\\s[^>]*)?>(.*?)</li>"
    h1 = "regexp_extract(html, '(?is)<h1(?:\\s[^>]*)?>(.*?)</h1>', 1)"
    anchor = "regexp_extract(part, '(?is)<a(?:\\s[^>]*)?>(.*?)</a>', 1)"
    return f""",
linked AS (SELECT page_id, {href('html')} AS href, {link(href('html'))} AS link FROM pages),
items AS (SELECT page_id, url, unnest(regexp_extract_all(html, '{item}', 1)) AS part,
                 unnest(range(1, len(regexp_extract_all(html, '{item}', 1)) + 1)) AS pos FROM pages),
heads AS (
  SELECT * FROM (
    SELECT page_id, 0 AS pos, {text(h1)} AS title, {link(href('html'))} AS url, {host} AS source FROM pages
    WHERE contains(html, '<h1') AND {href('html')} <> ''
    UNION ALL
    SELECT page_id, CAST(pos AS INTEGER), {text(anchor)}, {link(href('part'))}, {host} FROM items
    WHERE contains(part, '<a ') AND {href('part')} <> '' AND pos < {S.MAX_CONTAINERS})
  WHERE title <> '' AND length(title) > {C.MIN_TITLE}),
heads_dedup AS (SELECT * FROM heads QUALIFY row_number() OVER (PARTITION BY title ORDER BY page_id, pos) = 1),
heads_cap AS (SELECT * FROM heads_dedup QUALIFY row_number() OVER (PARTITION BY source ORDER BY page_id, pos) <= {S.ITEMS_PER_SOURCE})"""


def with_ctes(body: str, search: bool = False, headlines: bool = False) -> str:
    ctes = _BASE + (_search() if search else "") + (_headlines() if headlines else "")
    return f"WITH {ctes}\n{body}"

# --------------------------------------------------------------------------- queries


def _metric_long(src: str) -> str:
    return (f"SELECT 'accuracy' AS metric, accuracy AS value FROM {src} UNION ALL SELECT 'precision', precision FROM {src} "
            f"UNION ALL SELECT 'recall', recall FROM {src} UNION ALL SELECT 'f1', f1 FROM {src}")


def _oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    ig = ", ".join(IG)
    q["news_etl_summary"] = with_ctes(
        "SELECT label, count(*) AS documents, sum(words) AS total_words FROM news GROUP BY ROLLUP (label)")
    q["scan_csv_roundtrip"] = with_ctes("SELECT doc_id, judul, tanggal, sentimen FROM news_raw")
    q["scan_csv_tolerant"] = with_ctes("""
SELECT doc_id, judul, sentimen, NULL AS record FROM news_raw
UNION ALL SELECT NULL, NULL, NULL, 'x' || doc_id || ',' || source FROM documents WHERE doc_id % 10 = 0""")
    q["sql_label_counts"] = with_ctes("SELECT label, count(*) AS count FROM news GROUP BY label ORDER BY count DESC")
    q["label_distribution"] = with_ctes("SELECT label, count(*) AS n FROM news GROUP BY label")
    q["total_words"] = with_ctes(
        "SELECT CAST(coalesce(sum(words), 0) AS BIGINT) AS total_words, count(*) AS documents FROM news")
    q["news_prepare"] = with_ctes("SELECT doc_id, text, date, label, label_id FROM labelled")
    q["label_encode_decode"] = with_ctes(
        f"SELECT label, label_id, {label_name_sql('label_id')} AS label_back, count(*) AS n FROM labelled GROUP BY ALL")
    q["clean_text"] = with_ctes(
        f"SELECT doc_id, {clean_sql('text')} AS clean_text, {words_sql(clean_sql('text'))} AS words FROM documents")
    q["word_count"] = with_ctes(f"SELECT doc_id, {words_sql(clean_sql('text'))} AS words FROM documents")
    q["min_words"] = with_ctes("SELECT news_id, words FROM news")
    q["split_records"] = with_ctes("SELECT news_id, clean_text AS text, label_id AS labels, split FROM split")
    q["stratified_split"] = with_ctes("SELECT news_id, label, split FROM split")
    q["stratified_subset"] = with_ctes("SELECT news_id, label FROM proxy")
    f0, f1 = S.SUBSET_FRACTION
    q["stratified_subset_rounded"] = with_ctes(f"""
SELECT news_id, label FROM (
  SELECT *, (n_label * {f0}) // {f1} AS q, (n_label * {f0}) % {f1} AS rem FROM ranked)
WHERE r <= q + CASE WHEN rem * 2 > {f1} OR (rem * 2 = {f1} AND q % 2 = 1) THEN 1 ELSE 0 END""")
    q["dataset_profile"] = with_ctes(
        "SELECT split, label, GROUPING(split, label) AS gid, count(*) AS n FROM split "
        "GROUP BY GROUPING SETS ((split), (label), (split, label), ())")
    q["confusion"] = with_ctes("SELECT label_id AS y, pred_id AS yhat, count(*) AS n FROM scored2 GROUP BY ALL")
    split_scored = "(SELECT s.*, c.pred_id FROM split s JOIN scored2 c ON c.news_id = s.news_id)"
    q["weighted_metrics"] = with_ctes(
        f"SELECT split, n, accuracy, precision, recall, f1 FROM ({_metrics_select('(' + _counts(split_scored, 'label_id', 'pred_id', 'split') + ')')})")
    ma = f"({_metrics_select('(' + _counts('(SELECT * FROM ' + split_scored + ' WHERE split = ' + chr(39) + 'train' + chr(39) + ')', 'label_id', 'pred_id') + ')')})"
    mb = f"({_metrics_select('(' + _counts('(SELECT * FROM ' + split_scored + ' WHERE split = ' + chr(39) + 'test' + chr(39) + ')', 'label_id', 'pred_id') + ')')})"
    q["compare_runs"] = with_ctes(f"""
SELECT coalesce(a.metric, b.metric) AS metric, a.value AS a, b.value AS b,
       CASE WHEN b.value <> 0 THEN a.value / b.value END AS ratio, a.value - b.value AS delta
FROM ({_metric_long(ma)}) a FULL OUTER JOIN ({_metric_long(mb)}) b ON a.metric = b.metric""")
    q["lexicon_semi"] = with_ctes(
        f"SELECT news_id, {count_sql('clean_text', C.POSITIVE)} AS pos_hits, {count_sql('clean_text', C.NEGATIVE)} "
        f"AS neg_hits FROM news WHERE {hit_sql('clean_text', C.POSITIVE + C.NEGATIVE)}")
    q["lexicon_large_join"] = with_ctes(f"""
SELECT DISTINCT news_id, label FROM (SELECT news_id, label, unnest({tokens_sql('clean_text')}) AS word FROM news)
WHERE word IN (SELECT unnest({tokens_sql(clean_sql('text'))}) FROM benchmark)""")
    q["lexicon_sentiment"] = with_ctes("SELECT news_id, sentiment, confidence FROM scored")
    q["detect_tickers"] = with_ctes(f"SELECT doc_id, {tickers_sql('text')} AS tickers FROM documents")
    words = "regexp_extract_all(upper(coalesce(text, '')), '[\\pL\\pN_]+')"
    q["detect_names"] = f"""
WITH names AS (SELECT item_id AS ord, 'item-' || item_id AS code, ' ' || array_to_string({words}[1:3], ' ') || ' ' AS name FROM benchmark),
texts AS (SELECT row_number() OVER () AS r, doc_id, ' ' || array_to_string({words}, ' ') || ' ' AS t FROM documents),
found AS (SELECT r, list(code ORDER BY ord) AS names FROM texts JOIN names ON name <> '  ' AND contains(t, name) GROUP BY r)
SELECT doc_id, coalesce(names, []::VARCHAR[]) AS names FROM texts LEFT JOIN found USING (r)"""
    q["sentiment_signal"] = with_ctes(
        f"SELECT news_id, sentiment, confidence, {signal_sql('sentiment', 'confidence')} AS signal FROM scored")
    bp = "CAST(round(confidence * 10000) AS BIGINT)"
    pct = f"CAST({bp} // 100 AS VARCHAR) || '.' || lpad(CAST({bp} % 100 AS VARCHAR), 2, '0') || '%'"
    q["alert_text"] = with_ctes(
        "SELECT news_id, 'News Alert' || chr(10) || 'Tickers: ' || "
        "CASE WHEN len(tickers) = 0 THEN 'Not detected' ELSE array_to_string(tickers, ', ') END || chr(10) || "
        f"'Sentiment: ' || sentiment || chr(10) || 'Confidence: ' || {pct} || chr(10) || "
        "'Experimental Signal: ' || signal || chr(10) || 'News: ' || text AS alert FROM feat")
    q["softmax_argmax"] = with_ctes("""
SELECT vec_id, pred_id, CASE pred_id WHEN 0 THEN 'negatif' WHEN 1 THEN 'netral' WHEN 2 THEN 'positif' END AS sentiment,
       CAST(round(pmax * 1e9) AS BIGINT) AS confidence_e9
FROM (
  SELECT vec_id, list_position(p, list_max(p)) - 1 AS pred_id, list_max(p) AS pmax
  FROM (
    SELECT vec_id, list_transform(e, lambda x: x / (e[1] + e[2] + e[3])) AS p
    FROM (SELECT vec_id, list_transform(l, lambda x: exp(x - list_max(l))) AS e
          FROM (SELECT vec_id, list_transform(embedding[1:3], lambda x: CAST(x AS DOUBLE)) AS l FROM embeddings))))""")
    q["news_features"] = with_ctes("SELECT news_id, tickers, sentiment, confidence, signal FROM feat")
    dom = "(SELECT * FROM (VALUES (0, 'positif'), (1, 'netral'), (2, 'negatif')) t(ord, sentiment))"
    q["sentiment_counts_filled"] = with_ctes(
        f"SELECT d.ord, d.sentiment, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM {dom} d "
        "LEFT JOIN (SELECT sentiment, count(*) AS n FROM feat GROUP BY sentiment) c ON c.sentiment = d.sentiment")
    q["dashboard_stats"] = with_ctes(
        "SELECT count(*) FILTER (WHERE sentiment = 'positif') AS positif, count(*) FILTER (WHERE sentiment = 'negatif') "
        "AS negatif, count(*) FILTER (WHERE sentiment = 'netral') AS netral, count(*) AS total FROM feat")
    per = ("(SELECT ticker, sentiment, count(*) AS n, min(news_id) AS s FROM "
           "(SELECT news_id, unnest(tickers) AS ticker, sentiment FROM feat) GROUP BY ALL)")
    q["ticker_dominant"] = with_ctes(f"""
SELECT ticker, sentiment AS dominant, n AS dominant_n, mentions, first_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY n DESC, sentiment) AS rk,
         sum(n) OVER (PARTITION BY ticker) AS mentions, min(s) OVER (PARTITION BY ticker) AS first_seq
  FROM {per}) WHERE rk = 1""")
    q["ticker_sentiments"] = with_ctes(
        f"SELECT ticker, sentiment, n, s AS first_seq, min(s) OVER (PARTITION BY ticker) AS ticker_first_seq FROM {per}")
    q["ticker_sentiment_pages"] = with_ctes(f"""
SELECT ticker, (place - 1) // 1000 AS page, list(sentiment ORDER BY place) AS sentiments FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY news_id NULLS FIRST, sentiment) AS place
  FROM (SELECT news_id, unnest(tickers) AS ticker, sentiment FROM feat)) GROUP BY 1, 2""")
    q["market_briefing"] = with_ctes(f"""
SELECT 'total' AS section, 0 AS ord, 'total' AS key, CAST(count(*) AS VARCHAR) AS value FROM feat
UNION ALL
SELECT 'sentiment', d.ord + 1, d.sentiment, CAST(coalesce(c.n, 0) AS VARCHAR) FROM {dom} d
  LEFT JOIN (SELECT sentiment, count(*) AS n FROM feat GROUP BY sentiment) c ON c.sentiment = d.sentiment
UNION ALL
SELECT 'ticker', row_number() OVER (ORDER BY first_seq, ticker), ticker, sentiment FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY n DESC, sentiment) AS rk,
         min(s) OVER (PARTITION BY ticker) AS first_seq FROM {per}) WHERE rk = 1
UNION ALL
SELECT 'ticker', 1, 'none', 'No ticker detected' WHERE NOT EXISTS (SELECT 1 FROM feat WHERE len(tickers) > 0)""")
    q["daily_sentiment"] = with_ctes("""
SELECT strftime(created_at, '%Y-%m-%d') AS day,
       count(*) FILTER (WHERE sentiment = 'positif') AS positif,
       count(*) FILTER (WHERE sentiment = 'netral') AS netral,
       count(*) FILTER (WHERE sentiment = 'negatif') AS negatif
FROM scored GROUP BY 1""")
    recent = f"(SELECT news_id, created_at, sentiment FROM scored ORDER BY created_at DESC NULLS LAST, news_id DESC LIMIT {S.RECENT_ROWS})"
    q["recent_news"] = with_ctes(f"SELECT * FROM {recent}")
    q["recent_from_store"] = q["recent_news"]
    q["dashboard_read"] = with_ctes(f"""
SELECT *, count(*) FILTER (WHERE sentiment = 'positif') OVER () AS positif,
          count(*) FILTER (WHERE sentiment = 'negatif') OVER () AS negatif,
          count(*) FILTER (WHERE sentiment = 'netral') OVER () AS netral,
          count(*) OVER () AS total
FROM {recent}""")
    q["encode_tokens"] = _encode_sql()

    # listings
    q["headlines_from_pages"] = with_ctes("SELECT * FROM heads", headlines=True)
    q["resolve_links"] = with_ctes("SELECT page_id, href, link FROM linked", headlines=True)
    q["dedup_titles"] = with_ctes("SELECT * FROM heads_dedup", headlines=True)
    q["cap_per_source"] = with_ctes("SELECT * FROM heads_cap", headlines=True)
    q["json_posts"] = with_ctes(f"""
SELECT conv_id, pos, title, url FROM (
  SELECT * FROM (
    SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos,
           coalesce(text, '') AS title,
           '{S.JSON_LINK_PREFIX}' || '/c/' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS url
    FROM conversations)
  WHERE length(title) > {S.JSON_MIN_TITLE}
  QUALIFY row_number() OVER (PARTITION BY title ORDER BY conv_id, pos) = 1)
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos) <= {S.ITEMS_PER_SOURCE}""")
    q["json_posts_drift"] = f"""
SELECT conv_id, pos, title, url FROM (
  SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos, coalesce(text, '') AS title,
         '{S.JSON_LINK_PREFIX}' || CASE WHEN conv_id % 5 = 0 THEN '/c/' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) ELSE '' END AS url
  FROM conversations) WHERE conv_id % 5 IN (0, 2) AND length(title) > {S.JSON_MIN_TITLE}"""
    s_t, c_t = sentiment_sql(clean_sql("title"))
    q["ingest_score_store"] = with_ctes(f"""
SELECT h.page_id, h.pos, h.title, h.url, h.source, {s_t} AS sentiment, {c_t} AS confidence,
       '[' || upper({s_t}) || '] ' || h.title AS badge, e.ts AS created_at, strftime(e.ts, '%Y-%m-%d') AS date
FROM heads_cap h LEFT JOIN events e ON e.event_id = h.page_id""", headlines=True)
    q["sink_news_roundtrip"] = with_ctes(
        "SELECT news_id AS seq, sentiment, confidence, created_at, strftime(created_at, '%Y-%m-%d') AS date FROM scored")

    q["stream_ingest_dedup"] = with_ctes("SELECT * FROM heads_dedup", headlines=True)
    q["stream_daily_sentiment"] = with_ctes(
        "SELECT strftime(created_at, '%Y-%m-%d') AS day, sentiment, count(*) AS n FROM scored GROUP BY ALL")

    # search
    def qs(body):
        return with_ctes(body, search=True)

    q["population_init"] = qs(f"SELECT p.slot, p.cand_key, {', '.join('p.' + x for x in IG)}, g.fitness "
                              "FROM pop_1 p JOIN gs g ON g.cand_key = p.cand_key")
    q["candidate_key"] = qs(f"SELECT gen, slot, cand_key, {ig} FROM pops")
    feats = ", ".join(
        [f"i_{g} / {max(len(v) - 1, 1)} AS f{k}" for k, (g, v) in enumerate(S.SPACE)]
        + ["log10(lr) AS f6", "rk AS f7", "al AS f8", "al / greatest(rk, 1.0) AS f9"]
    )

    def val(gname):
        vals = dict(S.SPACE)[gname]
        return "[" + ", ".join(f"CAST('{float(v)!r}' AS DOUBLE)" for v in vals) + f"][i_{gname} + 1]"

    q["candidate_features"] = qs(
        f"SELECT cand_key, {feats}, fitness FROM (SELECT *, {val('learning_rate')} AS lr, {val('lora_rank')} AS rk, "
        f"{val('lora_alpha')} AS al FROM trials)")
    q["parents_top_half"] = qs("SELECT cand_key, fitness, rk FROM par_1")
    q["crossover"] = qs(f"SELECT slot, {key_sql()} AS cand_key, {ig} FROM cx_2")
    q["mutation"] = qs(f"SELECT slot, {key_sql()} AS cand_key, {ig} FROM mut_2")
    q["next_generation"] = qs(f"SELECT slot, cand_key, {ig} FROM pop_2")
    sw = "cand_key, n, accuracy, precision, recall, fitness"
    q["trial_sweep"] = qs(f"SELECT {sw} FROM ({_sweep('(SELECT DISTINCT cand_key, ' + ig + ' FROM pop_1)', 'vec_proxy')})")
    q["grid_sweep"] = qs(f"SELECT {sw} FROM gs_full")
    g = {name: f"c.i_{name}" for name in GENES}
    s_ = f"(v.ph * ({g['learning_rate']} + 1) - v.nh * ({g['batch_size']} + 1))"
    m_ = f"({g['lora_dropout']} * v.lb)"
    pred = (f"CASE WHEN v.wm < {g['weight_decay']} * 2 + 3 THEN 1 WHEN {s_} > {g['lora_rank']} + {m_} THEN 2 "
            f"WHEN -{s_} > {g['lora_alpha']} + {m_} THEN 0 ELSE 1 END")
    vec_lang = _vectors("(SELECT p.*, d.lang FROM news p JOIN documents d ON d.doc_id = p.news_id)").replace(
        "SELECT label_id,", "SELECT lang, label_id,")
    pairs = (f"(SELECT l.lang, c.cand_key, v.label_id, coalesce(v.cnt, 0) AS cnt, {pred} AS pred "
             f"FROM (SELECT DISTINCT lang FROM documents) l CROSS JOIN (SELECT DISTINCT cand_key, {ig} FROM pop_1) c "
             f"LEFT JOIN ({vec_lang}) v ON v.lang = l.lang)")
    met = _metrics_select("(" + _counts(pairs, "label_id", "pred", "lang, cand_key", "cnt") + ")")
    q["trial_errors"] = qs(f"""
SELECT lang, cand_key, n, CASE WHEN f1 IS NULL THEN -1.0 ELSE f1 END AS fitness,
       CASE WHEN f1 IS NULL THEN 'empty evaluation set' END AS error
FROM ({met})""")
    q["valid_trials"] = qs("SELECT cand_key, gen, fitness FROM trials WHERE fitness >= 0")
    q["best_trial"] = qs(f"SELECT cand_key, {ig}, fitness FROM trials WHERE fitness >= 0 ORDER BY fitness DESC, cand_key LIMIT 1")
    q["leaderboard"] = qs("SELECT row_number() OVER (ORDER BY fitness DESC, cand_key) AS position, cand_key, gen, fitness "
                          "FROM trials WHERE fitness >= 0")
    q["top3_distinct"] = qs("SELECT cand_key, fitness, proxy_rank FROM top3")
    q["rank_shift"] = qs("""
SELECT *, proxy_rank = 1 AND full_rank = 1 AS rank_kept FROM (
  SELECT t.cand_key, t.proxy_rank, t.fitness AS proxy_f1, g.fitness AS full_f1,
         row_number() OVER (ORDER BY g.fitness DESC, t.cand_key) AS full_rank
  FROM top3 t JOIN gs_full g ON g.cand_key = t.cand_key)""")
    q["validate_top3"] = qs(f"""
SELECT *, full_rank = 1 AS chosen, {S.FINAL_EPOCHS} AS final_epochs FROM (
  SELECT c.cand_key, c.origin, g.accuracy AS full_accuracy, g.fitness AS full_f1,
         row_number() OVER (ORDER BY g.fitness DESC, c.cand_key) AS full_rank
  FROM (SELECT cand_key, min(origin) AS origin FROM (
          SELECT cand_key, 'top3' AS origin FROM top3 UNION ALL SELECT '{_default_key()}', 'default') GROUP BY cand_key) c
  JOIN gs_full g ON g.cand_key = c.cand_key)""")
    q["best_or_default"] = qs(f"""
SELECT * FROM (
  SELECT cand_key, {ig}, fitness, false AS is_default FROM top3 WHERE proxy_rank = 1
  UNION ALL
  SELECT cand_key, {ig}, NULL::DOUBLE, true FROM grid WHERE cand_key = '{_default_key()}')
ORDER BY is_default LIMIT 1""")
    q["generation_log"] = qs(
        "SELECT gen, sum(new_evals) AS new_evals, sum(cache_hits) AS cache_hits, max(best_f1) AS best_f1, "
        "sum(rows_scored) AS rows_scored FROM glog GROUP BY ROLLUP (gen)")
    q["search_summary"] = qs(f"""
SELECT t.unique_configs, t.unique_configs * 100.0 / {S.SPACE_SIZE} AS coverage_pct,
       g.hits * 100.0 / greatest(g.generations * {POP}, 1) AS hit_rate_pct,
       g.mean_cost_per_generation, t.mean_cost_per_candidate, t.best_fitness, g.generations
FROM (SELECT count(DISTINCT cand_key) AS unique_configs, avg(CASE WHEN rows_scored > 0 THEN rows_scored END) AS mean_cost_per_candidate,
             max(CASE WHEN fitness >= 0 THEN fitness END) AS best_fitness FROM trials) t,
     (SELECT count(*) AS generations, sum(cache_hits) AS hits, avg(rows_scored) AS mean_cost_per_generation FROM glog) g""")
    w = S.WARMUP_GENERATIONS
    q["search_savings"] = qs(f"""
SELECT generations, actual_evals, actual_cost, we * generations AS estimated_evals, wc * generations AS estimated_cost,
       CASE WHEN actual_evals > 0 THEN we * generations / actual_evals END AS eval_ratio,
       CASE WHEN actual_cost > 0 THEN wc * generations / actual_cost END AS cost_ratio
FROM (SELECT count(*) AS generations, sum(new_evals) AS actual_evals, sum(rows_scored) AS actual_cost,
             avg(CASE WHEN gen <= {w} THEN new_evals END) AS we, avg(CASE WHEN gen <= {w} THEN rows_scored END) AS wc
      FROM glog)""")
    p = S.EARLY_STOP_PATIENCE
    q["early_stop"] = qs(f"""
SELECT gen, best_f1, prev_best, improved, streak, coalesce(gen = stop_gen, false) AS stop,
       coalesce(gen > stop_gen, false) AS skipped
FROM (
  SELECT *, min(CASE WHEN streak >= {p} THEN gen END) OVER () AS stop_gen FROM (
    SELECT *, sum(CASE WHEN best_f1 >= 0 AND NOT improved THEN 1 ELSE 0 END)
                OVER (PARTITION BY island ORDER BY gen ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak
    FROM (
      SELECT *, sum(CASE WHEN improved THEN 1 ELSE 0 END)
                  OVER (ORDER BY gen ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
      FROM (
        SELECT gen, best_f1, prev_best, best_f1 >= 0 AND best_f1 > prev_best AS improved FROM (
          SELECT gen, best_f1, coalesce(max(CASE WHEN best_f1 >= 0 THEN best_f1 END)
                 OVER (ORDER BY gen ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1.0) AS prev_best
          FROM glog)))))""")
    q["cache_miss_anti"] = qs(f"""
SELECT cand_key, {ig} FROM (SELECT * FROM pop_2 QUALIFY row_number() OVER (PARTITION BY cand_key ORDER BY slot) = 1) p
WHERE cand_key NOT IN (SELECT cand_key FROM trials WHERE gen < 2)""")
    q["cache_hit_join"] = qs("""
SELECT p.slot, p.cand_key, coalesce(t.gen < p.gen, false) AS hit, t.fitness,
       CASE WHEN t.gen < p.gen THEN 0.0 ELSE t.rows_scored END AS rows_scored
FROM pop_2 p LEFT JOIN trials t ON t.cand_key = p.cand_key""")
    q["distinct_candidates"] = qs(
        f"SELECT cand_key, slot, {ig} FROM pop_2 QUALIFY row_number() OVER (PARTITION BY cand_key ORDER BY slot) = 1")
    q["topk_screened"] = qs("SELECT cand_key, predicted FROM topk5")
    q["merge_evaluated"] = qs("""
SELECT * FROM (SELECT DISTINCT p.cand_key, t.fitness FROM pop_2 p JOIN trials t ON t.cand_key = p.cand_key)
UNION ALL
SELECT k.cand_key, g.fitness FROM topk5 k JOIN gs g ON g.cand_key = k.cand_key
WHERE k.cand_key NOT IN (SELECT p.cand_key FROM pop_2 p)""")
    # fitted models: keys, counts and conditions
    q["surrogate_fit"] = qs("SELECT cand_key, fitness, true AS finite FROM trials")
    q["surrogate_screen"] = qs("SELECT cand_key, cand_key IN (SELECT cand_key FROM trials) AS stored, true AS ok FROM pool_d")
    q["surrogate_calibration"] = qs(
        "SELECT p.cand_key, g.fitness, true AS ok FROM pool_d p JOIN gs g ON g.cand_key = p.cand_key WHERE g.fitness >= 0")
    q["search_run"] = qs(f"""
SELECT gen, new_evals, cache_hits, best_f1, rows_scored, true AS ok FROM glog WHERE gen <= {S.WARMUP_GENERATIONS}
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, true""")
    vec_split = _vectors("(SELECT * FROM split WHERE split IN ('val', 'test'))").replace("SELECT label_id,", "SELECT split, label_id,")
    chosen = f"(SELECT cand_key, {ig} FROM top3 UNION SELECT cand_key, {ig} FROM grid WHERE cand_key = '{_default_key()}')"
    pairs = f"(SELECT v.split, c.cand_key, v.label_id, v.cnt, {pred} AS pred FROM {chosen} c CROSS JOIN ({vec_split}) v)"
    met = _metrics_select("(" + _counts(pairs, "label_id", "pred", "split, cand_key", "cnt") + ")")
    q["final_by_split"] = qs(f"SELECT split, cand_key, n, accuracy, f1 AS fitness FROM ({met})")
    q["trial_report_json"] = qs(f"""
SELECT 'generation' AS section, gen AS ord, NULL AS cand_key, new_evals, cache_hits, best_f1 AS fitness FROM glog
UNION ALL SELECT 'top', proxy_rank, cand_key, NULL, NULL, fitness FROM top3
UNION ALL SELECT 'config', {SEED}, NULL, {POP}, {GENS}, NULL""")
    return q


def _encode_sql() -> str:
    body = f"""
SELECT n.news_id,
       (coalesce(p.ids, []::INTEGER[]) || list_transform(range({S.MAX_LENGTH}), lambda x: 0))[1:{S.MAX_LENGTH}] AS input_ids,
       (list_transform(range(len(coalesce(p.ids, []::INTEGER[]))), lambda x: 1)
          || list_transform(range({S.MAX_LENGTH}), lambda x: 0))[1:{S.MAX_LENGTH}] AS attention_mask
FROM news n LEFT JOIN (
  SELECT news_id, list(id ORDER BY pos) AS ids FROM (
    SELECT t.news_id, t.pos, CAST(v.id AS INTEGER) AS id
    FROM (SELECT news_id, unnest(t) AS word, unnest(range(len(t))) AS pos
          FROM (SELECT news_id, {tokens_sql('clean_text')} AS t FROM news)) t
    JOIN (SELECT word, row_number() OVER (ORDER BY freq DESC, word) AS id
          FROM (SELECT word, count(*) AS freq FROM (SELECT unnest({tokens_sql('clean_text')}) AS word FROM news)
                GROUP BY word)) v ON v.word = t.word
    WHERE t.pos < {S.MAX_LENGTH})
  GROUP BY news_id) p ON p.news_id = n.news_id"""
    return with_ctes(body)


ORACLE = _oracle()
