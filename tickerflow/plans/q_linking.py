"""Queries over the ticker map, the dictionary scan, entity spans, the linking
cascade and the relation counts (F11-F12, U3, A15, S5, J2-J7, W12, P18-P20, F18, A9-A13)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import articles as A
from ..operators import linking as L
from ..operators import relations as R
from ..operators import tickermap as M
from ..operators.common import stored
from .catalog import query
from .normalize import sql_finish
from .q_articles import CLEAN_CTE, sql_strip
from .views import (derived_aliases, listing, name_dictionary, name_mentions, raw_articles, target_of, tokens,
                    with_views)


def _sql_clean_name(e: str) -> str:
    out = f"coalesce({e}, '')"
    for p in M.LEGAL_PREFIXES:
        out = f"regexp_replace({out}, '(?i){p}', '', 'g')"
    return sql_strip(out)


def _values(pairs) -> str:
    rows = ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(pairs))
    return f"(VALUES {rows}) AS v(i, name, ticker)"


_OK = "{n} IS NOT NULL AND {n} <> ticker AND length({n}) > 1"
TMAP_CTE = f"""
lb AS (
  SELECT row_order, nullif(symbol, '') AS ticker, nullif(organ_name, '') AS full_name,
         nullif(organ_short_name, '') AS short_name
  FROM listing
),
lc AS (
  SELECT *, {_sql_clean_name('short_name')} AS cs, {_sql_clean_name('full_name')} AS cf
  FROM lb WHERE ticker IS NOT NULL
),
le AS (
  SELECT row_order * 4 AS seq, short_name AS name, ticker FROM lc WHERE {_OK.format(n='short_name')}
  UNION ALL
  SELECT row_order * 4 + 1, cs, ticker FROM lc
  WHERE {_OK.format(n='short_name')} AND length(cs) > 2 AND cs <> ticker AND cs <> short_name
  UNION ALL
  SELECT row_order * 4 + 2, full_name, ticker FROM lc WHERE {_OK.format(n='full_name')}
  UNION ALL
  SELECT row_order * 4 + 3, cf, ticker FROM lc
  WHERE {_OK.format(n='full_name')} AND length(cf) > 2 AND cf <> ticker AND cf <> full_name
),
lm AS (SELECT name, min(seq) AS ord, arg_max(ticker, seq) AS ticker FROM le GROUP BY name),
um AS (
  SELECT ord AS seq, name, ticker FROM lm
  UNION ALL
  SELECT (SELECT coalesce(max(ord), -1) FROM lm) + 1 + i, name, ticker FROM {_values(M.CUSTOM_NAMES)}
),
tmap AS (SELECT name, min(seq) AS ord, arg_max(ticker, seq) AS ticker FROM um GROUP BY name)"""


def _tmap(spark, sf_dir):
    return M.build_ticker_map(listing(spark, sf_dir), "row_order", M.names_frame(spark, M.CUSTOM_NAMES))


@query("ticker_map_build", sql_finish(with_views(["listing"], "SELECT ord, name, ticker FROM tmap", extra=TMAP_CTE),
                                      {"ord": "i", "name": "s", "ticker": "s"}))
def ticker_map_build(spark, sf_dir):
    """Listing → ordered name map (F11, F12, P15), custom names applied on top."""
    return _tmap(spark, sf_dir)


@query("ticker_map_first", sql_finish(with_views(["listing"], """
SELECT t.ord, t.name, t.ticker, CAST(t.ord = w.o AS BIGINT) AS kept, w.first_name
FROM tmap t JOIN (SELECT ticker, min(ord) AS o, arg_min(name, ord) AS first_name FROM tmap GROUP BY ticker) w
  ON t.ticker = w.ticker""", extra=TMAP_CTE), {"ord": "i", "name": "s", "ticker": "s", "kept": "i",
                                               "first_name": "s"}))
def ticker_map_first(spark, sf_dir):
    """First name per ticker kept, the rest reported as removed."""
    out = M.first_name_per_ticker(_tmap(spark, sf_dir))
    return out.withColumn("kept", F.col("kept").cast("long"))


# ---------------------------------------------------------------- dictionary scan

def _scan_names(spark, sf_dir):
    """The name dictionary plus two-letter short keys (every 7th name's first two
    letters) so the word-boundary rule of short keys is exercised."""
    names = _dictionary(spark, sf_dir)
    short = names.filter(F.col("ord") % 7 == 0).select(
        (F.col("ord") + 1).alias("ord"), F.lower(F.substring("name", 1, 2)).alias("name"), "ticker")
    return names.unionByName(short)


SCAN_CTE = CLEAN_CTE + f""",
scan_names AS (
  SELECT ord, name, ticker FROM names
  UNION ALL
  SELECT ord + 1, lower(substr(name, 1, 2)), ticker FROM names WHERE ord % 7 = 0
),
keys AS (SELECT {sql_strip('lower(name)')} AS key, arg_max(ticker, ord) AS ticker FROM scan_names GROUP BY 1),
txt AS (
  SELECT arrival, ticker AS target, lower(coalesce(title, '') || '. ' || coalesce(content, '')) AS text FROM clean
),
words AS (
  SELECT DISTINCT arrival, target, unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+')) AS w FROM txt
),
hits AS (
  SELECT txt.arrival, txt.target, keys.ticker
  FROM txt JOIN keys ON length(keys.key) >= 3 AND contains(txt.text, keys.key)
  WHERE keys.ticker <> txt.target
  UNION ALL
  -- a short key made of word characters matches on word boundaries exactly when
  -- it equals one of the text's maximal word-character runs
  SELECT words.arrival, words.target, keys.ticker
  FROM words JOIN keys ON length(keys.key) < 3 AND keys.key = words.w
  WHERE keys.ticker <> words.target
),
scan AS (
  SELECT txt.arrival, txt.target AS ticker,
         coalesce(array_to_string(list_sort(list_distinct(list(h.ticker) FILTER (WHERE h.ticker IS NOT NULL))), ','), '')
           AS related,
         count(DISTINCT h.ticker) AS n_related
  FROM txt LEFT JOIN hits h ON txt.arrival = h.arrival AND txt.target = h.target
  GROUP BY txt.arrival, txt.target
)"""


def _scan(spark, sf_dir):
    keys = M.normalized_keys(_scan_names(spark, sf_dir))
    clean = A.clean_articles(raw_articles(spark, sf_dir))
    return L.dictionary_scan(clean, keys)


@query("dictionary_scan", sql_finish(
    with_views(["raw_articles", "names"], "SELECT arrival, ticker, related, n_related FROM scan", extra=SCAN_CTE),
    {"arrival": "i", "ticker": "s", "related": "s", "n_related": "i"}))
def dictionary_scan(spark, sf_dir):
    """Every dictionary key found in lower(title + '. ' + content), short keys on word
    boundaries; sorted, comma-joined tickers without the article's own (S5, J7, F13, A13, F15)."""
    s = _scan(spark, sf_dir)
    return s.select("arrival", "ticker", T.join_tickers(F.col("related")).alias("related"),
                    F.size("related").alias("n_related"))


@query("relations_topk", sql_finish(with_views(["raw_articles", "names"], """
SELECT target, related, n, rk, CAST(rk <= 10 AS BIGINT) AS in_top10, n_distinct FROM (
  SELECT target, related, n, row_number() OVER (PARTITION BY target ORDER BY n DESC, related) AS rk,
         count(*) OVER (PARTITION BY target) AS n_distinct
  FROM (SELECT target, ticker AS related, count(*) AS n FROM (SELECT DISTINCT arrival, target, ticker FROM hits)
        GROUP BY 1, 2)
) WHERE rk <= 20""", extra=SCAN_CTE), {"target": "s", "related": "s", "n": "i", "rk": "i", "in_top10": "i",
                                       "n_distinct": "i"}))
def relations_topk(spark, sf_dir):
    """Articles per related ticker within each target; top-20 map, top-10 list."""
    s = _scan(spark, sf_dir)
    counts = R.related_counts(s, target="ticker", related="related")
    return R.top_related(counts).select("target", "related", "n", "rk",
                                        (F.col("rk") <= 10).cast("long").alias("in_top10"), "n_distinct")


# ---------------------------------------------------------------- spans and validity
_TOK_CTE = """
tok0 AS (
  SELECT doc_id AS article_id, unnest(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+')) AS raw,
         generate_subscripts(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), 1) - 1 AS pos
  FROM documents
),
tok AS (
  SELECT article_id, pos, regexp_replace(raw, '[^\\p{L}\\p{N}]', '', 'g') AS word FROM tok0
),
acc AS (
  SELECT article_id, pos, word, pos - row_number() OVER (PARTITION BY article_id ORDER BY pos) AS g
  FROM tok WHERE word <> '' AND regexp_matches(word, '^\\p{Lu}')
),
spans AS (
  SELECT article_id, min(pos) AS start, string_agg(word, ' ' ORDER BY pos) AS entity FROM acc GROUP BY article_id, g
)"""

_NOISE = " OR ".join(f"contains(lower(entity), '{w}')" for w in L.NOISE_WORDS)
_BLACK = ", ".join(f"'{w}'" for w in L.BLACKLIST)
_VALID_CTE = _TOK_CTE + f""",
valid AS (
  SELECT * FROM spans
  WHERE length(entity) >= 3 AND NOT ({_NOISE})
    AND NOT regexp_matches(translate(entity, ' /-.,', ''), '^\\p{{Nd}}+$')
    AND {sql_strip('lower(entity)')} NOT IN ({_BLACK})
)"""


def _spans(spark, sf_dir):
    return L.spans(tokens(spark, sf_dir, accepted_only=True))


@query("entity_spans", sql_finish(with_views([], "SELECT article_id, start, entity FROM spans", extra=_TOK_CTE),
                                  {"article_id": "i", "start": "i", "entity": "s"}))
def entity_spans(spark, sf_dir):
    """Runs of accepted tags over whole documents merged into entity text."""
    return _spans(spark, sf_dir)


@query("entity_valid", sql_finish(with_views([], "SELECT article_id, start, entity FROM valid", extra=_VALID_CTE),
                                  {"article_id": "i", "start": "i", "entity": "s"}))
def entity_valid(spark, sf_dir):
    """Spans passing the validity rules (P20)."""
    sp = _spans(spark, sf_dir)
    return sp.filter(L.valid_entity(F.col("entity")))


# ---------------------------------------------------------------- cascade steps
def _targets_sql() -> str:
    cases = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(["BID", "FPT", "VIC", "VJC", "VNM"]))
    return f"SELECT doc_id AS article_id, CASE doc_id % 5 {cases} END AS target FROM documents"


def _token_sorted(c: str) -> str:
    return f"array_to_string(list_sort(string_split_regex({sql_strip(c)}, '\\s+')), ' ')"


_ALIAS_ROWS = ", ".join(f"('{a}', {('NULL' if t is None else repr(t))})" for a, t in L.ALIASES)
_CASCADE_CTE = _VALID_CTE + f""",
mentions AS (
  SELECT article_id, entity FROM valid
  UNION ALL
  SELECT article_id, entity FROM name_mentions
  WHERE length(entity) >= 3 AND NOT ({_NOISE})
    AND NOT regexp_matches(translate(entity, ' /-.,', ''), '^\\p{{Nd}}+$')
    AND {sql_strip('lower(entity)')} NOT IN ({_BLACK})
),
pairs AS (
  SELECT DISTINCT v.entity, t.target, {sql_strip('lower(v.entity)')} AS el
  FROM mentions v JOIN ({_targets_sql()}) t ON v.article_id = t.article_id
),
all_alias AS (
  SELECT alias, ticker FROM aliases
  UNION ALL
  SELECT alias, ticker FROM (VALUES {_ALIAS_ROWS}) AS f(alias, ticker)
  WHERE alias NOT IN (SELECT alias FROM aliases)
),
s_alias AS (SELECT p.entity, p.target, a.ticker FROM pairs p JOIN all_alias a ON p.el = a.alias),
s1 AS (SELECT * FROM pairs WHERE el NOT IN (SELECT alias FROM all_alias)),
ex AS (SELECT lower(name) AS ln, arg_min(ticker, ord) AS ticker FROM names GROUP BY 1),
s_exact AS (SELECT s1.entity, s1.target, ex.ticker FROM s1 JOIN ex ON s1.el = ex.ln),
s2 AS (SELECT * FROM s1 WHERE el NOT IN (SELECT ln FROM ex)),
s_sub AS (
  SELECT entity, target, arg_min(ticker, ord) AS ticker FROM (
    SELECT s2.entity, s2.target, n.ticker, n.ord FROM s2 JOIN names n
      ON length(s2.entity) >= 10 AND length(n.name) >= 15 AND n.ticker <> s2.target
         AND (contains(s2.el, lower(n.name)) OR contains(lower(n.name), s2.el))
  ) GROUP BY entity, target
),
s3 AS (SELECT s2.* FROM s2 LEFT JOIN s_sub USING (entity, target) WHERE s_sub.ticker IS NULL),
-- token-sorted texts; pairs of near lengths that share enough bigrams; their LCS by one row of the table for each character
es AS (SELECT DISTINCT entity, {_token_sorted('entity')} AS x FROM s3),
ns AS (SELECT {_token_sorted('name')} AS y, min(ord) AS ord, arg_min(ticker, ord) AS ticker FROM names GROUP BY 1),
eg AS (SELECT x, unnest(list_transform(range(1, length(x)), lambda i: substr(x, i, 2))) AS g FROM (SELECT DISTINCT x FROM es)),
eg2 AS (SELECT x, g, count(*) AS n FROM eg GROUP BY x, g),
ng AS (SELECT y, unnest(list_transform(range(1, length(y)), lambda i: substr(y, i, 2))) AS g FROM ns),
ng2 AS (SELECT y, g, count(*) AS n FROM ng GROUP BY y, g),
near AS MATERIALIZED (
  SELECT x, y, string_split(x, '') AS xs, string_split(y, '') AS ys FROM eg2 JOIN ng2 USING (g)
  WHERE 200 * least(length(x), length(y)) >= 90 * (length(x) + length(y))
  GROUP BY x, y HAVING sum(least(eg2.n, ng2.n)) >= greatest(length(x), length(y)) - 1 - 2 * floor((length(x) + length(y)) * 0.1 + 1e-9)
),
lcs(x, y, xs, ys, i, best) AS (
  SELECT x, y, xs, ys, CAST(0 AS BIGINT), list_transform(ys, lambda c: CAST(0 AS BIGINT)) FROM near
  UNION ALL
  SELECT x, y, xs, ys, i + 1, list_transform(range(1, len(ys) + 1), lambda j: list_max(cell[1:j])) FROM (
    SELECT x, y, xs, ys, i, list_transform(range(1, len(ys) + 1),
      lambda j: greatest(best[j], CASE WHEN ys[j] = xs[i + 1] THEN coalesce(best[j - 1], 0) + 1 ELSE 0 END)) AS cell
    FROM lcs WHERE i < len(xs))
),
scored AS (SELECT x, y, 200.0 * best[len(ys)] / (len(xs) + len(ys)) AS score FROM lcs WHERE i = len(xs)),
best AS (SELECT x, arg_max(ticker, (score, -ord)) AS ticker FROM scored JOIN ns USING (y) WHERE score >= 90 GROUP BY x),
s_fuzzy AS (SELECT s3.entity, s3.target, b.ticker FROM s3 JOIN es USING (entity) JOIN best b USING (x)),
s_direct AS (
  SELECT s3.entity, s3.target, upper(s3.entity) AS ticker FROM s3
  WHERE upper(s3.entity) IN (SELECT ticker FROM names)
)"""


def _dictionary(spark, sf_dir):
    """The name dictionary, written once to the shared checkpoint folder: it feeds
    many joins of one plan, and re-deriving it per reference would repeat its scan."""
    return stored(name_dictionary(spark, sf_dir), "names")


def _resolved_steps(spark, sf_dir, steps=L.STEPS):
    names = _dictionary(spark, sf_dir)
    aliases = derived_aliases(names)
    fixed = L.alias_frame(spark).join(aliases.select("alias"), "alias", "left_anti")
    # the target is a function of the article id: no join against the documents.
    # Mentions feed the distinct pairs and the final join back: written once to the
    # shared checkpoint folder instead of tokenising every document per branch.
    spans = L.spans(tokens(spark, sf_dir, accepted_only=True)).select("article_id", "entity")
    mentions = stored(spans.unionByName(name_mentions(names)).filter(L.valid_entity(F.col("entity"))).withColumn(
        "target", target_of("article_id")), "mentions")
    return L.resolve(mentions, names, aliases.unionByName(fixed), steps=steps), mentions


def _step_query(step: str, sql_body: str):
    @query(f"link_{step}", sql_finish(with_views(["names", "aliases", "name_mentions"], sql_body, extra=_CASCADE_CTE, recursive=True),
                                      {"entity": "s", "target": "s", "ticker": "s"}))
    def run(spark, sf_dir):
        res, _ = _resolved_steps(spark, sf_dir, (step,))
        return res.select("entity", "target", "ticker")

    run.__doc__ = f"Distinct (entity, target) pairs resolved by the {step} step."
    return run


for _step, _body in [
    ("alias", "SELECT entity, target, ticker FROM s_alias WHERE ticker IS NOT NULL AND ticker <> target"),
    ("exact", "SELECT entity, target, ticker FROM s_exact WHERE ticker <> target"),
    ("substring", "SELECT entity, target, ticker FROM s_sub"),
    ("fuzzy", "SELECT entity, target, ticker FROM s_fuzzy WHERE ticker <> target"),
    ("direct", "SELECT entity, target, ticker FROM s_direct WHERE ticker <> target"),
]:
    _step_query(_step, _body)


_LINKED = """
SELECT m.article_id, t.target, array_to_string(list_sort(list_distinct(list(r.ticker))), ',') AS related
FROM mentions m JOIN targets t ON m.article_id = t.article_id
JOIN (SELECT entity, target, ticker FROM s_alias UNION ALL SELECT entity, target, ticker FROM s_exact
      UNION ALL SELECT entity, target, ticker FROM s_sub UNION ALL SELECT entity, target, ticker FROM s_fuzzy
      UNION ALL SELECT entity, target, ticker FROM s_direct) r ON r.entity = m.entity AND r.target = t.target
WHERE r.ticker IS NOT NULL AND r.ticker <> t.target GROUP BY m.article_id, t.target"""


@query("link_cascade", sql_finish(with_views(["names", "aliases", "name_mentions"], _LINKED, recursive=True,
                                             extra=_CASCADE_CTE + f",\ntargets AS ({_targets_sql()})"),
                                  {"article_id": "i", "target": "s", "related": "s"}))
def link_cascade(spark, sf_dir):
    """The whole cascade per article: sorted related tickers."""
    res, mentions = _resolved_steps(spark, sf_dir)
    per = L.related_per_article(mentions, res)
    return per.select("article_id", "target", T.join_tickers(F.col("related")).alias("related"))


# ---------------------------------------------------------------- P9 articles related to one ticker
@query("related_filter", sql_finish(with_views(["raw_articles", "names"], "SELECT arrival, ticker, related FROM scan WHERE related = 'FPT'", extra=SCAN_CTE),
                                    {"arrival": "i", "ticker": "s", "related": "s"}))
def related_filter(spark, sf_dir):
    """Articles whose related tickers are exactly one given ticker."""
    s = _scan(spark, sf_dir).select("arrival", "ticker", T.join_tickers(F.col("related")).alias("related"))
    return A.filtered_by(s, related="FPT")
