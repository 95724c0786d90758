"""Queries over page extraction and crawl bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import extraction as X
from .catalog import query
from .normalize import sql_finish
from .q_articles import sql_strip
from .views import (LISTING_PAGES, SOURCE_NAMES, TICKERS, listing_items, name_dictionary, pages_table, table,
                    with_views)

_LINK_RE = '<a href="([^"]*)"'


@query("page_links", sql_finish(f"""
SELECT page_id, pos - 1 AS pos, href,
       CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '//%' THEN 'https:' || href
            ELSE regexp_extract(url, '^(https?://[^/]+)', 1) || href END AS url
FROM (
  SELECT page_id, url, unnest(regexp_extract_all(html, '{_LINK_RE}', 1)) AS href,
         generate_subscripts(regexp_extract_all(html, '{_LINK_RE}', 1), 1) AS pos
  FROM pages
)""", {"page_id": "i", "pos": "i", "href": "s", "url": "s"}))
def page_links(spark, sf_dir):
    """Links of every stored page in page order, made absolute."""
    return X.page_links(pages_table(spark, sf_dir))


def _sql_unescape(e: str) -> str:
    for a, b in X.ENTITIES:
        b = b.replace("'", "''")
        e = f"replace({e}, '{a}', '{b}')"
    return e


def _sql_node_text(e: str) -> str:
    return sql_strip(_sql_unescape(f"regexp_replace({e}, '<[^>]*>', '', 'g')"))


_CLEAN_HTML = "regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>', '', 'g'), '(?is)<style\\b.*?</style>', '', 'g')"
_EXTRACT_SQL = sql_finish(f"""
SELECT page_id, ticker, title, content, published_date FROM (
  SELECT page_id,
         CASE page_id % 5 {' '.join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TICKERS))} END AS ticker,
         {_sql_node_text("regexp_extract(body, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS title,
         array_to_string(list_filter(list_transform(
             (regexp_split_to_array(body, '(?i)<p(?:\\s[^>]*)?>'))[2:],
             lambda x: {_sql_node_text("regexp_split_to_array(x, '(?i)</p>')[1]")}), lambda x: x <> ''), ' ') AS content,
         CAST(NULL AS VARCHAR) AS published_date
  FROM (SELECT page_id, regexp_extract({_CLEAN_HTML}, '(?is)<article[^>]*>(.*?)</article>', 1) AS body FROM pages)
) WHERE length(title) > 0""", {"page_id": "i", "ticker": "s", "title": "s", "content": "s", "published_date": "s"})


@query("page_extract", _EXTRACT_SQL)
def page_extract(spark, sf_dir):
    """Title + paragraph text of each stored page (X7-X9), normalised like add_item
    (X13), tagged with a ticker (X14), title required (X11)."""
    pages = pages_table(spark, sf_dir)
    ex = X.extract_article(pages).withColumn("date", F.lit(None).cast("date")).withColumn(
        "ticker", F.element_at(F.array(*[F.lit(t) for t in TICKERS]), (F.col("page_id") % 5 + 1).cast("int")))
    ex = X.normalize_item(ex).withColumn("source", F.lit("VnExpress"))
    ex = X.title_required(ex, ["VnExpress"])
    return ex.select("page_id", "ticker", "title", "content", "published_date")


# ---------------------------------------------------------------- X1/X2 crawl frontier
def _keywords(spark, sf_dir):
    return name_dictionary(spark, sf_dir).select("ticker", F.col("name").alias("keyword"))


_MAX_PAGES = 8
# Written out by hand, not taken from the operator's table: a wrong template there must show.
_PROFILE_ROWS = """
  ('VnExpress', 'https://timkiem.vnexpress.net/?q=', '&page=', 1, '', 1, TRUE),
  ('ThanhNien', 'https://thanhnien.vn/timelinesearch/', '/', 1, '.htm?sort=0', 1, FALSE),
  ('VnEconomy', 'https://vneconomy.vn/tim-kiem.html?Text=', '&page=', 1, '', 1, FALSE),
  ('Vietnamnet', NULL, NULL, 1, '', 0, FALSE),
  ('CafeF', 'https://cafef.vn/tim-kiem.chn?keywords=', '&page=', 1, '', 1, FALSE),
  ('Vietstock', NULL, NULL, 1, '', 1, FALSE),
  ('FireAnt', 'https://restv2.fireant.vn/posts?symbol=', '&type=1&limit=20&offset=', 20, '', 0, FALSE)"""


@query("crawl_frontier", sql_finish(with_views(["names"], f"""
SELECT k.ticker, k.keyword, p.source, pg AS page,
       CASE WHEN p.source = 'Vietnamnet' THEN 'https://vietnamnet.vn/tim-kiem-p' || pg || '?q=' || k.keyword || '&od=2'
            WHEN p.source = 'Vietstock' THEN 'https://finance.vietstock.vn/View/PagingNewsContent'
            ELSE p.before || CASE WHEN p.source IN ('VnEconomy', 'FireAnt') THEN replace(url_encode(k.keyword), '%20', '+') ELSE k.keyword END || p.between || pg * p.step || p.after END AS url
FROM (SELECT ticker, name AS keyword FROM names) k
CROSS JOIN (VALUES {_PROFILE_ROWS}) AS p(source, before, between, step, after, first_page, cap5)
CROSS JOIN LATERAL (SELECT unnest(range(p.first_page,
                    p.first_page + CASE WHEN p.cap5 THEN least({_MAX_PAGES}, 5) ELSE {_MAX_PAGES} END)) AS pg)
"""), {"ticker": "s", "keyword": "s", "source": "s", "page": "i", "url": "s"}))
def crawl_frontier(spark, sf_dir):
    """Every (ticker, keyword, source, page) search task with its URL; MAX_PAGES = 8."""
    return X.crawl_frontier(_keywords(spark, sf_dir), _MAX_PAGES)


@query("vietstock_forms", sql_finish(with_views(["names"], f"""
SELECT ticker, name AS keyword, pg AS page, '1' || '|' || name || '|1|01/01/2022|02/12/2025|-1|' || pg || '|20|token-' || ticker AS form
FROM names CROSS JOIN (SELECT unnest(range(1, {_MAX_PAGES + 1})) AS pg)"""),
    {"ticker": "s", "keyword": "s", "page": "i", "form": "s"}))
def vietstock_forms(spark, sf_dir):
    """The POST bodies of Vietstock's search, all fields in order."""
    tasks = X.crawl_frontier(_keywords(spark, sf_dir), _MAX_PAGES).where("source = 'Vietstock'")
    forms = X.vietstock_form(tasks, "2025-12-02", F.concat(F.lit("token-"), "ticker"))
    return forms.select("ticker", "keyword", "page", F.array_join(F.map_values("form"), "|").alias("form"))


# ---------------------------------------------------------------- X5 / X10 / X11 (no listing date)
_NO_DATE = [s[0] for s in X.SOURCES if not s[5]]
_WITH_DATE = [s[0] for s in X.SOURCES if s[5]]
_K = "ticker, keyword, source"


@query("seen_urls", sql_finish(with_views(["raw_articles", "items"], f"""
SELECT ticker, keyword, source, page, pos, url FROM (
  SELECT *, row_number() OVER (PARTITION BY {_K}, url ORDER BY page, pos) AS rk
  FROM items WHERE source IN ({', '.join(f"'{s}'" for s in _NO_DATE)})
) WHERE rk = 1 AND (year IS NULL OR year >= 2022)"""),
    {"ticker": "s", "keyword": "s", "source": "s", "page": "i", "pos": "i", "url": "s"}))
def seen_urls(spark, sf_dir):
    """First occurrence per URL within a crawl run (X5), then the detail-page year
    filter with unparsed dates passing (X10). None of these sources asks for a title (X11)."""
    items = listing_items(spark, sf_dir).filter(F.col("source").isin(_NO_DATE))
    kept = X.first_seen(items)
    kept = X.detail_year_filter(kept.withColumn("date", F.try_to_date("published_date", "yyyy-MM-dd")))
    return kept.select("ticker", "keyword", "source", "page", "pos", "url")


# ---------------------------------------------------------------- X5 + X6 (listing date), unrolled per page
def _stop_sql(pages: list[int]) -> str:
    ctes = []
    src = ", ".join(f"'{s}'" for s in _WITH_DATE)
    ctes.append(f"it AS (SELECT * FROM items WHERE source IN ({src}) AND (source <> 'FireAnt' OR length(coalesce(title, '')) > 0))")
    for i, p in enumerate(pages):
        seen_prev = f"seen{i}" if i > 0 else None
        fresh = (f"SELECT * FROM it WHERE page = {p}" if seen_prev is None else
                 f"SELECT it.* FROM it WHERE page = {p} AND NOT EXISTS (SELECT 1 FROM {seen_prev} s "
                 f"WHERE s.ticker = it.ticker AND s.keyword = it.keyword AND s.source = it.source AND s.url = it.url)")
        ctes.append(f"fresh{i} AS ({fresh})")
        ctes.append(f"""firsts{i} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_K}, url ORDER BY pos) AS rk FROM fresh{i}) WHERE rk = 1)""")
        ctes.append(f"stop{i} AS (SELECT {_K}, min(pos) AS sp FROM firsts{i} WHERE year < 2022 GROUP BY {_K})")
        ctes.append(f"""kept{i} AS (
  SELECT f.ticker, f.keyword, f.source, f.page, f.pos, f.url FROM firsts{i} f
  LEFT JOIN stop{i} s ON f.ticker = s.ticker AND f.keyword = s.keyword AND f.source = s.source
  WHERE s.sp IS NULL OR f.pos < s.sp)""")
        marks = f"""SELECT DISTINCT it.ticker, it.keyword, it.source, it.url FROM it
  LEFT JOIN stop{i} s ON it.ticker = s.ticker AND it.keyword = s.keyword AND it.source = s.source
  WHERE it.page = {p} AND (s.sp IS NULL OR it.pos <= s.sp)"""
        if seen_prev is None:
            ctes.append(f"seen{i + 1} AS ({marks})")
        else:
            ctes.append(f"seen{i + 1} AS (SELECT * FROM {seen_prev} UNION SELECT * FROM ({marks}))")
    body = " UNION ALL ".join(f"SELECT * FROM kept{i}" for i in range(len(pages)))
    return with_views(["raw_articles", "items"], body, extra=",\n".join(ctes))


@query("stop_at_old", sql_finish(_stop_sql(LISTING_PAGES),
                                 {"ticker": "s", "keyword": "s", "source": "s", "page": "i", "pos": "i", "url": "s"}))
def stop_at_old(spark, sf_dir):
    """Sources with a listing date: seen-URL filter fused with stop-at-first-old-item (X5 + X6).
    Untitled FireAnt posts are skipped before they count as seen (X11)."""
    items = listing_items(spark, sf_dir).filter(F.col("source").isin(_WITH_DATE))
    out = X.stop_at_old(X.title_required(items, ["FireAnt"]))
    return out.select("ticker", "keyword", "source", "page", "pos", "url")


# ---------------------------------------------------------------- X12 / F16
@query("embedded_json", sql_finish("""
SELECT event_id, CAST(json_extract_string(doc, '$.props.pageProps.k') AS BIGINT) AS k,
       coalesce(nullif(json_extract_string(doc, '$.props.pageProps.content'), ''),
                json_extract_string(doc, '$.props.pageProps.description')) AS body
FROM (
  SELECT event_id,
         '{"props": {"pageProps": {"k": ' || CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR)
         || ', "content": "' || CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END
         || '", "description": "' || user_id || '"}}}' AS doc
  FROM events
)""", {"event_id": "i", "k": "i", "body": "s"}))
def embedded_json(spark, sf_dir):
    """A script body holding page JSON: nested path lookup, content else description."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    content = F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.col("event_type"))
    doc = F.concat(F.lit('{"props": {"pageProps": {"k": '), k.cast("string"), F.lit(', "content": "'), content,
                   F.lit('", "description": "'), F.col("user_id").cast("string"), F.lit('"}}}'))
    d = e.select("event_id", doc.alias("doc"))
    return d.select(
        "event_id", X.json_path(F.col("doc"), "$.props.pageProps.k").cast("bigint").alias("k"),
        X.post_text(X.json_path(F.col("doc"), "$.props.pageProps.content"),
                    X.json_path(F.col("doc"), "$.props.pageProps.description")).alias("body"),
    )


@query("api_posts", sql_finish("""
SELECT event_id // 20 AS page, event_id % 20 AS pos, event_id AS post_id, event_type AS title,
       'https://fireant.vn/bai-viet/' || event_id AS url, strftime(ts, '%Y-%m-%d') AS published_date, year(ts) AS year,
       CASE WHEN event_id % 3 = 0 THEN 'd' || user_id ELSE 'a & b' || chr(10) || user_id END AS content
FROM events WHERE event_id % 7 <> 0""",
    {"page": "i", "pos": "i", "post_id": "i", "title": "s", "url": "s", "published_date": "s", "year": "i", "content": "s"}))
def api_posts(spark, sf_dir):
    """Posts of API replies of 20 (built from the events): exploded, untitled ones skipped, HTML
    content as lines, else the description (X11, X12)."""
    e = table(spark, sf_dir, "events")
    post = F.struct(F.col("event_id").alias("postID"), F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("title"),
                    F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
                    F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("<p>a &amp; b</p><p>"), F.col("user_id").cast("string"), F.lit("</p>"))).alias("content"),
                    F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("description"))
    replies = e.groupBy(F.floor(F.col("event_id") / 20).alias("page")).agg(F.to_json(F.array_sort(F.collect_list(post))).alias("body"))
    return X.api_posts(replies)


@query("reply_json", sql_finish("""
SELECT conv_id, turn, block IS NOT NULL AS has_json,
       coalesce(json_valid(block) AND json_extract_string(block, '$.alpha_1') IS NOT NULL, false) AS parsed,
       CASE WHEN json_valid(block) THEN json_extract_string(block, '$.alpha_1') END AS alpha_1
FROM (
  SELECT conv_id, turn,
         nullif(regexp_extract(reply, '(?s)\\{.*\\}', 0), '') AS block
  FROM (
    SELECT conv_id, turn,
           CASE WHEN turn % 4 = 3 THEN text
                ELSE 'Here you go:' || chr(10) || '{"alpha_1": "' || regexp_replace(text, '[\\x00-\\x1f"\\\\]', ' ', 'g')
                     || '",' || chr(10) || ' "n": ' || CAST(length(text) AS VARCHAR) || '}' || chr(10) || 'done.' END AS reply
    FROM conversations
  )
)""", {"conv_id": "i", "turn": "i", "has_json": "b", "parsed": "b", "alpha_1": "s"}))
def reply_json(spark, sf_dir):
    """Model replies with a JSON object inside prose: greedy {...} across lines, then
    parse; no braces → NULL (F16). Every 4th turn carries no JSON at all."""
    c = table(spark, sf_dir, "conversations")
    body = F.concat(F.lit('{"alpha_1": "'),
                    F.regexp_replace("text", '[\\x00-\\x1f"\\\\]', " "),
                    F.lit('",\n "n": '), F.length("text").cast("string"), F.lit("}"))
    reply = F.when(F.col("turn") % 4 == 3, F.col("text")).otherwise(
        F.concat(F.lit("Here you go:\n"), body, F.lit("\ndone.")))
    block = T.json_block(reply)
    parsed = F.from_json(block, "alpha_1 string, n long")
    return c.select("conv_id", "turn", block.isNotNull().alias("has_json"),
                    parsed["alpha_1"].isNotNull().alias("parsed"), parsed["alpha_1"].alias("alpha_1"))
