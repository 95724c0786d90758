"""Queries over article pages and listings in the markup of each news site.

The stored pages have one markup, so their titles and paragraphs are set anew in each site's own (with
decoys: scripts, captions, related boxes, other dates); listings are set from the article rows. The SQL
says what should come out and never sees the markup.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import extraction as X
from ..operators import newssites as N
from .catalog import query
from .normalize import sql_finish
from .q_pages import _CLEAN_HTML, _sql_node_text
from .views import pages_table, raw_articles, with_views

RUN_DATE = "2025-12-02"
SITES = ["VnExpress", "ThanhNien", "VnEconomy", "Vietnamnet", "CafeF", "Vietstock"]

# ---------------------------------------------------------------- article pages


def _escaped(c):
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _paragraph(p):
    """A paragraph whose first three characters are bold."""
    return F.concat(F.lit('<p class="Normal"><b>'), _escaped(F.substring(p, 1, 3)), F.lit("</b>"), _escaped(F.substr(p, F.lit(4))), F.lit("</p>"))


def site_pages(spark, sf_dir):
    """(page_id, source, html, listing_date): source by page_id % 6, day by page_id % 1600 from 2021-07-01 on. Of the sites
    with a date tag every 11th page has none and every 13th one that isn't a date; every 17th page has no title."""
    p = X.extract_article(pages_table(spark, sf_dir).select("page_id", "html"), join_with="\x00")
    d = p.select("page_id", F.element_at(F.array(*[F.lit(s) for s in SITES]), (F.col("page_id") % 6 + 1).cast("int")).alias("source"),
                 F.when(F.col("page_id") % 17 == 0, "").otherwise(F.col("title")).alias("title"),
                 F.filter(F.split("content", "\x00"), lambda x: x != "").alias("paras"),
                 F.date_add(F.lit("2021-07-01").cast("date"), (F.col("page_id") % 1600).cast("int")).alias("day"))
    shown = lambda form: F.when(F.col("page_id") % 13 == 0, F.lit("hôm nay")).otherwise(F.date_format("day", form))
    tag = lambda before, form, after: F.when(F.col("page_id") % 11 == 0, F.lit("")).otherwise(F.concat(F.lit(before), shown(form), F.lit(after)))
    title, body = _escaped(F.col("title")), F.array_join(F.transform("paras", _paragraph), "\n")
    text = lambda *parts: F.concat(F.lit('<!DOCTYPE html><html><head><title>x</title><script>var a = "<h1 class=\'title\'>no</h1>";</script></head><body><div id=top>'),
                                   *[F.lit(x) if isinstance(x, str) else x for x in parts], F.lit("<footer><p>01/01/1999</p></footer></div>"))
    html = {
        "VnExpress": text(tag('<span class="header date">Thứ hai, ', "d/M/yyyy, HH:mm", " (GMT+7)</span>"), '<h1 class="title-detail">', title, '</h1><article class="fck_detail width">', body,
                          "<figure><figcaption>caption</figcaption></figure><script>track(1)</script></article><p>below</p>"),
        "ThanhNien": text('<h1 class="detail-title"><span data-role="title">', title, "</span></h1>", tag('<div class=detail-time data-role="publishdate">', "dd/MM/yyyy HH:mm", " GMT+7</div>"),
                          '<div class="detail-content afcbc-body"><div class="detail__related"><p>related</p></div><div class="VCSortableInPreviewMode" type=Photo><p>photo<br></div>', body, "<script>x('</p>')</script></div>"),
        "VnEconomy": text(tag('<div class="date-detail"><span class=label></span><p class="date">', "HH:mm dd-MM-yyyy", "</p></div>"), '<p class="date">02/02/1998</p><h1 class="name-detail">', title,
                          '</h1><div data-x="a > b" class="ct-edtior-web news-type1">', body, "</div>"),
        "Vietnamnet": text(F.when(F.col("page_id") % 4 < 2, tag("<div class='bread-crumb-detail__time'>", "dd/MM/yyyy - HH:mm", "</div>")).otherwise(tag("<div class='publish-date'>", "d/M/yyyy", "</div>")),
                           '<h1 class="content-detail-title">', title, '</h1><div id="maincontent"><table><tr><td>cell</td></tr></table><div class="inner-article"><a href=/x>more</a></div>', body, "</div>"),
        "CafeF": text('<h1 class="title big">', title, "</h1>", tag('<span class="pdate">', "dd-MM-yyyy", " - 10:05 AM</span>"), '<div class="detail-content afcbc-body"><!-- box -->', body, "</div>"),
        "Vietstock": text('<h1 class="article-title">', title, '</h1><div id="vst_detail">', body, "</div>"),
    }
    return d.select("page_id", "source", N._by_source(F.col("source"), html).alias("html"), F.when(F.col("source") == "Vietstock", F.col("day")).alias("listing_date"))


_SITE_CASES = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SITES))
_ARTICLES_SQL = sql_finish(f"""
WITH a AS (
  SELECT page_id, CASE page_id % 6 {_SITE_CASES} END AS source, DATE '2021-07-01' + CAST(page_id % 1600 AS INTEGER) AS day,
         regexp_extract({_CLEAN_HTML}, '(?is)<article[^>]*>(.*?)</article>', 1) AS body FROM pages),
b AS (
  SELECT page_id, source, day, CASE WHEN page_id % 17 = 0 THEN '' ELSE {_sql_node_text("regexp_extract(body, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} END AS title,
         list_filter(list_transform((regexp_split_to_array(body, '(?i)<p(?:\\s[^>]*)?>'))[2:],
             lambda x: {_sql_node_text("regexp_split_to_array(x, '(?i)</p>')[1]")}), lambda x: x <> '') AS paras,
         source <> 'Vietstock' AND page_id % 11 = 0 AS absent, source <> 'Vietstock' AND page_id % 13 = 0 AS unread FROM a)
SELECT page_id, source, title,
       CASE WHEN source = 'VnExpress' THEN array_to_string(paras, ' ')
            ELSE array_to_string(list_transform(paras, lambda p: CASE WHEN length(p) > 3 THEN substr(p, 1, 3) || chr(10) || substr(p, 4) ELSE p END), chr(10) || chr(10) || chr(10)) END AS content,
       CASE WHEN absent OR (unread AND source IN ('VnExpress', 'ThanhNien')) THEN '{RUN_DATE}' WHEN NOT unread THEN strftime(day, '%Y-%m-%d') END AS published_date
FROM b
WHERE (absent OR unread OR day >= DATE '2022-01-01' OR source IN ('ThanhNien', 'Vietstock')) AND (source <> 'VnExpress' OR title <> '')
""", {"page_id": "i", "source": "s", "title": "s", "content": "s", "published_date": "s"})


@query("site_articles", _ARTICLES_SQL)
def site_articles(spark, sf_dir):
    """Title, content and date of every page in its site's own markup."""
    return N.article_fields(site_pages(spark, sf_dir), RUN_DATE).select("page_id", "source", "title", "content", "published_date")


# ---------------------------------------------------------------- listings
ITEMS = 20


def site_listings(spark, sf_dir):
    """(run, source, page, html): the articles of one source, ITEMS on a page, eight pages a run. Every 19th item has no link and
    every 23rd no readable date."""
    r = raw_articles(spark, sf_dir).where(F.col("url").isNotNull())
    n, source = F.col("arrival"), F.element_at(F.array(*[F.lit(s) for s in SITES]), (F.col("arrival") % 6 + 1).cast("int"))
    block = F.floor(n / (6 * ITEMS))
    href = F.concat(F.lit("/bai-"), (n % 997).cast("string"), F.lit(".htm?a=1&amp;b="), (n % 3).cast("string"))
    day = F.date_add(F.lit("2021-07-01").cast("date"), (n * 37 % 1600).cast("int"))
    shown = lambda form: F.when(n % 23 == 0, F.lit("vừa xong")).otherwise(F.date_format("day", form))
    link = lambda before, after: F.when(n % 19 == 0, F.lit("<span>no link</span>")).otherwise(F.concat(F.lit(before), href, F.lit(after)))
    item = {
        "VnExpress": F.concat(F.lit('<div class="item-news"><h3 class="title-news">'), link('<a data-x="1" href="https://vnexpress.net', '">t</a>'), F.lit('</h3><p>d</p><span class="time"> '), shown("dd/MM/yyyy"), F.lit(" </span></div>")),
        "ThanhNien": F.concat(F.lit('<div class="box-category-item">'), link("<a class='box-category-link-with-avatar x' href='", "'></a><a href='/other'>o</a>"), F.lit('<span class="box-time" title="'), shown("yyyy-MM-dd'T'HH:mm:ss"), F.lit('">x</span></div>')),
        "VnEconomy": F.concat(F.lit('<div class="featured-row_item"><a href="/tag">tag</a>'), link('<a class="link-layer-imt" href="', '">t</a>'), F.lit("</div>")),
        "Vietnamnet": F.concat(F.lit('<div class="horizontalPost"><a href="/img">i</a><h3 class="horizontalPost__main-title">'), link('<a href="', '">t</a>'), F.lit("</h3></div>")),
        "CafeF": F.concat(F.lit('<div class="item"><a href="/img">i</a><h3>'), link('<a href="', '">t</a>'), F.lit("</h3></div>")),
        "Vietstock": F.concat(F.lit("<tr><td>"), shown("dd/MM/yy"), F.lit(" 10:05</td><td>"), link('<a href="//finance.vietstock.vn', '">t</a>'), F.lit("</td></tr>")),
    }
    rows = r.select(block.alias("block"), source.alias("source"), n.alias("n"), day.alias("day")).withColumnRenamed("n", "arrival")
    rows = rows.select("block", "source", "arrival", N._by_source(F.col("source"), item).alias("item"))
    pages = rows.groupBy("block", "source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("arrival", "item"))), lambda x: x["item"]), "\n").alias("items"))
    before = F.when(F.col("source") == "CafeF", '<div class="timeline list-bytags">').when(F.col("source") == "Vietstock", "<table><tr><td>head</td></tr>").otherwise("<div>")
    html = F.concat(F.lit('<html><body><a href="/home">home</a><div class="item"><h3><a href="/top">top</a></h3></div>'), before, "items", F.lit("</body></html>"))
    return pages.select(F.floor(F.col("block") / 8).alias("run"), "source", (F.col("block") % 8).cast("int").alias("page"), html.alias("html"))


_HOSTS = " ".join(f"WHEN '{s}' THEN '{h}'" for s, h in [("VnExpress", "https://vnexpress.net"), ("ThanhNien", "https://thanhnien.vn"), ("VnEconomy", "https://vneconomy.vn"),
                                                       ("Vietnamnet", "https://vietnamnet.vn"), ("CafeF", "https://cafef.vn"), ("Vietstock", "https://finance.vietstock.vn")])
_LISTED_CTE = f"""
listed0 AS (
  SELECT arrival // {6 * ITEMS * 8} AS run, CASE arrival % 6 {_SITE_CASES} END AS source, (arrival // {6 * ITEMS}) % 8 AS page,
         row_number() OVER (PARTITION BY arrival // {6 * ITEMS}, arrival % 6 ORDER BY arrival) - 1 AS nth, arrival,
         '/bai-' || (arrival % 997) || '.htm?a=1&b=' || (arrival % 3) AS path, DATE '2021-07-01' + CAST(arrival * 37 % 1600 AS INTEGER) AS day
  FROM raw_articles WHERE url IS NOT NULL),
listed AS (
  SELECT run, source, page, nth + CASE WHEN source = 'Vietstock' THEN 1 ELSE 0 END AS pos, CASE source {_HOSTS} END || path AS url,
         CASE WHEN source IN ('VnExpress', 'ThanhNien', 'Vietstock') AND arrival % 23 <> 0 THEN day END AS listing_date
  FROM listed0 WHERE arrival % 19 <> 0)"""


@query("site_listing_items", sql_finish(with_views(["raw_articles"], "SELECT run, source, page, pos, url, listing_date FROM listed", extra=_LISTED_CTE),
                                        {"run": "i", "source": "s", "page": "i", "pos": "i", "url": "s", "listing_date": "dt"}))
def site_listing_items(spark, sf_dir):
    """Items of every listing page in its site's markup: place, URL and date."""
    return N.listing_items(site_listings(spark, sf_dir)).select("run", "source", "page", "pos", "url", "listing_date")


def _walk_sql() -> str:
    """The walk over the pages of a run, page by page (see stop_at_old)."""
    key = "run, source"
    same = lambda a, b: f"{a}.run = {b}.run AND {a}.source = {b}.source"
    ctes = ["it AS (SELECT run, source, page, url, min(pos) AS pos, arg_min(coalesce(year(listing_date), 9999), pos) AS year FROM listed WHERE source IN ('VnExpress', 'ThanhNien', 'Vietstock') GROUP BY ALL)"]
    for i in range(8):
        unseen = f" AND NOT EXISTS (SELECT 1 FROM seen{i} s WHERE {same('s', 'it')} AND s.url = it.url)" if i else ""
        ctes.append(f"fresh{i} AS (SELECT it.* FROM it WHERE page = {i}{unseen})")
        ctes.append(f"stop{i} AS (SELECT {key}, min(pos) AS stop FROM fresh{i} WHERE year < 2022 GROUP BY {key})")
        ctes.append(f"kept{i} AS (SELECT f.* FROM fresh{i} f LEFT JOIN stop{i} s ON {same('s', 'f')} WHERE s.stop IS NULL OR f.pos < s.stop)")
        marks = f"SELECT it.run, it.source, it.url FROM it LEFT JOIN stop{i} s ON {same('s', 'it')} WHERE it.page = {i} AND (s.stop IS NULL OR it.pos <= s.stop)"
        ctes.append(f"seen{i + 1} AS ({f'SELECT * FROM seen{i} UNION ' if i else ''}{marks})")
    return ",\n".join(ctes)


@query("site_listing_walk", sql_finish(with_views(["raw_articles"], " UNION ALL ".join(f"SELECT run, source, page, pos, url FROM kept{i}" for i in range(8)), extra=_LISTED_CTE + ",\n" + _walk_sql()),
                                       {"run": "i", "source": "s", "page": "i", "pos": "i", "url": "s"}))
def site_listing_walk(spark, sf_dir):
    """Listings of the sites with dates, read from their pages and walked until the first old item."""
    items = N.listing_items(site_listings(spark, sf_dir)).where(F.col("source").isin("VnExpress", "ThanhNien", "Vietstock"))
    return X.stop_at_old(items, keys=("run", "source")).select("run", "source", "page", "pos", "url")
