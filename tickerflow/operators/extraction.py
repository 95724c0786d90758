"""Article extraction over stored pages (pipeline stage 2, re-aimed as Spark jobs).

The fetch itself is not built: the input is a table of stored listing items and
pages. X1-X14. Per-source behaviour lives in a small ``profiles`` table (one row
per source) that is broadcast; everything else is ordinary DataFrame work.
"""

from __future__ import annotations

from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import ustrip

# The seven news sources — search URL template, first page, whether the
# page range is capped at 5, site host, listing carries a date, title required.
SOURCES = [
    # name, template ({keyword} as it is, {parameter} encoded as a form parameter), first, cap5, host, listing_date, title_required
    ("VnExpress", "https://timkiem.vnexpress.net/?q={keyword}&page={page}", 1, True, "https://vnexpress.net", True, True),
    ("ThanhNien", "https://thanhnien.vn/timelinesearch/{keyword}/{page}.htm?sort=0", 1, False, "https://thanhnien.vn", True, False),
    ("VnEconomy", "https://vneconomy.vn/tim-kiem.html?Text={parameter}&page={page}", 1, False, "https://vneconomy.vn", False, False),
    ("Vietnamnet", "https://vietnamnet.vn/tim-kiem-p{page}?q={keyword}&od=2", 0, False, "https://vietnamnet.vn", False, False),
    ("CafeF", "https://cafef.vn/tim-kiem.chn?keywords={keyword}&page={page}", 1, False, "https://cafef.vn", False, False),
    ("Vietstock", "https://finance.vietstock.vn/View/PagingNewsContent", 1, False, "https://finance.vietstock.vn", True, False),
    ("FireAnt", "https://restv2.fireant.vn/posts?symbol={parameter}&type=1&limit=20&offset={offset}", 0, False, "https://fireant.vn", True, True),
]
PAGE_CAP = 5
PAGE_ITEMS = 20  # items of a page where the search takes an offset
START_YEAR = 2022

# HTML entities decoded by the text extraction (named ones only).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
            ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SOURCES, "source string, template string, first_page int, cap5 boolean, host string, "
                 "listing_date boolean, title_required boolean")


# ---------------------------------------------------------------- X1, X2

def crawl_frontier(keywords: DataFrame, max_pages: int, sources=None) -> DataFrame:
    """Every (ticker, keyword, source, page) task with its search URL.

    ``keywords``: (ticker, keyword). Pages: first..first+n-1 with n = max_pages,
    capped at 5 pages where the source caps it. The seven source profiles are a
    literal array exploded per keyword row: a narrow map, no join.
    """
    src = sources or SOURCES
    profs = F.array(*[
        F.struct(F.lit(name).alias("source"), F.lit(tpl).alias("template"), F.lit(first).alias("first_page"),
                 F.lit(min(max_pages, PAGE_CAP) if cap5 else max_pages).alias("n"))
        for name, tpl, first, cap5, _host, _ld, _tr in src
    ])
    tasks = keywords.select("ticker", "keyword", F.explode(profs).alias("p")).select("ticker", "keyword", "p.*")
    tasks = tasks.filter(F.col("n") >= 1).withColumn(
        "page", F.explode(F.sequence(F.col("first_page"), F.col("first_page") + F.col("n") - 1)))
    url = F.replace(F.replace(F.col("template"), F.lit("{keyword}"), F.col("keyword")),
                    F.lit("{page}"), F.col("page").cast("string"))
    url = F.replace(F.replace(url, F.lit("{offset}"), (F.col("page") * PAGE_ITEMS).cast("string")), F.lit("{parameter}"), F.url_encode("keyword"))
    return tasks.select("ticker", "keyword", "source", "page", url.alias("url"))


def vietstock_form(tasks: DataFrame, run_date: Column | str, token: Column | str = "", start_year: int = START_YEAR) -> DataFrame:
    """``tasks`` (keyword, page) with the fields that Vietstock's search takes as a POST body, as ``form`` (map of texts).

    ``token`` is the verification token of the site's page for the keyword."""
    as_column = lambda v: F.lit(v) if isinstance(v, str) else v
    fields = {"view": F.lit("1"), "code": F.col("keyword"), "type": F.lit("1"), "fromDate": F.lit(f"01/01/{start_year}"),
              "toDate": F.date_format(as_column(run_date).cast("date"), "dd/MM/yyyy"), "channelID": F.lit("-1"), "page": F.col("page").cast("string"),
              "pageSize": F.lit("20"), "__RequestVerificationToken": as_column(token)}
    return tasks.withColumn("form", F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v)]))


# ---------------------------------------------------------------- X3, X4

def absolutize(href: Column, host: Column, scheme_relative: bool = True) -> Column:
    """URL absolutisation (X4): ``//x`` → ``https://x``; ``/x`` → host + ``/x``; other
    non-``http`` links get the host prefixed as written; ``http...`` unchanged."""
    out = F.when(href.startswith("http"), href)
    if scheme_relative:
        out = out.when(href.startswith("//"), F.concat(F.lit("https:"), href))
    return out.otherwise(F.concat(host, href))


def page_links(pages: DataFrame, link_re: str = '<a href="([^"]*)"') -> DataFrame:
    """Links of a listing page in page order (X3): (page_id, pos, href, url)."""
    host = F.regexp_extract("url", "^(https?://[^/]+)", 1)
    links = pages.select("page_id", host.alias("host"),
                         F.posexplode(F.regexp_extract_all("html", F.lit(link_re), 1)).alias("pos", "href"))
    return links.select("page_id", "pos", "href", absolutize(F.col("href"), F.col("host")).alias("url"))


# ---------------------------------------------------------------- X7, X8, X9

def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]*>", "")


def unescape(c: Column) -> Column:
    for a, b in ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def remove_subtrees(html: Column, tags=("script", "style")) -> Column:
    """Drop whole sub-trees before taking text (X8), e.g. scripts and styles."""
    for t in tags:
        html = F.regexp_replace(html, f"(?is)<{t}\\b.*?</{t}>", "")
    return html


def node_text(c: Column) -> Column:
    return ustrip(unescape(strip_tags(c)))


def extract_article(pages: DataFrame, container: str = "article", join_with: str = " ") -> DataFrame:
    """Field extraction from a stored detail page.

    title = text of the first ``<h1>`` in the container; content = the container's
    paragraphs (from ``<p>`` to its ``</p>``, the next ``<p>`` or the container's end; tags
    removed, entities decoded, stripped, empty ones dropped) joined by ``join_with``. Text outside
    paragraphs, such as captions, is left out.
    """
    clean = remove_subtrees(F.col("html"))
    body = F.regexp_extract(clean, f"(?is)<{container}[^>]*>(.*?)</{container}>", 1)
    title = node_text(F.regexp_extract(body, "(?is)<h1[^>]*>(.*?)</h1>", 1))
    opened = F.split(body, r"(?i)<p(?:\s[^>]*)?>")
    own = F.transform(F.slice(opened, 2, F.size(opened)), lambda x: node_text(F.get(F.split(x, "(?i)</p>"), 0)))
    paras = F.filter(own, lambda x: x != "")
    return pages.select("*", title.alias("title"), F.array_join(paras, join_with).alias("content"))


# ---------------------------------------------------------------- X5, X6, X10, X11, X13

def first_seen(items: DataFrame, keys=("ticker", "keyword", "source")) -> DataFrame:
    """Seen-URL filter for sources without a listing date (X5): the first occurrence
    of a URL in (page, pos) order survives within a crawl run."""
    k = list(keys)
    first = items.groupBy(*k, "url").agg(F.min(F.struct("page", "pos")).alias("_f"))
    return items.join(first, k + ["url"]).filter(
        (F.col("page") == F.col("_f.page")) & (F.col("pos") == F.col("_f.pos"))).drop("_f")


def _walked(batches, keys: int, start_year: int):
    """The walk over rows (keys, page, pos, url, year) sorted by keys, page and pos: one page is held at a time, and of a run
    the URLs that were marked."""
    run, page, held, seen = None, None, [], set()

    def ended():
        fresh = {}
        for r in held:
            if r[-2] not in seen:
                fresh.setdefault(r[-2], r)
        stop = min((r[-3] for r in fresh.values() if r[-1] is not None and r[-1] < start_year), default=None)
        seen.update(r[-2] for r in held if stop is None or r[-3] <= stop)
        held.clear()
        return [r for r in fresh.values() if stop is None or r[-3] < stop]

    def arrow(rows, schema):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        schema, out = batch.schema, []
        for r in zip(*[c.to_pylist() for c in batch.columns]):
            if held and (r[:keys] != run or r[keys] != page):
                out += ended()
            if r[:keys] != run:
                seen.clear()
            run, page = r[:keys], r[keys]
            held.append(r)
        if out:
            yield arrow(out, schema)
    if held and (out := ended()):
        yield arrow(out, schema)


def stop_at_old(items: DataFrame, pages: list[int] | None = None, start_year: int = START_YEAR,
                keys=("ticker", "keyword", "source"), checkpoint_every: int = 4, max_run: int = 1_000_000) -> DataFrame:
    """Seen-URL filter fused with stop-at-first-old-item (X5 + X6).

    Walking each page in ``pos`` order: a URL seen before (on an earlier page, or
    earlier on this page) is skipped; otherwise it is marked seen and, if its
    listing year < ``start_year``, the rest of the page is dropped (and not marked).

    One exchange brings the items of a run together, sorted by page and position, and one pass carries
    the marked URLs along. Runs of more than ``max_run`` items (counted first, map-side) don't
    fit one task: they go page by page in set-at-a-time steps, with the same result. ``pages`` restricts
    the walk to these pages; items without a page are left out.
    """
    from ..session import ship_package

    ship_package(items.sparkSession)
    k = list(keys)
    items = items.select(*k, "page", "pos", "url", "year").where(F.col("page").isNotNull() if pages is None else F.col("page").isin(pages))
    large = items.groupBy(*k).count().where(F.col("count") > max_run).select(*k)
    some = large.limit(1).count() > 0
    runs = items.join(large, k, "left_anti") if some else items
    runs = runs.repartition(*k).sortWithinPartitions(*k, "page", "pos", "url")
    out = runs.mapInArrow(partial(_walked, keys=len(k), start_year=start_year), runs.schema)
    return out.unionByName(_stop_by_steps(items.join(large, k, "left_semi"), start_year, k, checkpoint_every)) if some else out


def _stop_by_steps(items: DataFrame, start_year: int, k: list[str], checkpoint_every: int) -> DataFrame:
    """The walk for runs of any size, one set-at-a-time step for each page.

    Only the first occurrence of a URL on a page matters, so the items are first reduced to
    one row per (run, page, url), which combines map-side, and checkpointed. Pages
    are then processed in order (their
    count is the crawl parameter, not the data size): fresh = not seen on earlier pages (left
    anti join); the stop position = ``min(pos)`` over fresh old items per run, one row per
    run (AQE broadcasts it when its measured size is small); kept = fresh before the
    stop; marked = every item up to and including the stop. The seen set is
    checkpointed every ``checkpoint_every`` pages, which bounds the lineage.
    """
    base = items.groupBy(*k, "page", "url").agg(F.min(F.struct("pos", "year")).alias("_f")).select(
        *k, "page", F.col("_f.pos").alias("pos"), "url", F.col("_f.year").alias("year")).checkpoint()
    pages = sorted(r[0] for r in base.select("page").distinct().collect())
    seen = None
    kept = []
    for i, p in enumerate(pages):
        page = base.filter(F.col("page") == p)
        fresh = page if seen is None else page.join(seen, k + ["url"], "left_anti")
        # one row per run: AQE broadcasts it at run time when its measured size is small
        stop = fresh.filter(F.col("year") < start_year).groupBy(*k).agg(F.min("pos").alias("_stop"))
        kept.append(fresh.join(stop, k, "left")
                    .filter(F.col("_stop").isNull() | (F.col("pos") < F.col("_stop")))
                    .select(*k, "page", "pos", "url", "year"))
        marks = page.join(stop, k, "left").filter(
            F.col("_stop").isNull() | (F.col("pos") <= F.col("_stop"))).select(*k, "url")
        seen = marks.distinct() if seen is None else seen.unionByName(marks).distinct()
        if checkpoint_every and (i + 1) % checkpoint_every == 0 and i + 1 < len(pages):
            seen = seen.checkpoint()
    return reduce(DataFrame.unionByName, kept)


def detail_year_filter(df: DataFrame, start_year: int = START_YEAR, col: str = "date") -> DataFrame:
    """Detail-page year filter (X10): parsed year < start → drop; an unparsed date passes."""
    return df.filter(F.col(col).isNull() | (F.year(col) >= start_year))


def title_required(df: DataFrame, sources: list[str]) -> DataFrame:
    """Title-required filter (X11) for the given sources only."""
    need = F.col("source").isin(sources)
    return df.filter(~need | (F.length(F.coalesce("title", F.lit(""))) > 0))


def normalize_item(df: DataFrame, run_date: str | None = None) -> DataFrame:
    """``add_item`` (X13): strip title and content; date as ``yyyy-MM-dd`` text, a
    missing date stays NULL (the reference writes the text "None"); ``run_date``
    stands in for "now" where a source has no date tag at all."""
    date = F.date_format(F.col("date"), "yyyy-MM-dd")
    if run_date is not None:
        date = F.coalesce(date, F.lit(run_date))
    return df.withColumn("title", ustrip(F.coalesce("title", F.lit("")))).withColumn(
        "content", ustrip(F.coalesce("content", F.lit("")))).withColumn("published_date", date)


# ---------------------------------------------------------------- X12

def json_path(c: Column, path: str) -> Column:
    """Embedded JSON lookup (X12): a nested path inside a script body or API reply."""
    return F.get_json_object(c, path)


POSTS = "array<struct<postID: bigint, title: string, date: string, content: string, description: string>>"


def api_posts(replies: DataFrame, body: str = "body", post_url: str = "https://fireant.vn/bai-viet/") -> DataFrame:
    """Posts of API replies (X12), one row per array element in reply order: pos, post_id, title,
    url, published_date, year and content. Untitled posts are skipped here, before any
    seen-URL step (X11). The date is the day that the post's own time names, NULL where it doesn't
    parse. Content is the post's HTML as text, one line per tag boundary, else the
    description. A reply that isn't an array gives no rows."""
    p = replies.select("*", F.posexplode(F.from_json(body, POSTS)).alias("pos", "post")).drop(body)
    p = p.where(F.length(F.coalesce("post.title", F.lit(""))) > 0)
    day = F.try_to_date(F.substring("post.date", 1, 10), "yyyy-MM-dd")
    lines = F.filter(F.transform(F.split(remove_subtrees(F.col("post.content")), "<[^>]*>"), lambda x: unescape(x)), lambda x: x != "")
    text = F.when(F.coalesce("post.content", F.lit("")) != "", ustrip(F.array_join(lines, "\n"))).otherwise(F.coalesce("post.description", F.lit("")))
    return p.select(*[c for c in p.columns if c not in ("pos", "post")], "pos", F.col("post.postID").alias("post_id"), F.col("post.title").alias("title"),
                    F.concat(F.lit(post_url), F.col("post.postID").cast("string")).alias("url"), F.date_format(day, "yyyy-MM-dd").alias("published_date"),
                    F.year(day).alias("year"), text.alias("content"))


def post_text(content: Column, description: Column) -> Column:
    """API post body: the content, else the description when content is empty."""
    return F.coalesce(F.nullif(content, F.lit("")), description)
