"""Listing items and article fields of the news sites (X3, X4, X7-X11, X13), by profiles over page trees.

A profile is data: selectors, the form of the text, where the date stands and how it is read. ``listing_items``
and ``article_fields`` turn every profile into column expressions and choose by the page's ``source``.
FireAnt has no pages; its API replies are read by ``extraction.api_posts``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.text import ustrip
from .extraction import START_YEAR, absolutize
from .pagetree import first, inside, select, select_in, text, with_tree


def _day(s: Column) -> Column:
    return F.try_to_date(ustrip(s), "d/M/yyyy")


def _slashed(s: Column) -> Column:
    """The first ``d/m/yyyy`` of a text."""
    return F.try_to_date(F.regexp_extract(s, r"(\d{1,2}/\d{1,2}/\d{4})", 1), "d/M/yyyy")


@dataclass(frozen=True)
class Article:
    """title and content: selectors, the first match counts. paragraphs: the text of each <p> stripped and joined by
    spaces; else all text nodes joined by newlines. removed: sub-trees that go first. dates: selectors in order of
    preference, empty where the listing's date is used. Without a date tag the run date stands in; where the tag's text
    doesn't parse, the date is NULL, or the run date with unparsed_is_run. filtered: articles before the first year go."""

    title: str
    content: str
    dates: tuple[str, ...]
    parse: Callable[[Column], Column] = D.parse_common
    paragraphs: bool = False
    removed: str | None = None
    unparsed_is_run: bool = False
    filtered: bool = True
    title_required: bool = False


# Selectors of the sources' article pages.
ARTICLES = {
    "VnExpress": Article("h1.title-detail", "article.fck_detail", ("span.date",), lambda s: F.to_date(D.parse_vnexpress(s)), paragraphs=True, unparsed_is_run=True, title_required=True),
    "ThanhNien": Article("h1.detail-title span", "div.detail-content", ("[data-role='publishdate']",), _slashed, removed=".detail__related, .VCSortableInPreviewMode, script", unparsed_is_run=True, filtered=False),
    "VnEconomy": Article("h1.name-detail", ".ct-edtior-web", (".date-detail .date",)),
    "Vietnamnet": Article("h1.content-detail-title", "#maincontent", (".bread-crumb-detail__time", ".publish-date"), removed="table, script, .inner-article"),
    "CafeF": Article("h1.title", "div.detail-content", ("span.pdate",)),
    "Vietstock": Article("h1.article-title", "div#vst_detail", (), filtered=False),
}


def _content(p: Article, elements: Column, texts: Column) -> Column:
    box = first(select(elements, p.content))
    if p.paragraphs:
        return F.array_join(F.transform(select_in(elements, "p", box), lambda e: ustrip(text(texts, e))), " ")
    return text(texts, box, "\n", select_in(elements, p.removed, box) if p.removed else None)


def _by_source(source: Column, values: dict[str, Column]) -> Column:
    out = None
    for name, value in values.items():
        out = F.when(source == name, value) if out is None else out.when(source == name, value)
    return out


def article_fields(pages: DataFrame, run_date: str, start_year: int = START_YEAR) -> DataFrame:
    """Title, content and published_date (``yyyy-MM-dd`` text) of article pages (source, html, listing_date).

    Rows of sources without a profile go, as do pages before ``start_year`` and pages without a title where the
    source asks for them. A page without the title or content element has empty text there. ``html`` goes.
    """
    d = with_tree(pages.where(F.col("source").isin(list(ARTICLES))))
    elements, texts, source = F.col("elements"), F.col("texts"), F.col("source")
    run = F.lit(run_date).cast("date")

    def tag_of(p: Article) -> Column:
        return F.coalesce(*[first(select(elements, s)) for s in p.dates])

    dated = {s: p for s, p in ARTICLES.items() if p.dates}
    d = d.withColumn("_tag", _by_source(source, {s: tag_of(p) for s, p in dated.items()}))
    own = text(texts, F.col("_tag"))
    d = d.withColumn("_read", _by_source(source, {s: p.parse(own) for s, p in dated.items()}))
    absent = {s: F.col("_tag").isNull() | F.lit(p.unparsed_is_run) for s, p in dated.items()}
    date = _by_source(source, {s: F.coalesce("_read", F.when(absent[s], run)) for s in dated} | {s: F.coalesce("listing_date", run) for s, p in ARTICLES.items() if not p.dates})
    d = d.withColumn("_date", date)
    old = F.coalesce(F.year("_read") < start_year, F.lit(False)) & source.isin([s for s, p in ARTICLES.items() if p.filtered])
    d = d.where(~old)
    field = lambda of: ustrip(F.coalesce(_by_source(source, {s: of(p) for s, p in ARTICLES.items()}), F.lit("")))
    d = d.withColumn("title", field(lambda p: text(texts, first(select(elements, p.title)))))
    d = d.where((F.col("title") != "") | ~source.isin([s for s, p in ARTICLES.items() if p.title_required]))
    d = d.withColumn("content", field(lambda p: _content(p, elements, texts)))
    return d.withColumn("published_date", F.date_format("_date", "yyyy-MM-dd")).drop("elements", "texts", "_tag", "_read", "_date")


# ---------------------------------------------------------------- listings

@dataclass(frozen=True)
class Listing:
    """items: selector. link and date: from the item (and the page's elements and texts) to the link element and the text of
    the date. The host goes before a link by ``host``; parse reads the date, strings that don't parse have none."""

    items: str
    link: Callable[[Column, Column], Column]
    host: Callable[[Column], Column]
    date: Callable[[Column, Column, Column], Column] | None = None
    parse: Callable[[Column], Column] = _day


def _linked(selector: str) -> Callable[[Column, Column], Column]:
    return lambda elements, item: first(select_in(elements, selector, item))


def _prefixed(host: str) -> Callable[[Column], Column]:
    return lambda href: F.when(href.startswith("/"), F.concat(F.lit(host), href)).otherwise(href)


def _next_time(elements: Column, texts: Column, item: Column) -> Column:
    """The next span.time after the item's start, else the first .time under the item's parent."""
    after = first(F.filter(select(elements, "span.time"), lambda e: e["open"] > item["open"]))
    parent = first(F.filter(elements, lambda e: e["open"] == item["parent"]))
    return text(texts, F.coalesce(after, first(select_in(elements, ".time", parent))))


def _cell(elements: Column, item: Column, k: int) -> Column:
    return F.get(select_in(elements, "td", item), F.lit(k))


# Selectors of the sources' search listings.
LISTINGS = {
    "VnExpress": Listing("h3.title-news", _linked("a"), lambda href: href, _next_time),
    "ThanhNien": Listing(".box-category-item", _linked("a.box-category-link-with-avatar"), lambda href: absolutize(href, F.lit("https://thanhnien.vn"), False),
                         lambda elements, texts, item: first(select_in(elements, ".box-time", item))["attrs"]["title"], D.parse_iso_local),
    "VnEconomy": Listing(".featured-row_item", _linked("a.link-layer-imt"), _prefixed("https://vneconomy.vn")),
    "Vietnamnet": Listing(".horizontalPost", _linked(".horizontalPost__main-title a"), _prefixed("https://vietnamnet.vn")),
    "CafeF": Listing(".timeline.list-bytags .item", lambda elements, item: first(select_in(elements, "a", first(select_in(elements, "h3", item)))),
                     lambda href: absolutize(href, F.lit("https://cafef.vn"), False)),
    "Vietstock": Listing("tr", lambda elements, item: first(select_in(elements, "a", _cell(elements, item, 1))),
                         lambda href: F.when(href.startswith("//"), F.concat(F.lit("https:"), href)).otherwise(_prefixed("https://finance.vietstock.vn")(href)),
                         lambda elements, texts, item: ustrip(text(texts, _cell(elements, item, 0))), D.parse_two_digit_year),
}


def listing_items(pages: DataFrame) -> DataFrame:
    """The items of listing pages (source, html), one row each in page order: pos, href, url, listing_date, year.

    An item without its link, or whose link has no href, gives no row (its place stays counted). Listings of sources
    without a date, and dates that don't parse, have a null listing_date.
    """
    d = with_tree(pages.where(F.col("source").isin(list(LISTINGS))))
    elements, texts, source = F.col("elements"), F.col("texts"), F.col("source")

    def found(p: Listing) -> Column:
        return F.transform(select(elements, p.items), lambda item: F.struct(
            p.link(elements, item)["attrs"]["href"].alias("href"),
            (p.date(elements, texts, item) if p.date else F.lit(None).cast("string")).alias("day")))

    d = d.withColumn("_items", _by_source(source, {s: found(p) for s, p in LISTINGS.items()}))
    d = d.select(*[c for c in d.columns if c not in ("elements", "texts", "_items")], F.posexplode("_items").alias("pos", "_item")).where("_item.href is not null")
    href, day = F.col("_item.href"), F.col("_item.day")
    d = d.withColumn("href", href).withColumn("url", _by_source(source, {s: p.host(href) for s, p in LISTINGS.items()}))
    date = _by_source(source, {s: p.parse(day) for s, p in LISTINGS.items() if p.date})
    return d.withColumn("listing_date", date).withColumn("year", F.year("listing_date")).drop("_item")
