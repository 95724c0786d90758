"""Page trees, selectors and the profiles of the news sites."""

import random
import time

from pyspark.sql import functions as F

from tickerflow.operators import newssites as N
from tickerflow.operators import pagetree as P


def test_tree_intervals_and_text():
    elements, texts = P.tree('<div class="a b"><p>x<p>y &amp; z<br/></div> <b>q')
    assert [(e["tag"], e["open"], e["close"], e["parent"]) for e in elements] == [("div", 1, 6, 0), ("p", 2, 6, 1), ("p", 4, 6, 2), ("br", 6, 6, 4), ("b", 8, 9, 0)]
    assert [(t["pos"], t["text"]) for t in texts] == [(3, "x"), (5, "y & z"), (7, " "), (9, "q")]
    assert P.tree(None) == ([], []) and P.tree("") == ([], [])
    assert [t["text"] for t in P.tree("a<!-- x -->b<script>var a='</p>';</script>c < d</i>")[1]] == ["a", "b", "c < d"]


def test_tree_of_broken_pages_is_quick():
    page = '<html><body><div data-props=\'{"k":"v","l":"w"}\' class="x y"><p title=a>Text &lt; <b>bold</b></p><!-- c --><script>x</script></div></body></html>'
    for cut in range(len(page)):
        P.tree(page[:cut])
    began = time.time()
    for bad in ("<div " + " ".join(f'a{i}="x"' for i in range(3000)), "<div data-props='{" + '"k":"v",' * 4000, "<" * 20000, '<a b="' * 20000, "<a " + "= " * 20000, "<!--" * 20000, "<p>" * 20000):
        P.tree(bad)
    assert time.time() - began < 20


def _brute(elements, selector):
    """A selector by plain Python over the same tree."""
    def own(e, part):
        tag, _, cls = part.partition(".")
        return (not tag or e["tag"] == tag) and (not cls or cls in e["classes"])

    def named(path, within):
        found = [e for e in elements if own(e, path[0]) and (within is None or within["open"] < e["open"] <= within["close"])]
        return found if len(path) == 1 else [x for e in found for x in named(path[1:], e)]

    return sorted({e["open"] for path in selector.split(",") for e in named(path.split(), None)})


def test_selectors_like_plain_search(spark):
    rng = random.Random(4)
    pages = []
    for _ in range(25):
        html = ""
        for _ in range(40):
            tag = rng.choice(["div", "p", "span", "td"])
            html += rng.choice([f'<{tag} class="{rng.choice("abc")} {rng.choice("def")}">', f"</{tag}>", "text ", "<br>"])
        pages.append(html)
    df = P.with_tree(spark.createDataFrame(list(enumerate(pages)), "id int, html string"))
    selectors = ["div", "div.a", ".b .e", "div p.c", "span td, .d", "div .a span", "p p"]
    rows = df.select("id", *[F.transform(P.select(F.col("elements"), s), lambda e: e["open"]).alias(f"s{k}") for k, s in enumerate(selectors)]).collect()
    for r in rows:
        elements = P.tree(pages[r["id"]])[0]
        for k, s in enumerate(selectors):
            assert r[f"s{k}"] == _brute(elements, s), (s, pages[r["id"]])


def _articles(spark, rows):
    df = spark.createDataFrame(rows, "source string, html string, listing_date date").withColumn("title", F.lit("clash"))
    return {r["source"]: (r["title"], r["content"], r["published_date"]) for r in N.article_fields(df, "2025-12-02").collect()}


def test_article_fields_of_each_site(spark):
    got = _articles(spark, [
        ("VnExpress", '<span class="date">Thứ hai, 5/3/2024, 10:20 (GMT+7)</span><h1 class="title-detail"> T </h1><article class="fck_detail"><p> a <b>b</b></p><figure>caption</figure><p>c</p></article>', None),
        ("ThanhNien", '<h1 class="detail-title"><span>T</span></h1><div class="detail-content">a<div class="detail__related">no</div><p>b</p></div><div data-role="publishdate">05/03/2019 x</div>', None),
        ("VnEconomy", '<h1 class="name-detail">T</h1><div class="ct-edtior-web">a<br>b</div><div class="date-detail"><p class="date">soon</p></div>', None),
        ("Vietnamnet", '<h1 class="content-detail-title">T</h1><div id="maincontent"><table><tr><td>no</table>a</div>', None),
        ("CafeF", '<h1 class="title">old</h1><span class="pdate">05-03-2019</span>', None),
        ("Vietstock", "<p>nothing here</p>", None),
        ("Other", "<h1>x</h1>", None),
    ])
    assert got == {"VnExpress": ("T", "a b c", "2024-03-05"), "ThanhNien": ("T", "a\nb", "2019-03-05"), "VnEconomy": ("T", "a\nb", None),
                   "Vietnamnet": ("T", "a", "2025-12-02"), "Vietstock": ("", "", "2025-12-02")}
    assert _articles(spark, [("VnExpress", '<span class="date">5/3/2024</span><h1 class="title-detail"> </h1>', None), ("CafeF", None, None)]) == {"CafeF": ("", "", "2025-12-02")}


def test_listing_items(spark):
    rows = [
        ("VnExpress", '<div><h3 class="title-news"><a href="https://vnexpress.net/a">x</a></h3></div><span class="time">05/03/2024</span><h3 class="title-news"><a>x</a></h3>'
                      '<div><p class="time">06/03/2024</p><h3 class="title-news"><i></i><a href="https://vnexpress.net/b">x</a></h3></div>'),
        ("Vietstock", '<table><tr><td>one</td></tr><tr><td>05/03/24 10:00</td><td><a href="/a">x</a></td></tr><tr><td>x</td><td><a href="//h/b">x</a></td></tr></table>'),
        ("CafeF", '<div class="item"><h3><a href="/no"></a></h3></div><div class="list-bytags timeline"><div class="item"><h3>x</h3><h3><a href="/no"></a></h3></div><div class="item"><h3><a href="yes"></a></h3></div></div>'),
    ]
    got = N.listing_items(spark.createDataFrame(rows, "source string, html string")).collect()
    assert sorted((r["source"], r["pos"], r["url"], str(r["listing_date"])) for r in got) == [
        ("CafeF", 1, "https://cafef.vnyes", "None"), ("Vietstock", 1, "https://finance.vietstock.vn/a", "2024-03-05"), ("Vietstock", 2, "https://h/b", "None"),
        ("VnExpress", 0, "https://vnexpress.net/a", "2024-03-05"), ("VnExpress", 2, "https://vnexpress.net/b", "2024-03-06")]
    assert N.listing_items(spark.createDataFrame([], "source string, html string")).count() == 0
