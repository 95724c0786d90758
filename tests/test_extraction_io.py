import random

from pyspark.sql import functions as F

from tickerflow.operators import extraction as X
from tickerflow.operators import market as MK
from tickerflow.sources import io


def _fold(items, start_year=2022):
    """The reference's sequential walk, page by page, item by item."""
    seen, kept = set(), []
    for page in sorted({i[0] for i in items}):
        for _, pos, url, year in sorted(i for i in items if i[0] == page):
            if url in seen:
                continue
            seen.add(url)
            if year is not None and year < start_year:
                break
            kept.append((page, pos, url))
    return kept


def _run(spark, items, pages, max_run=1000):
    df = spark.createDataFrame([("T", "k", "S", p, pos, u, y) for p, pos, u, y in items],
                               "ticker string, keyword string, source string, page int, pos int, url string, year int")
    return sorted((r["page"], r["pos"], r["url"]) for r in X.stop_at_old(df, pages, checkpoint_every=2, max_run=max_run).collect())


def test_stop_at_old_fixtures(spark):
    a = [(1, 0, "u1", 2024), (1, 1, "u2", 2015), (1, 2, "u3", 2024)]
    assert _run(spark, a, [1]) == [(1, 0, "u1")]
    b = [(1, 0, "u2", 2015)] + [(2, 0, "u1", 2024), (2, 1, "u2", 2015), (2, 2, "u3", 2024)]
    assert _run(spark, b, [1, 2]) == [(2, 0, "u1"), (2, 2, "u3")]
    c = a + [(2, 0, "u2", 2015), (2, 1, "u3", 2024), (2, 2, "u1", 2024)]
    assert _run(spark, c, [1, 2]) == [(1, 0, "u1"), (2, 1, "u3")]


def test_stop_at_old_random_vs_fold(spark):
    random.seed(11)
    items = []
    for p in range(1, 6):
        for pos in range(8):
            items.append((p, pos, f"u{random.randint(0, 12)}", random.choice([2024, 2023, 2015, None])))
    assert _run(spark, items, [1, 2, 3, 4, 5]) == sorted(_fold(items))
    assert _run(spark, items, [1, 2, 3, 4, 5], max_run=10) == sorted(_fold(items))  # too large for one task


def test_stop_at_old_many_runs(spark):
    """Runs of several sizes in one pass, some of them too large for it; items without a page are left out."""
    rng = random.Random(5)
    rows = [(f"T{t}", p, pos, f"u{rng.randint(0, 30)}", rng.choice([2024, 2023, 2015, None])) for t in range(40) for p in range(4) for pos in range(t % 13)]
    df = spark.createDataFrame([(t, "k", "S", p, pos, u, y) for t, p, pos, u, y in rows] + [("T1", "k", "S", None, 0, "u", 2024)],
                               "ticker string, keyword string, source string, page int, pos int, url string, year int")
    expected = sorted((f"T{t}", *r) for t in range(40) for r in _fold([x[1:] for x in rows if x[0] == f"T{t}"]))
    got = sorted((r["ticker"], r["page"], r["pos"], r["url"]) for r in X.stop_at_old(df.repartition(3), max_run=30).collect())
    assert got == expected


def test_frontier_page_ranges(spark):
    kw = spark.createDataFrame([("BID", "BIDV")], "ticker string, keyword string")
    f = X.crawl_frontier(kw, 8)
    pages = {r["source"]: sorted(r["p"]) for r in f.groupBy("source").agg(F.collect_list("page").alias("p")).collect()}
    assert pages["VnExpress"] == [1, 2, 3, 4, 5] and pages["CafeF"] == list(range(1, 9))
    assert pages["FireAnt"] == list(range(0, 8))
    assert f.count() == 5 + 8 * 4 + 8 + 8 - 0  # 7 sources


def test_absolutize(spark):
    df = spark.createDataFrame([("//a.b/x",), ("/x",), ("http://c/x",)], "h string")
    got = [r["u"] for r in df.select(X.absolutize(F.col("h"), F.lit("https://host")).alias("u")).collect()]
    assert got == ["https://a.b/x", "https://host/x", "http://c/x"]


def test_detail_year_filter_keeps_unparsed(spark):
    df = spark.createDataFrame([(None,), ("2015-01-01",), ("2024-01-01",)], "d string").select(
        F.to_date("d").alias("date"))
    assert X.detail_year_filter(df).count() == 2


def test_extract_article(spark):
    html = ('<html><script>var t="</p>";</script><article><h1>T &amp; U</h1><p><b>One</b>'
            '<p>Two</p><p> </p></article></html>')
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    r = X.extract_article(df).first()
    assert r["title"] == "T & U" and r["content"] == "One Two"


def test_extract_article_paragraph_ends(spark):
    html = "<article><h1>T</h1>lead<p>a</p>caption<p class='x'>b</p><figure>fig</figure><pre>no</pre></article>"
    assert X.extract_article(spark.createDataFrame([(1, html)], "page_id long, html string")).first()["content"] == "a b"


def test_frontier_offsets(spark):
    kw = spark.createDataFrame([("BID", "BIDV")], "ticker string, keyword string")
    urls = {r["page"]: r["url"] for r in X.crawl_frontier(kw, 3).where("source = 'FireAnt'").collect()}
    assert urls == {p: f"https://restv2.fireant.vn/posts?symbol=BIDV&type=1&limit=20&offset={20 * p}" for p in range(3)}


def test_stop_at_old_takes_all_pages(spark):
    items = [(0, 0, "u0", 2024), (5, 0, "u5", 2024), (5, 1, "u0", 2024)]
    assert _run(spark, items, None) == [(0, 0, "u0"), (5, 0, "u5")]
    assert _run(spark, [(1, 0, None, 2024)], None) == [(1, 0, None)] and _run(spark, [], None) == []


def test_api_posts(spark):
    body = '[{"postID": 1, "title": "", "date": "2024-01-01"}, {"postID": 2, "title": "t", "date": "2024-03-01T00:30:00+07:00", "content": "<p>a</p><p>b &lt; c</p>"}, {"postID": 3, "title": "u", "content": "", "description": "d"}]'
    df = spark.createDataFrame([("BID", body), ("FPT", "oops"), ("VIC", None)], "ticker string, body string")
    got = [(r["pos"], r["url"], r["published_date"], r["year"], r["content"]) for r in X.api_posts(df).collect()]
    assert got == [(1, "https://fireant.vn/bai-viet/2", "2024-03-01", 2024, "a\nb < c"), (2, "https://fireant.vn/bai-viet/3", None, None, "d")]


def test_index_frames(spark):
    a = spark.createDataFrame([("2024-01-01", 1.0, 2.0)], "time string, close double, volume double")
    b = spark.createDataFrame([("2024-01-01", 1.0)], "time string, close double")
    assert MK.standardize_index_frame(b, "X") is None
    assert MK.standardize_index_frame(a, "X").columns == ["Symbol", "Date", "Close", "Volume"]


def test_keywords_roundtrip(spark, tmp_path):
    p = tmp_path / "kw"
    p.mkdir()
    (p / "BID_keywords.json").write_text(
        '{\n "ticker": "BID",\n "keywords_direct": ["a", "b"],\n "keywords_macro": ["c"]\n}', encoding="utf-8")
    got = [(r["group"], r["pos"], r["keyword"]) for r in io.load_keywords(spark, str(p)).orderBy("pos").collect()]
    assert got == [("keywords_direct", 0, "a"), ("keywords_direct", 1, "b"), ("keywords_macro", 2, "c")]


def test_split_halves(spark):
    s = spark.createDataFrame([(f"s{i}", i) for i in range(7)], "symbol string, ord long")
    parts = {r["symbol"]: r["part"] for r in MK.split_halves(s).collect()}
    assert [parts[f"s{i}"] for i in range(7)] == [1, 1, 1, 2, 2, 2, 2]


def test_split_halves_keeps_all_rows_when_partitions_coalesce(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.parallelismFirst")}
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        n = 2_000_000
        s = spark.range(n).selectExpr("id as ord", "concat('s', id % 9973, '-', id) as symbol")
        got = {r["part"]: r["count"] for r in MK.split_halves(s).groupBy("part").count().collect()}
        assert got == {1: n // 2, 2: n // 2}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
