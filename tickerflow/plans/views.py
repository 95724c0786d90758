"""Stand-in views that derive the pipeline's inputs from the driver's testdata.

The testdata holds no prices or news, so each input is derived from a real
table with Spark, and its work grows with that table (SURVEY §7.3). Every view
has a DuckDB twin (``SQL_VIEWS``) used by the oracle queries as a CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import spread

# The five order priorities stand for the five tickers of the reference.
PRIORITY_TICKER = {
    "1-URGENT": "BID",
    "2-HIGH": "FPT",
    "3-MEDIUM": "VIC",
    "4-NOT SPECIFIED": "VJC",
    "5-LOW": "VNM",
}
TICKERS = ["BID", "FPT", "VIC", "VJC", "VNM"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pages_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages, spread over the cluster when the file is under-split."""
    return spread(table(spark, sf_dir, "pages"), "page_id")


def _ticker_of(col: str):
    expr = None
    for prio, tick in PRIORITY_TICKER.items():
        expr = F.when(F.col(col) == prio, tick) if expr is None else expr.when(F.col(col) == prio, tick)
    return expr


def _ticker_sql(col: str) -> str:
    cases = " ".join(f"WHEN {col} = '{p}' THEN '{t}'" for p, t in PRIORITY_TICKER.items())
    return f"CASE {cases} END"


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars: one per (priority, order date); ``o_orderkey`` orders the day."""
    o = table(spark, sf_dir, "orders")
    return (
        o.groupBy(_ticker_of("o_orderpriority").alias("ticker"), F.to_date("o_orderdate").alias("date"))
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )
    )


def sentiment_scores(spark: SparkSession, sf_dir: str, returnflag: str | None = "R") -> DataFrame:
    """Raw per-article scores: lineitem ⋈ orders, score = discount*20 - 1 on the ship day.

    Every lineitem row is kept. With ``returnflag`` set, only items with that flag
    carry a score and the others a NULL score, so some days have no usable
    sentiment (their daily mean is NULL) and the forward fill is exercised.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_discount", "l_returnflag")
    score = F.col("l_discount") * 20 - 1
    if returnflag is not None:
        score = F.when(F.col("l_returnflag") == returnflag, score)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        _ticker_of("o_orderpriority").alias("ticker"),
        F.to_date("l_shipdate").alias("date"),
        score.alias("target_score"),
    )


SQL_VIEWS = {
    "bars": f"""
bars AS (
  SELECT {_ticker_sql('o_orderpriority')} AS ticker, CAST(o_orderdate AS DATE) AS date,
         min_by(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, max_by(o_totalprice, o_orderkey) AS close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM orders GROUP BY 1, 2
)""",
    "scores_all": f"""
scores_all AS (
  SELECT {_ticker_sql('o_orderpriority')} AS ticker, CAST(l_shipdate AS DATE) AS date,
         l_discount * 20 - 1 AS target_score, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)""",
    "scores": f"""
scores AS (
  SELECT {_ticker_sql('o_orderpriority')} AS ticker, CAST(l_shipdate AS DATE) AS date,
         CASE WHEN l_returnflag = 'R' THEN l_discount * 20 - 1 END AS target_score
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)""",
}


def with_views(names: list[str], body: str, extra: str = "", recursive: bool = False) -> str:
    """``WITH <views>, <extra> <body>`` for the DuckDB oracle."""
    ctes = ",".join([SQL_VIEWS[n] for n in names] + ([extra] if extra.strip() else []))
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"


# ---------------------------------------------------------------- articles (from documents)
def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw crawled rows: every document is an article.

    URL = host by doc_id % 7 + slug by doc_id % 100 carrying an 8-digit date code
    (some invalid: month 13/14, day 31 in short months); doc_id % 4 = 0 adds a
    second code that F4 must ignore. Shared (host, slug) pairs are the repeats A1
    removes. published_date is missing for doc_id % 11 = 0.
    """
    d = spread(table(spark, sf_dir, "documents"), "doc_id")
    g = F.col("doc_id") % 100
    code = F.concat(
        (F.lit(2015) + g % 13).cast("string"),
        F.lpad((F.lit(1) + (g * 7) % 14).cast("string"), 2, "0"),
        F.lpad((F.lit(1) + (g * 11) % 31).cast("string"), 2, "0"),
    )
    url = F.concat(
        F.lit("https://news"), (F.col("doc_id") % 7).cast("string"), F.lit(".vn/a"), g.cast("string"), F.lit("-"),
        code, F.when(F.col("doc_id") % 4 == 0, F.lit("-20240101")).otherwise(F.lit("")), F.lit(".htm"),
    )
    published = F.when(F.col("doc_id") % 11 == 0, F.lit(None).cast("string")).otherwise(
        F.date_format(F.date_add(F.lit("2021-06-01").cast("date"), ((F.col("doc_id") * 37) % 1600).cast("int")),
                      "yyyy-MM-dd")
    )
    title = F.when(F.instr("text", "\n") > 0, F.substring_index("text", "\n", 1)).otherwise(F.lit(""))
    return d.select(
        F.element_at(F.array(*[F.lit(t) for t in TICKERS]), (F.col("doc_id") % 5 + 1).cast("int")).alias("ticker"),
        "source", F.col("lang").alias("keyword"), title.alias("title"), url.alias("url"),
        published.alias("published_date"), F.col("text").alias("content"), F.col("doc_id").alias("arrival"),
    )


_G = "(doc_id % 100)"
SQL_VIEWS["raw_articles"] = f"""
raw_articles AS (
  SELECT CASE doc_id % 5 {' '.join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TICKERS))} END AS ticker,
         source, lang AS keyword,
         CASE WHEN strpos(text, chr(10)) > 0 THEN split_part(text, chr(10), 1) ELSE '' END AS title,
         'https://news' || CAST(doc_id % 7 AS VARCHAR) || '.vn/a' || CAST({_G} AS VARCHAR) || '-'
           || CAST(2015 + {_G} % 13 AS VARCHAR)
           || lpad(CAST(1 + ({_G} * 7) % 14 AS VARCHAR), 2, '0')
           || lpad(CAST(1 + ({_G} * 11) % 31 AS VARCHAR), 2, '0')
           || CASE WHEN doc_id % 4 = 0 THEN '-20240101' ELSE '' END || '.htm' AS url,
         CASE WHEN doc_id % 11 = 0 THEN NULL
              ELSE strftime(DATE '2021-06-01' + CAST((doc_id * 37) % 1600 AS INTEGER), '%Y-%m-%d') END
           AS published_date,
         text AS content, doc_id AS arrival
  FROM documents
)"""


# ---------------------------------------------------------------- listing (from part), for the ticker map
# Stand-in legal-form prefixes by p_partkey % 8 (one upper-case, one none).
LISTING_PREFIX = ["Công ty Cổ phần ", "CTCP ", "Tổng Công ty ", "Tập đoàn ", "Ngân hàng TMCP ",
                  "NGÂN HÀNG ", "Doanh nghiệp ", ""]


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company listing: symbol 'P<partkey>', full name = prefix + brand + name,
    short name = name (empty for partkey % 3 = 0, prefixed 'Tập đoàn ' for % 3 = 1)."""
    p = table(spark, sf_dir, "part")
    prefix = F.element_at(F.array(*[F.lit(x) for x in LISTING_PREFIX]), (F.col("p_partkey") % 8 + 1).cast("int"))
    short = (F.when(F.col("p_partkey") % 3 == 0, F.lit(""))
             .when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("Tập đoàn "), F.col("p_name")))
             .otherwise(F.col("p_name")))
    return p.select(
        F.col("p_partkey").alias("row_order"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"),
        F.concat(prefix, F.col("p_brand"), F.lit(" "), F.col("p_name")).alias("organ_name"),
        short.alias("organ_short_name"),
    )


SQL_VIEWS["listing"] = f"""
listing AS (
  SELECT p_partkey AS row_order, 'P' || CAST(p_partkey AS VARCHAR) AS symbol,
         CASE p_partkey % 8 {' '.join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(LISTING_PREFIX))} END
           || p_brand || ' ' || p_name AS organ_name,
         CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN 'Tập đoàn ' || p_name ELSE p_name END
           AS organ_short_name
  FROM part
)"""


# ---------------------------------------------------------------- name dictionary (from benchmark)
NAME_TICKERS = TICKERS + [f"T{i}" for i in range(30)]


def _bench_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    w = b.select("item_id", F.posexplode(F.split("text", " ")).alias("pos", "raw"))
    return w.select("item_id", "pos", F.regexp_replace("raw", "[^\\p{L}]", "").alias("word"))


def name_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered name → ticker map derived from benchmark text.

    Names: capitalised words of >= 6 letters and two-word runs (capitalised first
    word) of >= 15 characters. ord = item_id * 100000 + 2 * pos (+1 for runs);
    ticker by k = (item_id * 31 + pos) % 40: five real tickers, 30 others, and for
    k >= 35 the upper-cased first three letters (so words can be tickers, J6).
    Repeated names keep the first position and take the last ticker (dict update).
    """
    w = _bench_words(spark, sf_dir)
    nxt = w.select("item_id", (F.col("pos") - 1).alias("pos"), F.col("word").alias("next_word"))
    ww = w.join(nxt, ["item_id", "pos"], "left")
    cap = F.col("word").rlike("^\\p{Lu}")
    single = ww.filter(cap & (F.length("word") >= 6)).select(
        (F.col("item_id") * 100000 + F.col("pos") * 2).alias("seq"), F.col("word").alias("name"), "item_id", "pos")
    pair_name = F.concat_ws(" ", F.col("word"), F.col("next_word"))
    pair = ww.filter(cap & (F.col("next_word") != "") & (F.length(pair_name) >= 15)).select(
        (F.col("item_id") * 100000 + F.col("pos") * 2 + 1).alias("seq"), pair_name.alias("name"), "item_id", "pos")
    k = (F.col("item_id") * 31 + F.col("pos")) % 40
    tick = F.when(k >= 35, F.upper(F.substring("name", 1, 3))).otherwise(
        F.element_at(F.array(*[F.lit(t) for t in NAME_TICKERS]), (k + 1).cast("int")))
    entries = single.unionByName(pair).select("seq", "name", tick.alias("ticker"))
    return entries.groupBy("name").agg(F.min("seq").alias("ord"), F.max_by("ticker", "seq").alias("ticker")).select(
        "ord", "name", "ticker")


_NT = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(NAME_TICKERS))
SQL_VIEWS["names"] = f"""
bw AS (
  SELECT item_id, pos - 1 AS pos, regexp_replace(raw, '[^\\p{{L}}]', '', 'g') AS word
  FROM (SELECT item_id, unnest(string_split(text, ' ')) AS raw,
               generate_subscripts(string_split(text, ' '), 1) AS pos FROM benchmark)
),
bww AS (
  SELECT a.item_id, a.pos, a.word, b.word AS next_word
  FROM bw a LEFT JOIN bw b ON a.item_id = b.item_id AND b.pos = a.pos + 1
),
name_entries AS (
  SELECT item_id * 100000 + pos * 2 AS seq, word AS name, item_id, pos FROM bww
  WHERE regexp_matches(word, '^\\p{{Lu}}') AND length(word) >= 6
  UNION ALL
  SELECT item_id * 100000 + pos * 2 + 1, word || ' ' || next_word, item_id, pos FROM bww
  WHERE regexp_matches(word, '^\\p{{Lu}}') AND next_word <> '' AND length(word || ' ' || next_word) >= 15
),
names AS (
  SELECT name, min(seq) AS ord,
         arg_max(CASE WHEN (item_id * 31 + pos) % 40 >= 35 THEN upper(substr(name, 1, 3))
                      ELSE CASE (item_id * 31 + pos) % 40 {_NT} END END, seq) AS ticker
  FROM name_entries GROUP BY name
)"""


def derived_aliases(names: DataFrame) -> DataFrame:
    """Aliases that hit the data: every 3rd name (by ord) as lower-case alias; those
    with ord % 4 = 0 unlisted (NULL ticker), the rest pointing at 'A<k>'."""
    n = names.filter(F.col("ord") % 3 == 0)
    t = (F.when(F.col("ord") % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("A"), (F.col("ord") % 13).cast("string"))))
    # one value per alias (a dict): the first name in map order decides
    return n.groupBy(F.lower("name").alias("alias")).agg(F.min_by(t, F.col("ord")).alias("ticker"))


SQL_VIEWS["aliases"] = """
aliases AS (
  SELECT alias, ticker FROM (
    SELECT lower(name) AS alias,
           CASE WHEN ord % 4 = 0 THEN NULL ELSE 'A' || CAST(ord % 13 AS VARCHAR) END AS ticker,
           row_number() OVER (PARTITION BY lower(name) ORDER BY ord) AS rk
    FROM names WHERE ord % 3 = 0
  ) WHERE rk = 1
)"""


# ---------------------------------------------------------------- mentions made from the dictionary
def name_mentions(names: DataFrame) -> DataFrame:
    """(article_id, entity): names as texts write them, so that every step of the cascade has hits. Variant 0: the name
    with a small first letter; 1: with a company suffix; 2: without its third letter; 3: with a doubled last letter; 4: the ticker."""
    n = F.col("name")
    variants = F.array(F.concat(F.lower(F.substring(n, 1, 1)), F.substr(n, F.lit(2))), F.concat(n, F.lit(" Holdings Group")), F.concat(F.substring(n, 1, 2), F.substr(n, F.lit(4))),
                       F.concat(n, F.substr(n, F.length(n))), F.col("ticker"))
    every = names.select("ord", F.posexplode(variants).alias("variant", "entity"))
    return every.select(((F.col("ord") + F.col("variant")) % 50).alias("article_id"), "entity")


SQL_VIEWS["name_mentions"] = """
name_mentions AS (
  SELECT (ord + variant) % 50 AS article_id,
         CASE variant WHEN 0 THEN lower(substr(name, 1, 1)) || substr(name, 2) WHEN 1 THEN name || ' Holdings Group' WHEN 2 THEN substr(name, 1, 2) || substr(name, 4)
              WHEN 3 THEN name || substr(name, length(name)) ELSE ticker END AS entity
  FROM names CROSS JOIN (SELECT unnest(range(5)) AS variant)
)"""


# ---------------------------------------------------------------- tokens (from documents), whole texts
def tokens(spark: SparkSession, sf_dir: str, accepted_only: bool = False) -> DataFrame:
    """(article_id, pos, word, ner_tag) for every word of every document: words are
    whitespace-split and stripped of non-letters/digits (empty ones dropped, their
    position kept); a capitalised word is tagged B-ORG, any other word O (a
    stand-in for the tagger). The target ticker is the article's.

    ``accepted_only``: keep only B-ORG tokens. A word is capitalised exactly when
    the first letter/digit of the raw token is upper case, so the raw tokens are
    filtered with one anchored regex before any cleaning.
    """
    d = spread(table(spark, sf_dir, "documents"), "doc_id")
    t = d.select(F.col("doc_id").alias("article_id"),
                 F.posexplode(F.split("text", "[ \\t\\n\\x0B\\f\\r]+")).alias("pos", "raw"))
    if accepted_only:
        t = t.filter(F.col("raw").rlike("^[^\\p{L}\\p{N}]*\\p{Lu}"))
    t = t.select("article_id", "pos", F.regexp_replace("raw", "[^\\p{L}\\p{N}]", "").alias("word")).filter(
        F.col("word") != "")
    return t.withColumn("ner_tag", F.when(F.col("word").rlike("^\\p{Lu}"), F.lit("B-ORG")).otherwise(F.lit("O")))


def target_of(article_id: str = "article_id"):
    """The article's own ticker (same rule as the articles view: doc_id % 5)."""
    return F.element_at(F.array(*[F.lit(t) for t in TICKERS]), (F.col(article_id) % 5 + 1).cast("int"))


# ---------------------------------------------------------------- listing items (from the raw articles)
SOURCE_NAMES = ["VnExpress", "ThanhNien", "VnEconomy", "Vietnamnet", "CafeF", "Vietstock", "FireAnt"]
LISTING_PAGES = [1, 2, 3, 4]


def listing_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-listing items: each raw article is an item of source arrival % 7, on page
    1 + (arrival / 7) % 4 at position = arrival; listing year from its published date."""
    r = raw_articles(spark, sf_dir)
    src = F.element_at(F.array(*[F.lit(s) for s in SOURCE_NAMES]), (F.col("arrival") % 7 + 1).cast("int"))
    return r.select(
        "ticker", "keyword", src.alias("source"),
        (F.lit(1) + F.floor(F.col("arrival") / 7) % 4).cast("int").alias("page"),
        F.col("arrival").alias("pos"), "url", "title", "published_date",
        F.year(F.try_to_date("published_date", "yyyy-MM-dd")).alias("year"),
    )


SQL_VIEWS["items"] = """
items AS (
  SELECT ticker, keyword,
         CASE arrival % 7 """ + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SOURCE_NAMES)) + """ END AS source,
         CAST(1 + floor(arrival / 7) % 4 AS INTEGER) AS page, arrival AS pos, url, title, published_date,
         year(CAST(try_strptime(published_date, '%Y-%m-%d') AS DATE)) AS year
  FROM raw_articles
)"""
