"""Queries over article cleaning, dedup and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..operators import articles as A
from ..operators import tickermap as M
from ..operators.common import Counted, stored
from .catalog import query
from .normalize import sql_finish
from .views import bars, name_dictionary, raw_articles, table, with_views

# ---------------------------------------------------------------- SQL twins of the text functions


_SQL_WS = " || ".join(f"chr({c})" for c in T.WS_CODES)


def sql_strip(e: str) -> str:
    return f"trim({e}, {_SQL_WS})"


def sql_collapse(e: str) -> str:
    spaced = f"translate({e}, {_SQL_WS}, '{' ' * len(T.WS_CODES)}')"
    return f"trim(regexp_replace({spaced}, ' {{2,}}', ' ', 'g'), ' ')"


def sql_url_date(e: str) -> str:
    y, m, d = (f"regexp_extract({e}, '{D.URL_DATE_RE}', {i})" for i in (1, 2, 3))
    return (f"CASE WHEN {y} <> '' AND TRY_CAST({m} AS INTEGER) BETWEEN 1 AND 12 "
            f"AND TRY_CAST({d} AS INTEGER) BETWEEN 1 AND 31 THEN {y} || '-' || {m} || '-' || {d} END")


CLEAN_CTE = f"""
cl0 AS (
  SELECT ticker, source, arrival, url,
         {sql_strip("coalesce(title, '')")} AS t0,
         {sql_collapse("coalesce(content, '')")} AS content,
         coalesce({sql_url_date('url')}, published_date) AS d0
  FROM raw_articles
),
cl1 AS (
  SELECT *, CASE WHEN t0 = '' AND content <> ''
                 THEN array_to_string(list_slice(regexp_split_to_array({sql_strip('content')}, '{T.WS_RUN_RE}'), 1, 15), ' ') || '...'
                 ELSE t0 END AS title
  FROM cl0 WHERE content <> '' AND d0 IS NOT NULL AND d0 <> ''
),
clean AS (
  SELECT ticker, source, CAST(try_strptime(d0, '%Y-%m-%d') AS DATE) AS date, title, content, url, arrival
  FROM cl1 WHERE try_strptime(d0, '%Y-%m-%d') IS NOT NULL
)"""


def _clean(spark, sf_dir):
    return A.clean_articles(raw_articles(spark, sf_dir))


def _sql(body: str, kinds: dict, extra: str = "", views=("raw_articles",)) -> str:
    return sql_finish(with_views(list(views), body, extra=extra), kinds)


_CLEAN_KINDS = {"ticker": "s", "source": "s", "date": "dt", "title": "s", "content": "s", "url": "s", "arrival": "i"}


@query("article_clean", _sql("SELECT ticker, source, date, title, content, url, arrival FROM clean", _CLEAN_KINDS,
                             extra=CLEAN_CTE))
def article_clean(spark, sf_dir):
    return _clean(spark, sf_dir)


# ---------------------------------------------------------------- A1: dedup by URL
_DEDUP_URL_SQL = _sql("""
SELECT ticker, url, arrival, published_date, pos_date, pos_arrival FROM (
  SELECT ticker, url, arrival, published_date,
         row_number() OVER (PARTITION BY ticker, url ORDER BY coalesce(published_date, 'None') ASC, arrival DESC) AS rk,
         first_value(coalesce(published_date, 'None')) OVER (
           PARTITION BY ticker, url ORDER BY coalesce(published_date, 'None') DESC, arrival ASC) AS pos_date,
         first_value(arrival) OVER (
           PARTITION BY ticker, url ORDER BY coalesce(published_date, 'None') DESC, arrival ASC) AS pos_arrival
  FROM raw_articles
) WHERE rk = 1""", {"ticker": "s", "url": "s", "arrival": "i", "published_date": "s", "pos_date": "s",
                    "pos_arrival": "i"})


@query("article_dedup_url", _DEDUP_URL_SQL)
def article_dedup_url(spark, sf_dir):
    """Per (ticker, url): the oldest copy, placed where its newest copy stood."""
    out = A.dedup_by_url(raw_articles(spark, sf_dir))
    return out.select("ticker", "url", "arrival", "published_date", "pos_date", "pos_arrival")


# ---------------------------------------------------------------- A2 (+P7, P10): dedup by content
_DEDUP_CONTENT_SQL = _sql("""
SELECT ticker, url, arrival, length(content) AS n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, content ORDER BY arrival) AS rk
  FROM raw_articles WHERE length(content) >= 10
) WHERE rk = 1""", {"ticker": "s", "url": "s", "arrival": "i", "n_chars": "i"})


@query("article_dedup_content", _DEDUP_CONTENT_SQL)
def article_dedup_content(spark, sf_dir):
    """EDA flow: keep length >= 10 (P7), drop the title (P10), then first copy per content (A2)."""
    raw = A.keep_min_length(raw_articles(spark, sf_dir)).drop("title").withColumn("n_chars", F.length("content"))
    kept = A.dedup_by_content(raw, key=["ticker", "content"])
    return kept.select("ticker", "url", "arrival", "n_chars")


# ---------------------------------------------------------------- profiling
_RAW_COLS = ["source", "keyword", "title", "url", "published_date", "content", "arrival"]
_NULLS_SQL = _sql(
    "SELECT ticker, count(*) AS rows, "
    + ", ".join(f"count({c}) AS {c}_count, count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in _RAW_COLS)
    + ", count(DISTINCT content) AS content_nunique FROM raw_articles GROUP BY ticker",
    {"ticker": "s", "rows": "i", **{f"{c}_{k}": "i" for c in _RAW_COLS for k in ("count", "nulls")},
     "content_nunique": "i"},
)


@query("profile_nulls", _NULLS_SQL)
def profile_nulls(spark, sf_dir):
    return A.profile_nulls(raw_articles(spark, sf_dir), group="ticker")


_LEN_SQL = _sql(
    "SELECT ticker, "
    + ", ".join(f"count(*) FILTER (WHERE length(content) < {k}) AS len_lt_{k}" for k in A.LENGTH_STEPS)
    + ", count(*) FILTER (WHERE length(content) >= 10) AS len_ge_10"
    + ", count(*) FILTER (WHERE contains(content, chr(10)) OR contains(content, chr(13))) AS with_newline"
    + " FROM raw_articles GROUP BY ticker",
    {"ticker": "s", **{f"len_lt_{k}": "i" for k in A.LENGTH_STEPS}, "len_ge_10": "i", "with_newline": "i"},
)


@query("profile_lengths", _LEN_SQL)
def profile_lengths(spark, sf_dir):
    return A.profile_lengths(raw_articles(spark, sf_dir), group="ticker")


@query("profile_newlines", _sql("""
SELECT ticker, url, arrival, length(content) AS n_chars FROM raw_articles
WHERE contains(content, chr(10)) OR contains(content, chr(13))""",
                                {"ticker": "s", "url": "s", "arrival": "i", "n_chars": "i"}))
def profile_newlines(spark, sf_dir):
    """Rows whose content still holds a line break (P8), title dropped (P10)."""
    raw = raw_articles(spark, sf_dir).drop("title")
    hit = raw.filter(F.col("content").contains("\n") | F.col("content").contains("\r"))
    return hit.select("ticker", "url", "arrival", F.length("content").alias("n_chars"))


@query("article_preview", _sql("""
SELECT ticker, url, arrival, length(content) AS n_chars FROM raw_articles
WHERE length(content) < 400 ORDER BY arrival LIMIT 5""",
                               {"ticker": "s", "url": "s", "arrival": "i", "n_chars": "i"}))
def article_preview(spark, sf_dir):
    """``df[len < 400].head()`` (P7 + P22): the limit is the feature, after a total order."""
    raw = raw_articles(spark, sf_dir)
    short = raw.filter(F.length("content") < 400).orderBy("arrival").limit(5)
    return short.select("ticker", "url", "arrival", F.length("content").alias("n_chars"))


# ---------------------------------------------------------------- counts on the clean table
_WINDOWED = "SELECT * FROM clean WHERE date >= DATE '2022-01-01' AND year(date) NOT IN (2026, 2028)"


def _clean_window(spark, sf_dir):
    return A.date_window(_clean(spark, sf_dir), lower="2022-01-01", exclude_years=[2026, 2028])


@query("counts_by_year", _sql(f"SELECT year(date) AS year, count(*) AS n FROM ({_WINDOWED}) GROUP BY 1",
                              {"year": "i", "n": "i"}, extra=CLEAN_CTE))
def counts_by_year(spark, sf_dir):
    return A.counts_by_year(_clean_window(spark, sf_dir))


@query("counts_by_year_ticker", _sql(
    f"SELECT year(date) AS year, ticker, count(*) AS n FROM ({_WINDOWED}) GROUP BY 1, 2",
    {"year": "i", "ticker": "s", "n": "i"}, extra=CLEAN_CTE))
def counts_by_year_ticker(spark, sf_dir):
    return A.counts_by_year(_clean_window(spark, sf_dir), by_ticker=True)


@query("counts_by_ticker", _sql(
    "SELECT ticker, count(*) AS n, count(*) FILTER (WHERE date < DATE '2022-01-01') AS n_before "
    "FROM clean GROUP BY ticker", {"ticker": "s", "n": "i", "n_before": "i"}, extra=CLEAN_CTE))
def counts_by_ticker(spark, sf_dir):
    """Articles per ticker (A8, A14) and how many fall before the lower bound (P4 complement)."""
    return A.counts_by_ticker(_clean(spark, sf_dir), before_day="2022-01-01")


# ---------------------------------------------------------------- date_clip on bars
@query("date_clip", sql_finish(with_views(["bars"], """
SELECT ticker, date, close FROM bars
WHERE date >= DATE '1996-01-01' AND date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
  AND year(date) NOT IN (1997, 1999)"""), {"ticker": "s", "date": "dt", "close": "d"}))
def date_clip(spark, sf_dir):
    """Inclusive range [1996-01-01, 2000-12-31] minus two whole years, over the bars."""
    b = bars(spark, sf_dir)
    return A.date_window(b, lower="1996-01-01", upper="2000-12-31", exclude_years=[1997, 1999]).select(
        "ticker", "date", "close")


# ---------------------------------------------------------------- date_formats
# Order dates rendered into the sources' formats; every 9th order gets a malformed variant.
_FMT_SQL = sql_finish("""
SELECT o_orderkey,
       CAST(try_strptime(replace(regexp_extract(s5, '(\\d{1,2}[-/]\\d{1,2}[-/]\\d{4})', 1), '-', '/'), '%d/%m/%Y') AS DATE) AS f5,
       coalesce(try_strptime(v6, '%d/%m/%Y, %H:%M'), try_strptime(v6, '%d/%m/%Y %H:%M'),
                try_strptime(v6, '%d/%m/%Y'), try_strptime(v6, '%d/%m/%Y, %H:%M:%S'),
                try_strptime(v6, '%d/%m/%Y %H:%M:%S')) AS f6,
       CAST(try_strptime(substr(s7, 1, 10), '%Y-%m-%d') AS DATE) AS f7,
       CAST(try_strptime(CASE WHEN regexp_matches(s8, '^\\d{1,2}/\\d{1,2}/\\d{2}$')
                              THEN CAST(CASE WHEN CAST(split_part(s8, '/', 3) AS INTEGER) < 69
                                             THEN 2000 ELSE 1900 END + CAST(split_part(s8, '/', 3) AS INTEGER) AS VARCHAR)
                                   || '-' || split_part(s8, '/', 2) || '-' || split_part(s8, '/', 1) END,
                         '%Y-%m-%d') AS DATE) AS f8
FROM (
  SELECT o_orderkey, s5, s7,
         split_part(s8raw, ' ', 1) AS s8,
         trim(split_part(CASE WHEN strpos(s6, ',') > 0 THEN trim(substr(s6, strpos(s6, ',') + 1)) ELSE s6 END, '(', 1)) AS v6
  FROM (
    SELECT o_orderkey,
           'Ngày ' || strftime(o_orderdate, '%-d-%-m-%Y') || ' 10:00' AS s5,
           CASE WHEN o_orderkey % 9 = 0 THEN strftime(o_orderdate, '%-d/%-m/%Y') || ', 10:00'
                ELSE 'Thứ hai, ' || strftime(o_orderdate, '%-d/%-m/%Y') || ', 10:00 (GMT+7)' END AS s6,
           strftime(o_orderdate, '%Y-%m-%d') || 'T00:30:00+07:00' AS s7,
           CASE WHEN o_orderkey % 9 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%d/%m/%y') END
             || ' 08:15' AS s8raw
    FROM orders
  )
)""", {"o_orderkey": "i", "f5": "dt", "f6": "ts", "f7": "dt", "f8": "dt"})


@query("date_formats", _FMT_SQL)
def date_formats(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    bad = F.col("o_orderkey") % 9 == 0
    s5 = F.concat(F.lit("Ngày "), F.date_format("o_orderdate", "d-M-yyyy"), F.lit(" 10:00"))
    s6 = F.when(bad, F.concat(F.date_format("o_orderdate", "d/M/yyyy"), F.lit(", 10:00"))).otherwise(
        F.concat(F.lit("Thứ hai, "), F.date_format("o_orderdate", "d/M/yyyy"), F.lit(", 10:00 (GMT+7)")))
    s7 = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:30:00+07:00"))
    s8 = F.concat(F.when(bad, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.date_format("o_orderdate", "dd/MM/yy")), F.lit(" 08:15"))
    return o.select(
        "o_orderkey", D.parse_common(s5).alias("f5"), D.parse_vnexpress(s6).alias("f6"),
        D.parse_iso_local(s7).alias("f7"), D.parse_two_digit_year(s8).alias("f8"),
    )


# ---------------------------------------------------------------- A19 counts of the stages
@query("stage_counts", sql_finish("SELECT *, n_before - n_after AS n_removed FROM (" + with_views(["raw_articles", "names"], """
SELECT 'articles' AS stage, (SELECT count(*) FROM raw_articles) AS n_before, (SELECT count(*) FROM clean) AS n_after
UNION ALL SELECT 'window', (SELECT count(*) FROM clean), (SELECT count(*) FROM clean WHERE date >= DATE '2022-01-01')
UNION ALL SELECT 'one name', (SELECT count(*) FROM names), (SELECT count(DISTINCT ticker) FROM names)""", extra=CLEAN_CTE) + ")",
    {"stage": "s", "n_before": "i", "n_after": "i", "n_removed": "i"}))
def stage_counts(spark, sf_dir):
    """Rows before, after and removed by the cleaning, the date window and the one-name rule (A19), observed while the stages write
    their results; only the counts meet on the driver."""
    counted = Counted()
    clean = counted("clean", A.clean_articles(counted("raw", raw_articles(spark, sf_dir))))
    stored(counted("window", A.date_window(clean, lower="2022-01-01")), "articles")
    entries = counted("names", M.first_name_per_ticker(counted("map", stored(name_dictionary(spark, sf_dir), "names"))).where("kept"))
    stored(entries, "first-names")
    n = counted.counts()
    stages = [("articles", "raw", "clean"), ("window", "clean", "window"), ("one name", "map", "names")]
    return spark.createDataFrame([(s, n[a], n[b], n[a] - n[b]) for s, a, b in stages], "stage string, n_before long, n_after long, n_removed long")
