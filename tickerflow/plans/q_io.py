"""Queries over sources/sinks (S1-S11), market frames (U2, P14, P17, O4, O5) and streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import articles as A
from ..operators import features as feat
from ..operators import market as MK
from ..operators import relations as R
from ..operators.common import global_row_number, stored
from ..session import scratch_path
from ..sources import io
from ..streaming import streams as ST
from .catalog import query
from .normalize import sql_finish
from .q_articles import CLEAN_CTE, _CLEAN_KINDS
from .q_features import FEATURE_KINDS, full_features_sql
from .q_linking import SCAN_CTE, TMAP_CTE, _scan, _tmap
from .views import TICKERS, bars, listing, name_dictionary, raw_articles, sentiment_scores, table, with_views

# ---------------------------------------------------------------- U2 / P17 company reports


@query("report_union", sql_finish("""
SELECT s_suppkey AS item, s_acctbal AS cash, s_nationkey AS nation, 'VIC' AS "Symbol",
       'BalanceSheet' AS "Report_Type" FROM supplier
UNION ALL BY NAME
SELECT c_custkey AS item, c_acctbal AS revenue, c_mktsegment AS segment, 'FPT' AS "Symbol",
       'IncomeStatement' AS "Report_Type" FROM customer""",
    {"item": "i", "cash": "d", "nation": "i", "Symbol": "s", "Report_Type": "s", "revenue": "d", "segment": "s"}))
def report_union(spark, sf_dir):
    """Heterogeneous report frames tagged with Symbol / Report_Type, unioned by name
    with missing columns as NULL (U2, P17)."""
    bal = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("item"), F.col("s_acctbal").alias("cash"), F.col("s_nationkey").alias("nation"))
    inc = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("item"), F.col("c_acctbal").alias("revenue"), F.col("c_mktsegment").alias("segment"))
    frames = [MK.tag_report(bal, None, "VIC", "BalanceSheet"), MK.tag_report(inc, None, "FPT", "IncomeStatement")]
    return MK.union_all(frames, allow_missing=True)


_IDX_SQL = sql_finish(with_views(["bars"], """
SELECT 'VNINDEX' AS "Symbol", date AS "Date", open AS "Open", close AS "Close", volume AS "Volume"
FROM bars WHERE ticker = 'BID'
UNION ALL
SELECT 'VN30', date, NULL, close, volume FROM bars WHERE ticker = 'VIC'"""),
    {"Symbol": "s", "Date": "dt", "Open": "d", "Close": "d", "Volume": "d"})


@query("index_union", _IDX_SQL)
def index_union(spark, sf_dir):
    """Index frames with vendor spellings: columns chosen by candidate list (P14);
    a frame without Volume is skipped, one without Open keeps NULL opens (U2)."""
    b = bars(spark, sf_dir)
    a = b.filter(F.col("ticker") == "BID").select(F.col("date").alias("time"), "open", "close", "volume")
    v = b.filter(F.col("ticker") == "VIC").select(
        F.col("date").alias("TradingDate"), F.col("close").alias("ClosePrice"), F.col("volume").alias("TotalVolume"))
    c = b.filter(F.col("ticker") == "FPT").select(F.col("date").alias("Date"), F.col("close").alias("Close"))
    frames = [MK.standardize_index_frame(a, "VNINDEX"), MK.standardize_index_frame(v, "VN30"),
              MK.standardize_index_frame(c, "HNX")]
    return MK.union_all(frames, allow_missing=True).select("Symbol", "Date", "Open", "Close", "Volume")


@query("top_symbols", sql_finish("""
SELECT * FROM (SELECT s_name AS symbol, s_suppkey AS ord FROM supplier ORDER BY s_suppkey LIMIT 10)
WHERE symbol <> 'Supplier#000000003'""", {"symbol": "s", "ord": "i"}))
def top_symbols(spark, sf_dir):
    """First ten symbols in list order, then the index symbol removed."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("symbol"), F.col("s_suppkey").alias("ord"))
    return MK.top_symbols(s, 10, "Supplier#000000003")


@query("symbol_halves", sql_finish("""
SELECT symbol, ord, CASE WHEN row_number() OVER (ORDER BY ord) <= floor(count(*) OVER () / 2) THEN 1 ELSE 2 END AS part
FROM (SELECT s_name AS symbol, s_suppkey AS ord FROM supplier)""", {"symbol": "s", "ord": "i", "part": "i"}))
def symbol_halves(spark, sf_dir):
    """The symbol list split at its midpoint."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("symbol"), F.col("s_suppkey").alias("ord"))
    return MK.split_halves(s)


# ---------------------------------------------------------------- S1 keyword folders
def _keyword_sets(spark, sf_dir):
    """Per ticker of the dictionary: its names (direct), the next ticker's names (competitors), the names
    of the fifth one after it (macro; missing for every fifth ticker), in the order of the tickers."""
    names = stored(name_dictionary(spark, sf_dir), "keyword-names")
    n = stored(global_row_number(names.select("ticker").distinct(), ["ticker"]), "keyword-tickers")
    plan = n
    for col, step in (("comp", 1), ("macro", 5)):
        plan = plan.join(n.select((F.col("rn") - step).alias("rn"), F.col("ticker").alias(col)), "rn", "left")
    plan = plan.withColumn("macro", F.when(F.col("rn") % 5 != 0, F.col("macro")))

    def lists(col, alias):
        j = plan.join(names.withColumnRenamed("ticker", col), col)
        return j.groupBy("ticker").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))),
                                                   lambda x: x["name"]).alias(alias))

    out = plan.join(lists("ticker", "keywords_direct"), "ticker", "left") \
        .join(lists("comp", "keywords_competitors"), "ticker", "left") \
        .join(lists("macro", "keywords_macro"), "ticker", "left")
    return out.select("ticker", "keywords_direct", "keywords_competitors", "keywords_macro")


@query("keyword_list", sql_finish(with_views(["names"], """
SELECT ticker, grp AS "group", row_number() OVER (PARTITION BY ticker ORDER BY gi, ord) - 1 AS pos, name AS keyword
FROM (
  SELECT tk.ticker, 0 AS gi, 'keywords_direct' AS grp, n.name, n.ord FROM tk JOIN names n ON n.ticker = tk.ticker
  UNION ALL
  SELECT tk.ticker, 1, 'keywords_competitors', n.name, n.ord FROM tk JOIN names n ON n.ticker = tk.comp
  UNION ALL
  SELECT tk.ticker, 2, 'keywords_macro', n.name, n.ord FROM tk JOIN names n ON n.ticker = tk.macro
)""", extra="""
tn AS (SELECT ticker, row_number() OVER (ORDER BY ticker) AS rn FROM (SELECT DISTINCT ticker FROM names)),
tk AS (SELECT t.ticker, c.ticker AS comp, CASE WHEN t.rn % 5 <> 0 THEN m.ticker END AS macro
       FROM tn t LEFT JOIN tn c ON c.rn = t.rn + 1 LEFT JOIN tn m ON m.rn = t.rn + 5)"""),
    {"ticker": "s", "group": "s", "pos": "i", "keyword": "s"}))
def keyword_list(spark, sf_dir):
    """Keyword sets written as JSON files, read back as one flat list."""
    folder = scratch_path(spark, "keywords")
    io.write_keyword_sets(_keyword_sets(spark, sf_dir), folder)
    return io.load_keywords(spark, folder, multi_line=False)


@query("map_scan", sql_finish(with_views(["listing"], """
SELECT CAST(floor(ord / 1000) AS BIGINT) AS chunk,
       row_number() OVER (PARTITION BY floor(ord / 1000) ORDER BY ord) - 1 AS pos, name, ticker
FROM tmap""", extra=TMAP_CTE), {"chunk": "i", "pos": "i", "name": "s", "ticker": "s"}))
def map_scan(spark, sf_dir):
    """The ticker map stored as JSON objects and read back in key order."""
    folder = scratch_path(spark, "namemap")
    io.write_name_maps(_tmap(spark, sf_dir), folder)
    return io.read_name_maps(spark, folder)


# ---------------------------------------------------------------- S2 / S8 / O1 and S3 / S9 / S11 round trips
@query("json_roundtrip", sql_finish(with_views(["raw_articles"], "SELECT * FROM clean", extra=CLEAN_CTE),
                                    _CLEAN_KINDS))
def json_roundtrip(spark, sf_dir):
    """Clean articles sorted per ticker by date (O1), written as JSON per ticker (S8),
    read back with the declared schema and the ticker from the folder (S2)."""
    folder = scratch_path(spark, "articles-json")
    clean = A.clean_articles(raw_articles(spark, sf_dir))
    io.write_articles_json(A.sort_for_write(clean), folder)
    schema = T.StructType(schemas.CLEAN_ARTICLE.fields + [T.StructField("arrival", T.LongType(), True)])
    back = io.read_articles_json(spark, folder, schema)
    return back.select("ticker", "source", "date", "title", "content", "url", "arrival")


@query("csv_roundtrip", full_features_sql("SELECT * FROM full_features", {"ticker": "s", "date": "dt",
                                                                          **FEATURE_KINDS}))
def csv_roundtrip(spark, sf_dir):
    """Feature table written as CSV per ticker only when non-empty (S9, S11) and
    read back with its declared schema (S3)."""
    folder = scratch_path(spark, "features-csv")
    fe = feat.build_features(bars(spark, sf_dir), sentiment_scores(spark, sf_dir)).drop("sentiment_available")
    io.write_csv(fe, folder)
    back = io.read_csv(spark, folder, schemas.FEATURES)
    return back.select("ticker", "date", *feat.FEATURE_COLUMNS)


@query("relations_roundtrip", sql_finish(with_views(["raw_articles", "names"], """
SELECT target, related, n, CAST(rk <= 10 AS BIGINT) AS in_top10 FROM (
  SELECT target, related, n, row_number() OVER (PARTITION BY target ORDER BY n DESC, related) AS rk
  FROM (SELECT target, ticker AS related, count(*) AS n FROM (SELECT DISTINCT arrival, target, ticker FROM hits)
        GROUP BY 1, 2)
) WHERE rk <= 20""", extra=SCAN_CTE), {"target": "s", "related": "s", "n": "i", "in_top10": "i"}))
def relations_roundtrip(spark, sf_dir):
    """Relations documents {target, top_related[10], stats{20}} written and read back."""
    s = _scan(spark, sf_dir)
    doc = R.relations_document(R.related_counts(s, target="ticker", related="related"),
                               spark.createDataFrame([(t,) for t in TICKERS], "target string"))
    folder = scratch_path(spark, "relations")
    io.write_relations(doc, folder)
    back = io.read_relations(spark, folder)
    return back.select("target", "top_related", F.explode(F.map_entries("stats")).alias("e")).select(
        "target", F.col("e.key").alias("related"), F.col("e.value").alias("n"),
        F.array_contains("top_related", F.col("e.key")).cast("long").alias("in_top10"))


# ---------------------------------------------------------------- T1 / T2 streams over the events file
def _events_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    s = ST.file_stream(spark, f"{sf_dir.rstrip('/')}/events*.parquet", schema)
    # event time must be TIMESTAMP; the file holds wall-clock TIMESTAMP_NTZ (session zone is UTC)
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_seen_urls", sql_finish(
    "SELECT DISTINCT 'https://e.vn/a' || CAST(event_id % 997 AS VARCHAR) AS url FROM events", {"url": "s"}))
def stream_seen_urls(spark, sf_dir):
    """Incremental intake, one row per URL inside the watermark (T1), drained with availableNow."""
    s = _events_stream(spark, sf_dir).withColumn(
        "url", F.concat(F.lit("https://e.vn/a"), (F.col("event_id") % 997).cast("string")))
    out = ST.run_to_table(spark, ST.intake_unique_urls(s.select("url", "ts")), "seen-urls", mode="append")
    return out.select("url")


@query("stream_mentions", sql_finish("""
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type AS related, count(*) AS n
FROM events GROUP BY 1, 2""", {"day": "dt", "related": "s", "n": "i"}))
def stream_mentions(spark, sf_dir):
    """Mentions per related key and day over a stream (T2), update mode merged by batch."""
    s = _events_stream(spark, sf_dir).select("ts", F.col("event_type").alias("related"))
    out = ST.run_to_table(spark, ST.daily_mentions(s), "mentions", mode="update", upsert_keys=["w", "related"])
    return out.select(F.to_date(F.col("w.start")).alias("day"), "related", "n")
