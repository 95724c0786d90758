"""Queries over the price/sentiment feature stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators.articles import filtered_by
from ..operators import indicators as ind
from ..operators import market
from .catalog import query
from .normalize import sql_finish
from .views import bars, sentiment_scores, table, with_views, _ticker_of

W = "PARTITION BY ticker ORDER BY date"


def _roll(agg: str, col: str, n: int) -> str:
    frame = f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({col}) OVER {frame} = {n} THEN {agg}({col}) OVER {frame} END"


_D = "d"

# ---------------------------------------------------------------- price_bars
_PRICE_BARS_SQL = sql_finish(
    with_views(["bars"], "SELECT ticker, date, open, high, low, close, volume FROM bars"),
    {"ticker": "s", "date": "dt", "open": _D, "high": _D, "low": _D, "close": _D, "volume": _D},
)


@query("price_bars", _PRICE_BARS_SQL)
def price_bars(spark, sf_dir):
    """Vendor frames with vendor column spellings → S7 fallback → P13 rename → U1 → O2."""
    b = bars(spark, sf_dir)
    vendor = b.select(
        F.col("ticker").alias("Ticker"), F.col("date").alias("Time"), F.col("open").alias("Open"),
        F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close"),
        F.col("volume").alias("Volume"),
    )
    primary = vendor.filter(F.col("Ticker").isin("BID", "FPT", "VIC"))
    out = market.normalize_price_columns(feat.priority_union([primary, vendor], key="Ticker"))
    return market.sort_prices(out)


# ---------------------------------------------------------------- returns_typical_price
_RETURNS_SQL = sql_finish(
    with_views(["bars"], f"""
SELECT ticker, date, close,
       close / NULLIF(lag(close) OVER ({W}), 0) - 1 AS returns,
       (high + low + close) / 3 AS vwap
FROM bars"""),
    {"ticker": "s", "date": "dt", "close": _D, "returns": _D, "vwap": _D},
)


@query("returns_typical_price", _RETURNS_SQL)
def returns_typical_price(spark, sf_dir):
    w = ind.series_window()
    return bars(spark, sf_dir).select(
        "ticker", "date", "close", ind.pct_change("close", w).alias("returns"), ind.typical_price().alias("vwap")
    )


# ---------------------------------------------------------------- sma_bollinger_volatility
_SMA_SQL = sql_finish(
    with_views(["bars"], f"""
SELECT ticker, date,
       {_roll('avg', 'close', 5)} AS sma_5,
       {_roll('avg', 'close', 20)} AS sma_20,
       {_roll('avg', 'close', 20)} + 2 * {_roll('stddev_pop', 'close', 20)} AS bb_upper,
       {_roll('avg', 'close', 20)} - 2 * {_roll('stddev_pop', 'close', 20)} AS bb_lower,
       {_roll('stddev_samp', 'close', 20)} AS volatility
FROM bars"""),
    {"ticker": "s", "date": "dt", "sma_5": _D, "sma_20": _D, "bb_upper": _D, "bb_lower": _D, "volatility": _D},
)


@query("sma_bollinger_volatility", _SMA_SQL)
def sma_bollinger_volatility(spark, sf_dir):
    return ind.add_price_indicators(bars(spark, sf_dir)).select(
        "ticker", "date", "sma_5", "sma_20", "bb_upper", "bb_lower", "volatility"
    )


# ---------------------------------------------------------------- rsi_wilder (recursive oracle)
_RSI_SQL = sql_finish(
    with_views(["bars"], """
SELECT b.ticker, b.date,
       CASE WHEN b.i < 13 THEN NULL WHEN r.ed = 0 THEN 100.0
            ELSE 100.0 - 100.0 / (1.0 + r.eu / r.ed) END AS rsi
FROM b JOIN r ON b.ticker = r.ticker AND b.i = r.i""", extra=f"""
b AS (
  SELECT ticker, date, row_number() OVER ({W}) - 1 AS i,
         coalesce(greatest(close - lag(close) OVER ({W}), 0.0), 0.0) AS up,
         coalesce(greatest(lag(close) OVER ({W}) - close, 0.0), 0.0) AS dn
  FROM bars
),
r AS (
  SELECT ticker, i, up AS eu, dn AS ed FROM b WHERE i = 0
  UNION ALL
  SELECT b.ticker, b.i, r.eu * (13.0 / 14.0) + b.up / 14.0, r.ed * (13.0 / 14.0) + b.dn / 14.0
  FROM r JOIN b ON b.ticker = r.ticker AND b.i = r.i + 1
)""", recursive=True),
    {"ticker": "s", "date": "dt", "rsi": _D},
)


@query("rsi_wilder", _RSI_SQL)
def rsi_wilder(spark, sf_dir):
    return ind.add_rsi(bars(spark, sf_dir)).select("ticker", "date", "rsi")


# ---------------------------------------------------------------- daily_sentiment
_DAILY_SQL = sql_finish(
    with_views(["scores"], "SELECT ticker, date, avg(target_score) AS target_score, count(*) AS n FROM scores GROUP BY 1, 2"),
    {"ticker": "s", "date": "dt", "target_score": _D, "n": "i"},
)


@query("daily_sentiment", _DAILY_SQL)
def daily_sentiment(spark, sf_dir):
    s = sentiment_scores(spark, sf_dir)
    return s.groupBy("ticker", "date").agg(
        F.avg("target_score").alias("target_score"), F.count(F.lit(1)).alias("n")
    )


# ---------------------------------------------------------------- sentiment_features
_SENT_CTE = f"""
daily AS (SELECT ticker, date, avg(target_score) AS s FROM scores GROUP BY 1, 2),
j AS (SELECT b.ticker, b.date, d.s FROM bars b LEFT JOIN daily d ON b.ticker = d.ticker AND b.date = d.date),
f AS (
  SELECT ticker, date,
         coalesce(last_value(s IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0)
           AS sentiment_score
  FROM j
),
sf AS (
  SELECT ticker, date, sentiment_score,
         sentiment_score - lag(sentiment_score) OVER ({W}) AS sentiment_diff,
         coalesce({_roll('avg', 'sentiment_score', 5)}, 0.0) AS sentiment_ma5
  FROM f
)"""

_SENT_SQL = sql_finish(
    with_views(["bars", "scores"], "SELECT * FROM sf", extra=_SENT_CTE),
    {"ticker": "s", "date": "dt", "sentiment_score": _D, "sentiment_diff": _D, "sentiment_ma5": _D},
)


@query("sentiment_features", _SENT_SQL)
def sentiment_features(spark, sf_dir):
    daily = feat.daily_sentiment(sentiment_scores(spark, sf_dir))
    return feat.merge_sentiment(bars(spark, sf_dir), daily).select(
        "ticker", "date", "sentiment_score", "sentiment_diff", "sentiment_ma5"
    )


# ---------------------------------------------------------------- sentiment_source_fallback
_FALLBACK_SQL = sql_finish(
    with_views(["scores_all"], """
SELECT ticker, date, avg(target_score) AS target_score, count(*) AS n
FROM (
  SELECT ticker, date, target_score FROM p
  UNION ALL
  SELECT ticker, date, target_score FROM fb WHERE ticker NOT IN (SELECT ticker FROM p)
) u GROUP BY 1, 2""", extra="""
p AS (SELECT ticker, date, CASE WHEN l_returnflag = 'R' THEN target_score END AS target_score
      FROM scores_all WHERE ticker IN ('BID', 'VIC', 'VNM')),
fb AS (SELECT ticker, date, CASE WHEN l_returnflag = 'A' THEN target_score END AS target_score FROM scores_all)"""),
    {"ticker": "s", "date": "dt", "target_score": _D, "n": "i"},
)


@query("sentiment_source_fallback", _FALLBACK_SQL)
def sentiment_source_fallback(spark, sf_dir):
    """The preferred file (scores of returned items, three tickers) beats the
    plain file (scores of accepted items, all tickers)."""
    primary = sentiment_scores(spark, sf_dir, "R").filter(F.col("ticker").isin("BID", "VIC", "VNM"))
    fallback = sentiment_scores(spark, sf_dir, "A")
    chosen = feat.pick_source(primary, fallback)
    return chosen.groupBy("ticker", "date").agg(
        F.avg("target_score").alias("target_score"), F.count(F.lit(1)).alias("n")
    )


# ---------------------------------------------------------------- full_features
FEATURE_KINDS = {c: _D for c in feat.FEATURE_COLUMNS}

_FULL_CTE = _SENT_CTE + f""",
ind AS (
  SELECT ticker, date, open, high, low, close, volume,
         close / NULLIF(lag(close) OVER ({W}), 0) - 1 AS returns,
         (high + low + close) / 3 AS vwap,
         {_roll('avg', 'close', 5)} AS sma_5,
         {_roll('avg', 'close', 20)} AS sma_20,
         {_roll('avg', 'close', 20)} + 2 * {_roll('stddev_pop', 'close', 20)} AS bb_upper,
         {_roll('avg', 'close', 20)} - 2 * {_roll('stddev_pop', 'close', 20)} AS bb_lower,
         {_roll('stddev_samp', 'close', 20)} AS volatility
  FROM bars
),
rb AS (
  SELECT ticker, date, row_number() OVER ({W}) - 1 AS i,
         coalesce(greatest(close - lag(close) OVER ({W}), 0.0), 0.0) AS up,
         coalesce(greatest(lag(close) OVER ({W}) - close, 0.0), 0.0) AS dn
  FROM bars
),
r AS (
  SELECT ticker, i, up AS eu, dn AS ed FROM rb WHERE i = 0
  UNION ALL
  SELECT rb.ticker, rb.i, r.eu * (13.0 / 14.0) + rb.up / 14.0, r.ed * (13.0 / 14.0) + rb.dn / 14.0
  FROM r JOIN rb ON rb.ticker = r.ticker AND rb.i = r.i + 1
),
rsi AS (
  SELECT rb.ticker, rb.date,
         CASE WHEN rb.i < 13 THEN NULL WHEN r.ed = 0 THEN 100.0
              ELSE 100.0 - 100.0 / (1.0 + r.eu / r.ed) END AS rsi
  FROM rb JOIN r ON rb.ticker = r.ticker AND rb.i = r.i
),
full_features AS (
  SELECT ind.ticker, ind.date, open, high, low, close, volume, returns, vwap, rsi.rsi, sma_5, sma_20,
         bb_upper, bb_lower, volatility, sentiment_score, sentiment_diff, sentiment_ma5
  FROM ind JOIN rsi ON ind.ticker = rsi.ticker AND ind.date = rsi.date
           JOIN sf ON ind.ticker = sf.ticker AND ind.date = sf.date
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in feat.FEATURE_COLUMNS)}
)"""

FULL_FEATURES_CTE = _FULL_CTE


def full_features_sql(body: str, kinds: dict, extra: str = "") -> str:
    cte = _FULL_CTE + ("," + extra if extra.strip() else "")
    return sql_finish(with_views(["bars", "scores"], body, extra=cte, recursive=True), kinds)


@query("full_features", full_features_sql("SELECT * FROM full_features", {"ticker": "s", "date": "dt", **FEATURE_KINDS}))
def full_features(spark, sf_dir):
    return feat.build_features(bars(spark, sf_dir), sentiment_scores(spark, sf_dir)).drop("sentiment_available")


# ---------------------------------------------------------------- P9 equality filters
@query("equality_filters", sql_finish(with_views(["scores"], """
SELECT ticker, count(*) FILTER (WHERE target_score = 0) AS n_zero, count(*) FILTER (WHERE target_score IS NULL) AS n_missing
FROM scores GROUP BY ticker HAVING n_zero > 0"""),
    {"ticker": "s", "n_zero": "i", "n_missing": "i"}))
def equality_filters(spark, sf_dir):
    """Rows whose score equals 0, and rows without a score (P9), counted per ticker."""
    s = sentiment_scores(spark, sf_dir)
    zero = filtered_by(s, target_score=0.0).groupBy("ticker").agg(F.count(F.lit(1)).alias("n_zero"))
    none = filtered_by(s, target_score=None).groupBy("ticker").agg(F.count(F.lit(1)).alias("n_missing"))
    return zero.join(none, "ticker", "left").na.fill(0, ["n_missing"])
