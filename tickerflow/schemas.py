"""Declared schemas for every table the pipeline reads or writes."""

from pyspark.sql import types as T

S, D, L, I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


KEYWORD_SET = _struct(
    ("ticker", S),
    ("keywords_direct", T.ArrayType(S)),
    ("keywords_competitors", T.ArrayType(S)),
    ("keywords_macro", T.ArrayType(S)),
)

RAW_ARTICLE = _struct(
    ("source", S), ("keyword", S), ("title", S), ("url", S), ("published_date", S),
    ("content", S), ("ticker", S), ("arrival", L),
)

CLEAN_ARTICLE = _struct(
    ("ticker", S), ("source", S), ("date", T.DateType()), ("title", S), ("content", S), ("url", S),
)

TICKER_MAP = _struct(("ord", L), ("name", S), ("ticker", S))
ALIAS_MAP = _struct(("alias", S), ("ticker", S))
LISTING = _struct(("symbol", S), ("organ_name", S), ("organ_short_name", S))
TOKEN = _struct(("article_id", L), ("pos", I), ("word", S), ("ner_tag", S))

PRICE_BAR = _struct(
    ("ticker", S), ("date", T.DateType()), ("open", D), ("high", D), ("low", D), ("close", D), ("volume", D),
)

SENTIMENT = _struct(("ticker", S), ("date", T.DateType()), ("target_score", D))

FEATURE_COLUMNS = [
    "open", "high", "low", "close", "volume", "returns", "vwap", "rsi", "sma_5", "sma_20",
    "bb_upper", "bb_lower", "volatility", "sentiment_score", "sentiment_diff", "sentiment_ma5",
]

FEATURES = T.StructType(
    [T.StructField("ticker", S, True), T.StructField("date", T.DateType(), True)]
    + [T.StructField(c, D, True) for c in FEATURE_COLUMNS]
)

RELATIONS = T.StructType([
    T.StructField("target", S, True),
    T.StructField("top_related", T.ArrayType(S), True),
    # An explicit MapType: schema inference would turn this into a struct.
    T.StructField("stats", T.MapType(S, L), True),
])

LISTING_ITEM = _struct(
    ("ticker", S), ("keyword", S), ("source", S), ("page", I), ("pos", I), ("url", S), ("listing_date", S),
)

STORED_PAGE = _struct(
    ("page_id", L), ("ticker", S), ("keyword", S), ("source", S), ("page", I), ("url", S), ("html", S),
)
