"""Formulaic alphas per ticker (pipeline stage 11, SURVEY §2.9).

The reference evaluates formula text with ``eval``; here ``formulas`` compiles the text to a
``Column``. Over the multi-ticker table every alpha is one ``CASE ticker WHEN ... END``, so all
tickers run in a single projection. The registry also holds each shipped formula as SQL, which only the oracles use.
Rules kept from the reference:
  * a formula whose inputs are missing (no sentiment for that ticker, or the
    column is absent) yields 0.0 for the whole column;
  * afterwards ±inf / NaN become NULL and incomplete rows are dropped (P12).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import SENTIMENT_COLUMNS
from .formulas import with_formulas

c = F.col


@dataclass(frozen=True)
class Formula:
    """One alpha: the shipped numpy text, its input columns, and the same formula as
    a Spark SQL expression (numpy bool × number → CAST(.. AS DOUBLE), np.where →
    CASE, np.sign → sign, a zero divisor → NULL)."""
    text: str
    inputs: tuple[str, ...]
    sql: str


def _f(text, inputs, sql):
    return Formula(text, tuple(inputs), sql)


# The shipped formula set per ticker (alpha_1..alpha_5): text, inputs, SQL form.
_A1 = _f("df['sentiment_ma5'] * (df['close'] - df['sma_20'])", ["sentiment_ma5", "close", "sma_20"],
         "sentiment_ma5 * (close - sma_20)")
_A2 = _f("(df['sentiment_score'] > 0) * df['volume']", ["sentiment_score", "volume"],
         "CAST(sentiment_score > 0 AS DOUBLE) * volume")

FORMULAS: dict[str, dict[str, Formula]] = {
    "BID": {
        "alpha_1": _A1,
        "alpha_2": _A2,
        "alpha_3": _f("np.where(df['rsi'] < 30, df['sentiment_score'], 0) * df['vwap']",
                      ["rsi", "sentiment_score", "vwap"],
                      "(CASE WHEN rsi < 30 THEN sentiment_score ELSE 0.0 END) * vwap"),
        "alpha_4": _f("df['sentiment_diff'] * (df['close'] - df['bb_lower']) / df['volatility']",
                      ["sentiment_diff", "close", "bb_lower", "volatility"],
                      "sentiment_diff * (close - bb_lower) / NULLIF(volatility, 0)"),
        "alpha_5": _f("np.where(df['close'] > df['sma_5'], df['sentiment_ma5'], 0) * df['returns']",
                      ["close", "sma_5", "sentiment_ma5", "returns"],
                      "(CASE WHEN close > sma_5 THEN sentiment_ma5 ELSE 0.0 END) * returns"),
    },
    "FPT": {
        "alpha_1": _A1,
        "alpha_2": _A2,
        "alpha_3": _f("np.where(df['rsi'] < 30, df['sentiment_score'] * df['close'], 0)",
                      ["rsi", "sentiment_score", "close"],
                      "CASE WHEN rsi < 30 THEN sentiment_score * close ELSE 0.0 END"),
        "alpha_4": _f("df['sentiment_diff'] * (df['bb_upper'] - df['close'])",
                      ["sentiment_diff", "bb_upper", "close"],
                      "sentiment_diff * (bb_upper - close)"),
        "alpha_5": _f("df['vwap'] * (df['close'] - df['bb_lower']) * np.sign(df['sentiment_score'])",
                      ["vwap", "close", "bb_lower", "sentiment_score"],
                      "vwap * (close - bb_lower) * sign(sentiment_score)"),
    },
    "VIC": {
        "alpha_1": _A1,
        "alpha_2": _A2,
        "alpha_3": _f("df['sentiment_diff'] * (df['close'] - df['bb_lower'])",
                      ["sentiment_diff", "close", "bb_lower"],
                      "sentiment_diff * (close - bb_lower)"),
        "alpha_4": _f("df['rsi'] * (df['vwap'] - df['close'])", ["rsi", "vwap", "close"],
                      "rsi * (vwap - close)"),
        "alpha_5": _f("np.where((df['sentiment_score'] > 0) & (df['close'] > df['sma_5']), df['volatility'], 0)",
                      ["sentiment_score", "close", "sma_5", "volatility"],
                      "CASE WHEN sentiment_score > 0 AND close > sma_5 THEN volatility ELSE 0.0 END"),
    },
    "VJC": {
        "alpha_1": _A1,
        "alpha_2": _A2,
        "alpha_3": _f("np.where(df['rsi'] < 30, df['sentiment_score'] * df['vwap'], 0)",
                      ["rsi", "sentiment_score", "vwap"],
                      "CASE WHEN rsi < 30 THEN sentiment_score * vwap ELSE 0.0 END"),
        "alpha_4": _f("df['volatility'] * (df['bb_upper'] - df['close'])", ["volatility", "bb_upper", "close"],
                      "volatility * (bb_upper - close)"),
        "alpha_5": _f("df['sentiment_diff'] * (df['close'] - df['open'])", ["sentiment_diff", "close", "open"],
                      "sentiment_diff * (close - open)"),
    },
    "VNM": {
        "alpha_1": _A1,
        "alpha_2": _A2,
        "alpha_3": _f("df['sentiment_diff'] * (df['vwap'] - df['close'])", ["sentiment_diff", "vwap", "close"],
                      "sentiment_diff * (vwap - close)"),
        "alpha_4": _f("np.where(df['close'] > df['bb_upper'], 0, df['sentiment_score'] * df['volatility'])",
                      ["close", "bb_upper", "sentiment_score", "volatility"],
                      "CASE WHEN close > bb_upper THEN 0.0 ELSE sentiment_score * volatility END"),
        "alpha_5": _f("df['sentiment_ma5'] * (df['rsi'] - 50)", ["sentiment_ma5", "rsi"],
                      "sentiment_ma5 * (rsi - 50)"),
    },
}

ALPHA_NAMES = ["alpha_1", "alpha_2", "alpha_3", "alpha_4", "alpha_5"]


def formula_table(spark):
    """The registry as a table ``ticker STRING, formulas MAP<STRING,STRING>`` (for sinks)."""
    rows = [(t, {k: f.text for k, f in fs.items()}) for t, fs in FORMULAS.items()]
    return spark.createDataFrame(rows, "ticker string, formulas map<string,string>")


def drop_non_finite(df: DataFrame, key: str = "ticker") -> DataFrame:
    """Drop rows with ±inf, NaN or NULL in a double column (P12: inf → NaN, then dropna).

    A pure filter: the rows are dropped anyway, so the columns need no rewrite.
    ``x * 0.0 = 0.0`` is false for ±inf and NaN and NULL for NULL, and references
    ``x`` once: Catalyst inlines the alpha expressions into a pushed-down filter,
    so every extra reference would repeat a whole CASE in the generated code.
    Sentiment columns only count for tickers that have sentiment.
    """
    cols = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    avail = "sentiment_available" in df.columns
    parts = []
    for x in cols:
        ok = f"coalesce(`{x}` * 0.0 = 0.0, false)"
        if x in SENTIMENT_COLUMNS and avail:
            ok = f"({ok} OR NOT sentiment_available)"
        parts.append(ok)
    return df.filter(F.expr(" AND ".join(parts))) if parts else df


def apply_alphas(features: DataFrame, registry: dict[str, dict[str, Formula]] | None = None, key: str = "ticker",
                 texts: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Add alpha_1..alpha_5 for every ticker of ``texts`` (ticker → name → formula text; else those of ``registry``); others are left
    out. The texts are compiled (``formulas``); the registry's SQL forms are not used here."""
    texts = texts or {t: {n: f.text for n, f in fs.items()} for t, fs in (registry or FORMULAS).items()}
    df = features.filter(c(key).isin(list(texts)))
    flags = {x: "sentiment_available" for x in SENTIMENT_COLUMNS} if "sentiment_available" in df.columns else None
    return drop_non_finite(with_formulas(df, texts, ALPHA_NAMES, key, available=flags), key)
