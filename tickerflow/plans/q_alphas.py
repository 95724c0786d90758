"""Queries over the alpha stage (§2.9 L1-L17, P12) and the training set."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alphas as al
from ..operators import features as feat
from ..operators import learnset as ls
from ..operators.formulas import load_formulas, with_formulas
from ..session import scratch_path
from .catalog import query
from .normalize import sql_finish
from .q_features import _FULL_CTE, _roll, W
from .views import TICKERS, bars, sentiment_scores, with_views

# The oracle evaluates the registry's SQL form of each formula in DuckDB.
SQL_FORMULAS = {t: [al.FORMULAS[t][a].sql for a in al.ALPHA_NAMES] for t in TICKERS}
# Formulas that do not read a sentiment column (the rest are 0.0 without sentiment).
_NO_SENTIMENT = {(t, k) for t in TICKERS for k, a in enumerate(al.ALPHA_NAMES)
                 if not set(al.FORMULAS[t][a].inputs) & set(feat.SENTIMENT_COLUMNS)}

_FEATURES = feat.FEATURE_COLUMNS
_BASE_KINDS = {"ticker": "s", "date": "dt", **{c: "d" for c in _FEATURES}}
_ALPHA_KINDS = {**_BASE_KINDS, **{a: "d" for a in al.ALPHA_NAMES}}


def _alpha_select(source: str, tickers: list[str], without_sentiment: bool = False) -> str:
    cols = []
    for k, name in enumerate(al.ALPHA_NAMES):
        cases = []
        for t in tickers:
            e = SQL_FORMULAS[t][k]
            if without_sentiment and (t, k) not in _NO_SENTIMENT:
                e = "0.0"
            cases.append(f"WHEN ticker = '{t}' THEN CAST({e} AS DOUBLE)")
        cols.append(f"CASE {' '.join(cases)} END AS {name}")
    in_list = ", ".join(f"'{t}'" for t in tickers)
    return f"SELECT *, {', '.join(cols)} FROM {source} WHERE ticker IN ({in_list})"


def _finite_filter(cols: list[str]) -> str:
    return " AND ".join(f"({c} IS NOT NULL AND NOT isnan({c}) AND NOT isinf({c}))" for c in cols)


def alpha_cte(tickers: list[str]) -> str:
    return (
        f"alpha_raw AS ({_alpha_select('full_features', tickers)}),\n"
        f"alpha_ds AS (SELECT * FROM alpha_raw WHERE {_finite_filter(_FEATURES + al.ALPHA_NAMES)})"
    )


def _alpha_sql(tickers: list[str]) -> str:
    return sql_finish(
        with_views(["bars", "scores"], "SELECT * FROM alpha_ds",
                   extra=_FULL_CTE + ",\n" + alpha_cte(tickers), recursive=True),
        _ALPHA_KINDS,
    )


def alpha_dataset(spark, sf_dir):
    feats = feat.build_features(bars(spark, sf_dir), sentiment_scores(spark, sf_dir))
    return al.apply_alphas(feats).drop("sentiment_available")


def _register_ticker(t: str):
    @query(f"alpha_{t.lower()}", _alpha_sql([t]))
    def run(spark, sf_dir):
        feats = feat.build_features(bars(spark, sf_dir), sentiment_scores(spark, sf_dir))
        return al.apply_alphas(feats, {t: al.FORMULAS[t]}).drop("sentiment_available")

    return run


for _t in TICKERS:
    _register_ticker(_t)


@query("alpha_all", _alpha_sql(TICKERS))
def alpha_all(spark, sf_dir):
    """Flagship: indicators + sentiment + the five per-ticker formula sets, one plan."""
    return alpha_dataset(spark, sf_dir)


# ---------------------------------------------------------------- formula texts from JSON files
#: Texts as a model writes them: windows, unknown columns, text that isn't a formula.
_TEXTS = {
    "BID": {"a": "df['close'].pct_change(5) * np.sign(df['sentiment_score'])", "b": "df['volume'] / df['volume'].rolling(20).mean()", "c": "df['no_such'] + 1"},
    "FPT": {"a": "np.maximum(df['close'] - df['open'], 0) / (df['high'] - df['low'])", "b": "np.where((df['rsi'] > 70) | ~(df['close'] >= df['sma_5']), -1, 1) * df['returns'].abs()", "c": "import os"},
    "VIC": {"a": "(df['close'].shift(1) - df['close'].shift(2)) ** 2", "b": "df['close'].rolling(window=10).max() - df['close']", "c": "df['returns'].diff().fillna(0.5)"},
}
_TEXT_SQL = sql_finish(with_views(["bars", "scores"], f"""
SELECT ticker, date, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b, CAST(c AS DOUBLE) AS c FROM (
  SELECT ticker, date,
    CASE ticker WHEN 'BID' THEN (close / lag(close, 5) OVER ({W}) - 1) * sign(sentiment_score)
      WHEN 'FPT' THEN greatest(close - open, 0) / nullif(high - low, 0)
      ELSE pow(lag(close, 1) OVER ({W}) - lag(close, 2) OVER ({W}), 2) END AS a,
    CASE ticker WHEN 'BID' THEN volume / CASE WHEN count(*) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 20 THEN avg(volume) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) END
      WHEN 'FPT' THEN CASE WHEN rsi > 70 OR close < sma_5 THEN -1 ELSE 1 END * abs(returns)
      ELSE CASE WHEN count(*) OVER ({W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) = 10 THEN max(close) OVER ({W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) END - close END AS b,
    CASE ticker WHEN 'VIC' THEN coalesce(returns - lag(returns) OVER ({W}), 0.5) ELSE 0.0 END AS c
  FROM full_features WHERE ticker IN ('BID', 'FPT', 'VIC')
) WHERE a IS NOT NULL AND b IS NOT NULL""", extra=_FULL_CTE, recursive=True), {"ticker": "s", "date": "dt", "a": "d", "b": "d", "c": "d"})


@query("alpha_texts", _TEXT_SQL)
def alpha_texts(spark, sf_dir):
    """Formula texts written as one JSON file for each ticker, loaded and compiled: windows and functions of numpy; a text that can't be
    used gives 0.0 (P12)."""
    folder = scratch_path(spark, "formulas")
    rows = spark.createDataFrame([(t, {k: v for k, v in own.items()}) for t, own in _TEXTS.items()], "ticker string, formulas map<string, string>")
    for r in rows.select("ticker", F.to_json("formulas").alias("json")).collect():  # one small file for each ticker
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{r['ticker']}_formulas.json")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(r["json"].encode()))
        out.close()
    feats = feat.build_features(bars(spark, sf_dir), sentiment_scores(spark, sf_dir))
    texts = load_formulas(spark, folder)
    out = with_formulas(feats.where(F.col("ticker").isin(list(texts))), texts, available={x: "sentiment_available" for x in feat.SENTIMENT_COLUMNS})
    return al.drop_non_finite(out.select("ticker", "date", "a", "b", "c"))


# ---------------------------------------------------------------- alpha_missing_inputs
_NS_FEATURES = [c for c in _FEATURES if c not in feat.SENTIMENT_COLUMNS]
_NS_CTE = _FULL_CTE.replace(
    "full_features AS (", "full_features_unused AS ("
) + f""",
nsf AS (
  SELECT ind.ticker, ind.date, open, high, low, close, volume, returns, vwap, rsi.rsi, sma_5, sma_20,
         bb_upper, bb_lower, volatility
  FROM ind JOIN rsi ON ind.ticker = rsi.ticker AND ind.date = rsi.date
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _NS_FEATURES)}
),
ns_raw AS ({_alpha_select('nsf', TICKERS, without_sentiment=True)})"""

_MISSING_SQL = sql_finish(
    with_views(["bars", "scores"], f"SELECT * FROM ns_raw WHERE {_finite_filter(_NS_FEATURES + al.ALPHA_NAMES)}",
               extra=_NS_CTE, recursive=True),
    {"ticker": "s", "date": "dt", **{c: "d" for c in _NS_FEATURES}, **{a: "d" for a in al.ALPHA_NAMES}},
)


@query("alpha_missing_inputs", _MISSING_SQL)
def alpha_missing_inputs(spark, sf_dir):
    """No sentiment file at all: formulas reading sentiment give 0.0, the others still run."""
    return al.apply_alphas(feat.build_features(bars(spark, sf_dir), None))


# ---------------------------------------------------------------- training set
_SCALE_COLS = ["target"] + _FEATURES + al.ALPHA_NAMES


def _learn_cte() -> str:
    target = f"""
tg AS (
  SELECT * REPLACE (ln(1 + volume) AS volume),
         lead(close) OVER ({W}) / NULLIF(close, 0) - 1 AS target
  FROM alpha_ds
),
tgt AS (SELECT * FROM tg WHERE target IS NOT NULL),
spl AS (
  SELECT *, CASE WHEN row_number() OVER ({W}) <= floor(count(*) OVER (PARTITION BY ticker) * 0.8)
                 THEN 'train' ELSE 'test' END AS split
  FROM tgt
),
st AS (
  SELECT ticker, {', '.join(f'avg({c}) AS {c}__mean, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS {c}__std' for c in _SCALE_COLS)}
  FROM spl WHERE split = 'train' GROUP BY ticker
),
sc AS (
  SELECT spl.ticker, spl.date, spl.split,
         {', '.join(f'(spl.{c} - st.{c}__mean) / st.{c}__std AS {c}' for c in _SCALE_COLS)}
  FROM spl JOIN st ON spl.ticker = st.ticker
)"""
    return _FULL_CTE + ",\n" + alpha_cte(TICKERS) + "," + target


def _learn_sql(body: str, kinds: dict) -> str:
    return sql_finish(with_views(["bars", "scores"], body, extra=_learn_cte(), recursive=True), kinds)


def _target_frame(spark, sf_dir):
    return ls.add_target(alpha_dataset(spark, sf_dir))


@query("next_return_target", _learn_sql("SELECT ticker, date, target, volume, close FROM tgt",
                                        {"ticker": "s", "date": "dt", "target": "d", "volume": "d", "close": "d"}))
def next_return_target(spark, sf_dir):
    return _target_frame(spark, sf_dir).select("ticker", "date", "target", "volume", "close")


def _scaled(spark, sf_dir, keep_stats=False):
    df = ls.chronological_split(_target_frame(spark, sf_dir))
    return ls.scale_in_place(df, _SCALE_COLS, keep_stats=keep_stats)


@query("split_and_scale", _learn_sql("SELECT * FROM sc",
                                     {"ticker": "s", "date": "dt", "split": "s", **{c: "d" for c in _SCALE_COLS}}))
def split_and_scale(spark, sf_dir):
    return _scaled(spark, sf_dir).select("ticker", "date", "split", *_SCALE_COLS)


_WIN_BODY = f"""
SELECT ticker, split, j - 30 AS "window", date AS label_date, 30 AS x_rows,
       x_first, x_last, list_sum(list_transform(range(1, len(flat) + 1), lambda k: flat[k] * k)) AS x_all, y
FROM (
  SELECT ticker, split, date, target AS y,
         row_number() OVER (PARTITION BY ticker, split ORDER BY date) - 1 AS j,
         lag(target, 30) OVER (PARTITION BY ticker, split ORDER BY date) AS x_first,
         lag(target, 1) OVER (PARTITION BY ticker, split ORDER BY date) AS x_last,
         flatten(list([{', '.join(_SCALE_COLS)}]) OVER (PARTITION BY ticker, split ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)) AS flat
  FROM sc
) WHERE j >= 30"""


@query("training_windows", _learn_sql(_WIN_BODY, {"ticker": "s", "split": "s", "window": "i", "label_date": "dt",
                                                  "x_rows": "i", "x_first": "d", "x_last": "d", "x_all": "d", "y": "d"}))
def training_windows(spark, sf_dir):
    win = ls.training_windows(_scaled(spark, sf_dir), _SCALE_COLS)
    # every value counts by its place in the window
    weighed = F.transform(F.flatten("x"), lambda v, i: v * (i + 1))
    return win.select(
        "ticker", "split", "window", "label_date", F.size("x").alias("x_rows"),
        F.col("x")[0][0].alias("x_first"), F.element_at("x", -1)[0].alias("x_last"),
        F.aggregate(weighed, F.lit(0.0), lambda a, v: a + v).alias("x_all"), "y",
    )


_EVAL_CTE_BODY = f"""
SELECT * FROM (
  SELECT ticker, date, close, target, returns AS pred,
         row_number() OVER ({W}) - 1 AS j, lag(close) OVER ({W}) AS prev_close
  FROM spl WHERE split = 'test'
) WHERE j >= 30"""


@query("direction_metrics", _learn_sql(f"""
SELECT ticker, count(*) AS n,
       avg(CASE WHEN (pred > 0 AND target > 0) OR (pred < 0 AND target < 0) THEN 100.0 ELSE 0.0 END) AS accuracy,
       avg(pow(pred - target, 2)) + 10.0 * avg(greatest(0.0, 1.0 - tanh(pred * 10) * tanh(target * 10))) AS loss
FROM ({_EVAL_CTE_BODY}) e GROUP BY ticker""", {"ticker": "s", "n": "i", "accuracy": "d", "loss": "d"}))
def direction_metrics(spark, sf_dir):
    """Naive forecast: today's return predicts tomorrow's (the model itself is not built)."""
    df = ls.chronological_split(_target_frame(spark, sf_dir)).withColumn("pred", F.col("returns"))
    return ls.direction_metrics(ls.evaluation_rows(df))


@query("price_path", _learn_sql(f"""
SELECT ticker, date, close, prev_close * (1 + pred) AS pred_close FROM ({_EVAL_CTE_BODY}) e""",
                                {"ticker": "s", "date": "dt", "close": "d", "pred_close": "d"}))
def price_path(spark, sf_dir):
    df = ls.chronological_split(_target_frame(spark, sf_dir)).withColumn("pred", F.col("returns"))
    return ls.price_path(ls.evaluation_rows(df)).select("ticker", "date", "close", "pred_close")


@query("inverse_target", _learn_sql("""
SELECT sc.ticker, sc.date, sc.split, spl.target AS target, sc.target * st.target__std + st.target__mean AS restored
FROM sc JOIN spl ON sc.ticker = spl.ticker AND sc.date = spl.date JOIN st ON sc.ticker = st.ticker""",
                                    {"ticker": "s", "date": "dt", "split": "s", "target": "d", "restored": "d"}))
def inverse_target(spark, sf_dir):
    """Scaled target mapped back with the train statistics (F21 inverse for column 0)."""
    df = ls.chronological_split(_target_frame(spark, sf_dir))
    scaled = ls.scale_in_place(df.withColumn("_orig", F.col("target")), _SCALE_COLS, keep_stats=True)
    restored = F.col("target") * F.col("target__std") + F.col("target__mean")
    return scaled.select("ticker", "date", "split", F.col("_orig").alias("target"), restored.alias("restored"))
