"""Supervised training set and evaluation metrics (pipeline stage 12).

W9, F19, P16, W13, A16, F21, W14, W15, A17, A18. All per ticker, ordered by date;
statistics are aggregates joined back on ticker (one row per ticker and split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .indicators import series_window

TRAIN_SHARE = 0.8
SEQ_LEN = 30
LOSS_WEIGHT = 10.0
TANH_SLOPE = 10.0


def add_target(df: DataFrame, key: str = "ticker") -> DataFrame:
    """target = next day's return (W9); volume → log1p (F19); drop incomplete rows
    (the last row per ticker); target moved to the front (P16)."""
    w = series_window(key)
    out = df.withColumn("target", F.try_divide(F.lead("close").over(w), F.col("close")) - F.lit(1.0))
    if "volume" in out.columns:
        out = out.withColumn("volume", F.log1p("volume"))
    out = out.dropna(subset=["target"])
    rest = [x for x in out.columns if x not in (key, "date", "target")]
    return out.select(key, "date", "target", *rest)


def chronological_split(df: DataFrame, key: str = "ticker", share: float = TRAIN_SHARE) -> DataFrame:
    """First int(n*share) rows per ticker are ``train``, the rest ``test``."""
    w = series_window(key)
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    return df.withColumn(
        "split", F.when(F.row_number().over(w) <= F.floor(n * F.lit(share)), F.lit("train")).otherwise(F.lit("test"))
    )


def fit_scaler(df: DataFrame, columns: list[str], key: str = "ticker") -> DataFrame:
    """Mean and population std per column on the train rows (A16); std 0 → 1."""
    aggs = []
    for x in columns:
        aggs.append(F.avg(x).alias(f"{x}__mean"))
        sd = F.stddev_pop(x)
        aggs.append(F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias(f"{x}__std"))
    return df.filter(F.col("split") == "train").groupBy(key).agg(*aggs)


def standardize(df: DataFrame, stats: DataFrame, columns: list[str], key: str = "ticker") -> DataFrame:
    """(x - mean) / std with the train statistics, on train and test.

    ``stats`` holds one row per ticker, so the join is bounded by the ticker count.
    """
    joined = df.join(stats, key, "left")
    keep = [x for x in df.columns if x not in columns]
    scaled = [((F.col(x) - F.col(f"{x}__mean")) / F.col(f"{x}__std")).alias(x) for x in columns]
    return joined.select(*keep, *scaled).select(*df.columns)


def scale_in_place(df: DataFrame, columns: list[str], key: str = "ticker", keep_stats: bool = False) -> DataFrame:
    """Fit on the train rows and standardise every row, without a join (A16 + F21).

    Train-only mean and population std are window aggregates over the ticker
    partition (``avg(when(train, x))``), so they reuse the exchange and sort the
    series already has; std 0 becomes 1. ``keep_stats`` also returns
    ``<col>__mean`` / ``<col>__std`` for the inverse transform.
    """
    w = f"OVER (PARTITION BY `{key}`)"
    stats = []
    for x in columns:
        v = f"CASE WHEN split = 'train' THEN `{x}` END"
        stats.append(f"avg({v}) {w} AS `{x}__mean`")
        stats.append(f"CASE WHEN stddev_pop({v}) {w} = 0 THEN 1.0D ELSE stddev_pop({v}) {w} END AS `{x}__std`")
    out = df.selectExpr("*", *stats)
    keep = [f"`{x}`" for x in df.columns if x not in columns]
    scaled = [f"(`{x}` - `{x}__mean`) / `{x}__std` AS `{x}`" for x in columns]
    extra = [f"`{x}__{k}`" for x in columns for k in ("mean", "std")] if keep_stats else []
    return out.selectExpr(*keep, *scaled, *extra).select(*df.columns, *[e.strip("`") for e in extra])


def inverse_first(scaled: DataFrame, stats: DataFrame, column: str = "target", key: str = "ticker",
                  out: str = "pred") -> DataFrame:
    """Undo the scaling for one column (the inverse transform of column 0)."""
    return (
        scaled.join(stats.select(key, f"{column}__mean", f"{column}__std"), key, "left")
        .withColumn(out, F.col(column) * F.col(f"{column}__std") + F.col(f"{column}__mean"))
        .drop(f"{column}__mean", f"{column}__std")
    )


def training_windows(df: DataFrame, feature_cols: list[str], key: str = "ticker", seq_len: int = SEQ_LEN,
                     label: str = "target") -> DataFrame:
    """Sliding windows within each (ticker, split) (W14): x = rows i..i+L-1, y = label of row i+L.

    Produces n - L windows per part; ``x`` is an array of L feature rows.
    """
    w = Window.partitionBy(key, "split").orderBy("date")
    frame = w.rowsBetween(-seq_len, -1)
    return (
        df.withColumn("_j", F.row_number().over(w) - 1)
        .withColumn("x", F.collect_list(F.array(*[F.col(x) for x in feature_cols])).over(frame))
        .filter(F.col("_j") >= seq_len)
        .select(key, "split", (F.col("_j") - seq_len).alias("window"), F.col("date").alias("label_date"),
                "x", F.col(label).alias("y"))
    )


def evaluation_rows(df: DataFrame, pred: str = "pred", key: str = "ticker", seq_len: int = SEQ_LEN) -> DataFrame:
    """Test rows that have a full look-back window, with the previous close (W15 base)."""
    w = Window.partitionBy(key).orderBy("date")
    test = df.filter(F.col("split") == "test")
    return (
        test.withColumn("_j", F.row_number().over(w) - 1)
        .withColumn("prev_close", F.lag("close").over(w))
        .filter(F.col("_j") >= seq_len)
        .drop("_j")
    )


def direction_metrics(rows: DataFrame, pred: str = "pred", truth: str = "target", key: str = "ticker",
                      weight: float = LOSS_WEIGHT) -> DataFrame:
    """Directional accuracy (A17) and directional loss (A18) per ticker.

    accuracy = 100 * share of rows with p>0 and t>0, or p<0 and t<0 (zeros are wrong);
    loss = mean((p-t)^2) + weight * mean(relu(1 - tanh(10p) * tanh(10t))).
    """
    p, t = F.col(pred), F.col(truth)
    hit = ((p > 0) & (t > 0)) | ((p < 0) & (t < 0))
    soft = F.greatest(F.lit(0.0), F.lit(1.0) - F.tanh(p * TANH_SLOPE) * F.tanh(t * TANH_SLOPE))
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(hit, F.lit(100.0)).otherwise(F.lit(0.0))).alias("accuracy"),
        (F.avg(F.pow(p - t, 2)) + F.lit(weight) * F.avg(soft)).alias("loss"),
    )


def price_path(rows: DataFrame, pred: str = "pred") -> DataFrame:
    """One-step-ahead price path (W15): previous actual close × (1 + predicted return).

    Literal reproduction: the return predicted for row i (a next-day label) is
    applied to the close of row i-1.
    """
    return rows.withColumn("pred_close", F.col("prev_close") * (F.lit(1.0) + F.col(pred)))
