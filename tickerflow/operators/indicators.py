"""Technical indicators over daily bars.

Every indicator is partitioned by ``ticker`` and ordered by ``date`` so Catalyst
plans one Exchange + Sort and stacks the Window nodes on it. Rolling windows are
guarded with ``count(c) over frame = n``: pandas yields NULL until the frame is
full, a Spark frame does not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Indicator parameters used by the feature stage.
SMA_SHORT = 5
SMA_LONG = 20
BOLLINGER_WINDOW = 20
BOLLINGER_DEV = 2.0
VOLATILITY_WINDOW = 20
RSI_WINDOW = 14

# Rows per block for the RSI running sums; (14/13)^4096 ~ 1e132 stays finite.
RSI_BLOCK = 4096


def series_window(key: str = "ticker", order: str = "date"):
    return Window.partitionBy(key).orderBy(order)


def rolling(agg, col: str, n: int, w=None) -> Column:
    """``agg(col)`` over the last ``n`` rows, NULL until ``n`` non-null values exist."""
    w = w if w is not None else series_window()
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(col).over(frame) == n, agg(col).over(frame))


def pct_change(col: str, w=None) -> Column:
    """``x / lag(x) - 1``; a zero previous value gives NULL instead of inf."""
    w = w if w is not None else series_window()
    return F.try_divide(F.col(col), F.lag(col).over(w)) - F.lit(1.0)


def typical_price() -> Column:
    """(high + low + close) / 3, called ``vwap`` in the feature table."""
    return (F.col("high") + F.col("low") + F.col("close")) / F.lit(3.0)


def add_price_indicators(bars: DataFrame, key: str = "ticker") -> DataFrame:
    """returns, vwap, sma_5, sma_20, bb_upper/lower (population std), volatility (sample std)."""
    w = series_window(key)
    sma20 = rolling(F.avg, "close", SMA_LONG, w)
    bb_std = rolling(F.stddev_pop, "close", BOLLINGER_WINDOW, w)
    return bars.withColumns({
        "returns": pct_change("close", w),
        "vwap": typical_price(),
        "sma_5": rolling(F.avg, "close", SMA_SHORT, w),
        "sma_20": sma20,
        "bb_upper": sma20 + F.lit(BOLLINGER_DEV) * bb_std,
        "bb_lower": sma20 - F.lit(BOLLINGER_DEV) * bb_std,
        "volatility": rolling(F.stddev_samp, "close", VOLATILITY_WINDOW, w),
    })


def add_rsi(bars: DataFrame, key: str = "ticker", window: int = RSI_WINDOW,
            block: int = RSI_BLOCK, out: str = "rsi") -> DataFrame:
    """Wilder RSI without a recursive plan.

    With i the 0-based row number and a = 1/window, the recursive average
    ``y_i = (1-a) y_{i-1} + a x_i`` seeded by ``y_0 = x_0 = 0`` equals
    ``a * sum_{j<=i} (1-a)^(i-j) x_j``. Inside a block of ``block`` rows this is a
    running sum of ``x_j / (1-a)^(j-start)`` scaled back by ``(1-a)^(i-start)``;
    all terms are non-negative, so there is no cancellation. The value carried
    into a block is a fold over the previous blocks' end values (a range window,
    no join, so the series keeps its single partitioning); only as many
    previous blocks are folded as it takes for (1-a)^(blocks*block) to underflow to
    exactly 0.0 (3 for the default block), so the result is the exact double.
    Result: 100 when the average loss is 0, NULL for the first ``window-1`` rows.
    """
    a = 1.0 / window
    keep = 1.0 - a
    w = series_window(key)
    d = F.col("close") - F.lag("close").over(w)
    df = bars.withColumns({
        "_i": F.row_number().over(w) - 1,
        "_up": F.coalesce(F.greatest(d, F.lit(0.0)), F.lit(0.0)),
        "_dn": F.coalesce(F.greatest(-d, F.lit(0.0)), F.lit(0.0)),
    })
    blk = F.floor(F.col("_i") / block)
    df = df.withColumns({"_blk": blk, "_off": F.col("_i") - blk * block})
    wb = Window.partitionBy(key, "_blk").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    grow = F.pow(F.lit(1.0 / keep), F.col("_off"))
    shrink = F.pow(F.lit(keep), F.col("_off"))
    df = df.withColumns({
        "_lu": F.lit(a) * shrink * F.sum(F.col("_up") * grow).over(wb),
        "_ld": F.lit(a) * shrink * F.sum(F.col("_dn") * grow).over(wb),
    })
    # The carry into block k folds the end values of the previous blocks. A range
    # frame over block numbers collects them without a join: only the end row of
    # each block contributes (collect_list skips the NULLs), so each list holds at
    # most ``lookback`` entries; the frame changes only at block boundaries.
    decay = keep ** block
    lookback = int(math.ceil(760.0 / (block * -math.log(keep)))) + 1
    wk = Window.partitionBy(key).orderBy("_blk").rangeBetween(-lookback, -1)
    is_end = F.col("_off") == block - 1

    def carried(c):
        prev = F.array_sort(F.collect_list(F.when(is_end, F.struct(F.col("_blk"), F.col(c)))).over(wk))
        return F.aggregate(prev, F.lit(0.0), lambda acc, x: acc * F.lit(decay) + x[c])

    df = df.withColumns({"_cu": carried("_lu"), "_cd": carried("_ld")})
    up = F.col("_lu") + F.pow(F.lit(keep), F.col("_off") + 1) * F.col("_cu")
    dn = F.col("_ld") + F.pow(F.lit(keep), F.col("_off") + 1) * F.col("_cd")
    value = F.when(dn == 0.0, F.lit(100.0)).otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + up / dn))
    return (
        df.withColumn(out, F.when(F.col("_i") >= window - 1, value))
        .drop("_i", "_up", "_dn", "_blk", "_off", "_lu", "_ld", "_cu", "_cd")
    )
