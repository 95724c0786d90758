import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tickerflow.operators import features as feat
from tickerflow.operators import indicators as ind


def _bars(spark, closes, ticker="BID"):
    d0 = dt.date(2024, 1, 1)
    rows = [(ticker, d0 + dt.timedelta(days=i), c, c + 1.0, c - 1.0, c, 100.0 + i) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, "
                                       "close double, volume double")


def _col(df, c):
    return [r[c] for r in df.orderBy("date").collect()]


def test_sma_warmup(spark):
    out = ind.add_price_indicators(_bars(spark, [1.0, 2.0, 3.0, 4.0, 5.0]))
    assert _col(out, "sma_5") == [None, None, None, None, 3.0]


def test_population_vs_sample_std(spark):
    out = ind.add_price_indicators(_bars(spark, [float(i) for i in range(1, 21)]))
    last = out.orderBy(F.desc("date")).first()
    assert last["bb_upper"] - last["sma_20"] == pytest.approx(2 * 5.766281, abs=1e-6)
    assert last["volatility"] == pytest.approx(5.916080, abs=1e-6)


def _rsi_reference(closes, n=14):
    up = dn = 0.0
    out = []
    a = 1.0 / n
    for i, c in enumerate(closes):
        d = 0.0 if i == 0 else c - closes[i - 1]
        g, l = max(d, 0.0), max(-d, 0.0)
        up, dn = (g, l) if i == 0 else ((1 - a) * up + a * g, (1 - a) * dn + a * l)
        if i < n - 1:
            out.append(None)
        else:
            out.append(100.0 if dn == 0 else 100.0 - 100.0 / (1.0 + up / dn))
    return out


def test_rsi_rising_and_constant(spark):
    rising = _col(ind.add_rsi(_bars(spark, [float(i) for i in range(1, 31)])), "rsi")
    assert rising[:13] == [None] * 13 and all(v == 100.0 for v in rising[13:])
    const = _col(ind.add_rsi(_bars(spark, [5.0] * 20)), "rsi")
    assert const[13:] == [100.0] * 7


@pytest.mark.parametrize("block", [4096, 7])
def test_rsi_matches_recursion(spark, block):
    import random

    random.seed(3)
    closes = [100.0]
    for _ in range(299):
        closes.append(max(1.0, closes[-1] + random.uniform(-3, 3)))
    got = _col(ind.add_rsi(_bars(spark, closes), block=block), "rsi")
    want = _rsi_reference(closes)
    for g, w in zip(got, want):
        assert (g is None and w is None) or math.isclose(g, w, rel_tol=1e-9)


def test_sentiment_fill_diff_mean(spark):
    bars = _bars(spark, [10.0] * 6)
    d0 = dt.date(2024, 1, 1)
    scores = [(1, 0.5), (4, -0.5)]
    s = spark.createDataFrame([("BID", d0 + dt.timedelta(days=i), v) for i, v in scores],
                              "ticker string, date date, target_score double")
    out = feat.merge_sentiment(bars, feat.daily_sentiment(s))
    assert _col(out, "sentiment_score") == [0.0, 0.5, 0.5, 0.5, -0.5, -0.5]
    assert _col(out, "sentiment_diff") == [None, 0.5, 0.0, 0.0, -1.0, 0.0]
    ma = _col(out, "sentiment_ma5")
    assert ma[:4] == [0.0] * 4 and ma[4] == pytest.approx(0.2) and ma[5] == pytest.approx(0.1)


def test_sentiment_on_non_trading_day_is_dropped(spark):
    bars = _bars(spark, [10.0, 11.0])  # 2024-01-01, 2024-01-02
    s = spark.createDataFrame([("BID", dt.date(2023, 12, 31), 0.9)], "ticker string, date date, target_score double")
    out = feat.merge_sentiment(bars, feat.daily_sentiment(s))
    assert _col(out, "sentiment_score") == [0.0, 0.0]


def test_complete_rows_lose_19(spark):
    bars = _bars(spark, [float(10 + (i % 7)) for i in range(60)])
    s = spark.createDataFrame([("BID", dt.date(2024, 1, 1), 0.1)], "ticker string, date date, target_score double")
    assert feat.build_features(bars, s).count() == 41


def test_priority_union(spark):
    p = spark.createDataFrame([("A", 1)], "ticker string, v int")
    f = spark.createDataFrame([("A", 2), ("B", 3)], "ticker string, v int")
    got = sorted(tuple(r) for r in feat.pick_source(p, f).collect())
    assert got == [("A", 1), ("B", 3)]
