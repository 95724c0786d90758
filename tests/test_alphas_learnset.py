import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickerflow.operators import alphas as al
from tickerflow.operators import features as feat
from tickerflow.operators import learnset as ls


def _bars(spark, n, ticker):
    d0 = dt.date(2024, 1, 1)
    rows = [(ticker, d0 + dt.timedelta(days=i), 10.0 + (i % 5), 12.0 + (i % 5), 9.0 + (i % 3), 10.0 + (i % 7),
             100.0 + i) for i in range(n)]
    return spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, "
                                       "close double, volume double")


def test_missing_sentiment_gives_zero(spark):
    out = al.apply_alphas(feat.build_features(_bars(spark, 60, "VIC"), None))
    rows = out.collect()
    assert rows and all(r["alpha_1"] == 0.0 for r in rows)
    assert any(r["alpha_4"] != 0.0 for r in rows)  # rsi * (vwap - close) reads no sentiment


def test_zero_volatility_row_dropped(spark):
    d0 = dt.date(2024, 1, 1)
    rows = [("BID", d0 + dt.timedelta(days=i), 10.0, 10.0, 10.0, 10.0, 1.0) for i in range(25)]
    bars = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, "
                                       "close double, volume double")
    s = spark.createDataFrame([("BID", d0, 0.3)], "ticker string, date date, target_score double")
    assert al.apply_alphas(feat.build_features(bars, s)).count() == 0


def test_formula_registry_shape():
    assert sorted(al.FORMULAS) == ["BID", "FPT", "VIC", "VJC", "VNM"]
    texts = {f.text for fs in al.FORMULAS.values() for f in fs.values()}
    assert len(texts) == 17
    assert all(fs["alpha_1"] is al.FORMULAS["BID"]["alpha_1"] for fs in al.FORMULAS.values())


def _frame(spark, n):
    d0 = dt.date(2024, 1, 1)
    rows = [("T", d0 + dt.timedelta(days=i), float(i % 4), float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "ticker string, date date, target double, close double")


def test_split_sizes(spark):
    df = ls.chronological_split(_frame(spark, 40))
    c = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    assert c == {"train": 32, "test": 8}


def test_windows_count_and_label(spark):
    df = _frame(spark, 40).withColumn("split", F.lit("train"))
    win = ls.training_windows(df, ["target", "close"], seq_len=30).orderBy("window").collect()
    assert len(win) == 10
    assert win[0]["y"] == float(30 % 4) and len(win[0]["x"]) == 30 and win[0]["x"][0][1] == 0.0


def test_constant_column_scales_to_zero(spark):
    df = _frame(spark, 10).withColumn("k", F.lit(3.0)).withColumn("split", F.lit("train"))
    st = ls.fit_scaler(df, ["k"])
    assert {r["k"] for r in ls.standardize(df, st, ["k"]).collect()} == {0.0}


def test_directional_accuracy(spark):
    df = spark.createDataFrame([("T", 1.0, 1.0), ("T", -1.0, -2.0), ("T", 1.0, -1.0), ("T", 0.0, 0.0)],
                               "ticker string, pred double, target double")
    assert ls.direction_metrics(df).first()["accuracy"] == pytest.approx(50.0)


def test_price_path(spark):
    df = spark.createDataFrame([("T", 10.0, 0.1), ("T", 11.0, 0.1)], "ticker string, prev_close double, pred double")
    got = sorted(r["pred_close"] for r in ls.price_path(df).collect())
    assert got == pytest.approx([11.0, 12.1])
