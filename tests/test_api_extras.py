import json

from pyspark.sql import functions as F

from tickerflow.functions import text as T
from tickerflow.operators import learnset as ls
from tickerflow.operators import linking as L
from tickerflow.operators import tickermap as M
from tickerflow.sources import io


def test_build_with_fallback(spark):
    custom = M.names_frame(spark, [("Custom", "CUS")])
    fallback = M.names_frame(spark, M.FALLBACK_NAMES)
    empty = spark.createDataFrame([], "row_order long, symbol string, organ_name string, organ_short_name string")
    src = spark.createDataFrame([(0, "AAA", "Công ty AAA Group", "AAA Group")],
                                "row_order long, symbol string, organ_name string, organ_short_name string")
    got = M.build_with_fallback([None, empty, src], "row_order", custom, fallback)
    assert {r["name"] for r in got.collect()} >= {"AAA Group", "Custom"}
    assert M.build_with_fallback([empty], "row_order", custom, fallback).count() == len(M.FALLBACK_NAMES)


def test_map_column_keeps_order(spark):
    df = spark.createDataFrame([({"b": "B", "a": "A"},)], "m map<string,string>")
    rows = [(r["ord"], r["name"]) for r in M.map_from_column(df, "m").collect()]
    assert sorted(rows) == rows and {n for _, n in rows} == {"a", "b"}


def test_json_block_variants(spark):
    df = spark.createDataFrame([('x {"a":{"b":1}\n} y',), ("no braces",)], "t string")
    got = [(r["j"], r["k"]) for r in df.select(T.json_block("t").alias("j"), T.json_block_or_text("t").alias("k")).collect()]
    assert json.loads(got[0][0]) == {"a": {"b": 1}} and got[1] == (None, "no braces")


def test_spans_any_tag(spark):
    toks = spark.createDataFrame([(1, 0, "A", "B-MISC"), (1, 1, "B", "I-MISC"), (1, 2, "c", "O")],
                                 "article_id long, pos int, word string, ner_tag string")
    assert [r["entity"] for r in L.spans_any_tag(toks).collect()] == ["A B"]


def test_token_sort_ratio_udf(spark):
    df = spark.createDataFrame([("FPT Tập đoàn", "Tập đoàn FPT"), ("abcd", "abce")], "a string, b string")
    assert [r["s"] for r in df.select(L.token_sort_ratio("a", "b").alias("s")).collect()] == [100.0, 75.0]


def test_json_array_files_ticker_from_name(spark, tmp_path):
    (tmp_path / "VIC_clean.json").write_text('[{"url": "u1", "title": "t"}, {"url": "u2", "title": "s"}]',
                                             encoding="utf-8")
    df = io.read_json_array_files(spark, str(tmp_path / "*_clean.json"), "url string, title string")
    assert sorted((r["ticker"], r["url"]) for r in df.collect()) == [("VIC", "u1"), ("VIC", "u2")]


def test_inverse_first(spark):
    df = spark.createDataFrame([("T", 1.0, "train"), ("T", 3.0, "train")], "ticker string, target double, split string")
    st = ls.fit_scaler(df, ["target"])
    scaled = ls.standardize(df, st, ["target"])
    back = sorted(r["pred"] for r in ls.inverse_first(scaled, st).collect())
    assert back == [1.0, 3.0]
