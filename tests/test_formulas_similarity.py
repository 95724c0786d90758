"""Formula texts against numpy, the similarity join and the gram scan against brute force."""

import json
import math
import random

import numpy as np
import pandas as pd
import pytest

from tickerflow.operators import formulas as FM
from tickerflow.operators import linking as L
from tickerflow.operators import similarity as S
from tickerflow.operators.alphas import FORMULAS


def _frame():
    rng = np.random.default_rng(2)
    cols = sorted({c for fs in FORMULAS.values() for f in fs.values() for c in f.inputs})
    parts = []
    for t in ("X", "Y"):
        d = pd.DataFrame({c: rng.normal(0, 2, 60).round(1) for c in cols})
        d.loc[::7, "volatility"] = 0.0
        d.loc[::9, "sentiment_score"] = 0.0
        d["rsi"] = rng.uniform(0, 100, 60)
        parts.append(d.assign(ticker=t, date=pd.date_range("2024-01-01", periods=60)))
    return pd.concat(parts, ignore_index=True)


TEXTS = [f.text for fs in FORMULAS.values() for f in fs.values()] + [
    "df['close'] / df['volatility']", "np.where(df['close'] / df['volatility'] > 1, 1, 0)", "df.close.shift(2) - df['open']", "df['close'].rolling(5).std()",
    "df['close'].diff().fillna(0)", "df['close'].pct_change(3)", "np.log(df['rsi']) - np.sqrt(df['close'])", "~(df['rsi'] > 50) | (df['close'] == 0)",
    "np.maximum(df['close'], df['close'].shift(1))", "-abs(df['close']) ** 2 + 1", "(df['close'].shift(1) != df['close']) * 1.5", "np.sign(df['close'] / df['volatility'])", "2 + 3",
]


def test_formula_texts_like_numpy(spark):
    data = _frame()
    sdf = spark.createDataFrame(data)
    out = sdf.select("ticker", "date", *[FM.compiled(t, sdf.columns).alias(f"f{k}") for k, t in enumerate(TEXTS)]).toPandas()
    for t, own in data.groupby("ticker"):
        got = out[out["ticker"] == t].sort_values("date")
        with np.errstate(all="ignore"):
            for k, text in enumerate(TEXTS):
                # the texts are those above; only this test evaluates them
                want = np.asarray(eval(text, {"np": np, "df": own, "abs": abs}), float) * np.ones(len(own))
                np.testing.assert_allclose(got[f"f{k}"].to_numpy(float), want, rtol=1e-9, atol=1e-9, err_msg=text)


@pytest.mark.parametrize("text", ["import os", "__import__('os')", "df['nope']", "df['close'].__class__", "np.load('x')", "open('x')", "df.to_csv('x')", "(lambda: 1)()", "[1][0]",
                                  "df['close'] and df['open']", "'text'", "df['close'].rolling(3).mean().shift(1)", "np.where(df['close'])", "df['close'].shift(df['open'])", "~df['close']", "", "1 < df['close'] < 2", "(" * 300])
def test_refused_texts(text):
    with pytest.raises(FM.Refused):
        FM.compiled(text, ["close", "open"])


def test_formulas_from_files(spark, tmp_path):
    (tmp_path / "X_formulas.json").write_text(json.dumps({"a": "df['close'] * 2", "b": "nonsense("}))
    (tmp_path / "Y_formulas.json").write_text(json.dumps({"a": "df['missing']"}, indent=4))
    (tmp_path / "Z_formulas.json").write_text("no json")
    texts = FM.load_formulas(spark, str(tmp_path))
    assert texts == {"X": {"a": "df['close'] * 2", "b": "nonsense("}, "Y": {"a": "df['missing']"}, "Z": {}}
    df = spark.createDataFrame([("X", 1, 3.0), ("Y", 1, 4.0), ("W", 1, 5.0)], "ticker string, date int, close double")
    assert sorted(map(tuple, FM.with_formulas(df, texts).collect())) == [("W", 1, 5.0, None, None), ("X", 1, 3.0, 6.0, 0.0), ("Y", 1, 4.0, 0.0, None)]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_lcs_over_several_words():
    rng = random.Random(1)
    text = lambda n: "".join(rng.choice("abcdé日 ") for _ in range(n))
    a = [text(rng.choice([0, 1, 5, 30, 63, 64, 65, 130, 300])) for _ in range(150)]
    b = [text(rng.choice([0, 1, 5, 30, 63, 64, 65, 127, 128, 129, 250])) for _ in range(150)]
    b[:20] = [x + "z" for x in a[:20]]
    assert S.lcs_lengths(a, b).tolist() == [_lcs(x, y) for x, y in zip(a, b)]
    assert S.lcs_lengths([], []).tolist() == []


@pytest.mark.parametrize("threshold", [90, 80])
def test_similarity_join_finds_every_pair(spark, threshold):
    rng = random.Random(threshold)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(1, 9)))
    names = [" ".join(word() for _ in range(rng.randrange(1, 4))) for _ in range(70)] + ["a", "ab", "", "x" * 100]
    left = list(names[:30])
    for n in names:
        s = list(n)
        for _ in range(rng.randrange(0, 4)):
            if s and rng.random() < 0.5:
                s.pop(rng.randrange(len(s)))
            else:
                s.insert(rng.randrange(len(s) + 1), rng.choice("abc"))
        left.append("".join(s))
    a, b = sorted({L.token_sort(x) for x in left}), sorted({L.token_sort(x) for x in names})
    expected = {(x, y) for x in a for y in b if (200 * _lcs(x, y) >= threshold * (len(x) + len(y)))}
    got = S.similar(*[spark.createDataFrame([(x,) for x in s], "x string") for s in (a, b)], threshold).collect()
    assert len(got) == len(expected) and {(r["x"], r["y"]) for r in got} == expected


def test_gram_scan_gives_the_automaton_s_rows(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcđé") for _ in range(rng.randrange(1, 7)))
    texts = [(i, rng.choice(["T1", "T2", None]), rng.choice([None, word()]), " ".join(word() for _ in range(rng.randrange(0, 30))) + rng.choice(["", ".", " a-b", "b&c"])) for i in range(60)]
    texts += [texts[0], (60, "T1", None, None), (61, "T1", "", "")]
    arts = spark.createDataFrame(texts, "arrival long, ticker string, title string, content string")
    keys = {word() + rng.choice(["", " " + word()]): f"T{rng.randrange(9)}" for _ in range(50)} | {"a-": "T3", "&": "T4", "b&c": "T5", ".*": "T6", "zz": None, "": "T7"}
    k = spark.createDataFrame(list(keys.items()), "key string, ticker string")
    rows = lambda df: sorted((r["arrival"], str(r["ticker"]), r["related"]) for r in df.collect())
    assert rows(L.dictionary_scan(arts, k, max_keys=0)) == rows(L.dictionary_scan(arts, k))
    none = k.where("false")
    assert rows(L.dictionary_scan(arts, none, max_keys=-1)) == rows(L.dictionary_scan(arts, none))


def test_hand_worked_linking_example(spark):
    """One entity for each step, against one name list."""
    names = spark.createDataFrame([(0, "Ngân hàng Đầu tư và Phát triển Việt Nam", "BID"), (1, "Vinamilk", "VNM"), (2, "Hòa Phát Group", "HPG"), (3, "FPT", "FPT")], "ord long, name string, ticker string")
    aliases = spark.createDataFrame([("bidv", "BID"), ("agribank", None)], "alias string, ticker string")
    pairs = spark.createDataFrame([(e, "VIC") for e in ("BIDV", "Agribank", "vinamilk", "Tập đoàn Ngân hàng Đầu tư và Phát triển Việt Nam", "Hoà Phát Grup", "fpt", "Nothing")], "entity string, target string")
    got = sorted((r["entity"], r["step"], r["ticker"]) for r in L.resolve(pairs, names, aliases).collect())
    score = L.token_sort_ratio_py("Hoà Phát Grup", "Hòa Phát Group")
    expected = [("BIDV", "alias", "BID"), ("vinamilk", "exact", "VNM"), ("Tập đoàn Ngân hàng Đầu tư và Phát triển Việt Nam", "substring", "BID"), ("fpt", "exact", "FPT")]
    assert got == sorted(expected + ([("Hoà Phát Grup", "fuzzy", "HPG")] if score >= 90 else [])) and not math.isnan(score)
