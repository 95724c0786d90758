import datetime as dt

from pyspark.sql import functions as F

from tickerflow.functions import dates as D
from tickerflow.functions import text as T
from tickerflow.operators import articles as A
from tickerflow.operators import tickermap as M


def _one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"s {typ}").select(expr(F.col("s")).alias("v")).first()["v"]


def test_collapse_whitespace(spark):
    assert _one(spark, T.collapse_ws, "a \n\t b") == "a b"
    assert _one(spark, T.ustrip, "　 x  ") == "x"


def test_title_fallback(spark):
    words = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([("", words)], "t string, c string")
    got = df.select(T.title_fallback(F.col("t"), F.col("c")).alias("v")).first()["v"]
    assert got == " ".join(f"w{i}" for i in range(15)) + "..."


def test_url_date_first_match_only(spark):
    assert _one(spark, D.url_date, "https://x.vn/a-20241305-20240101.htm") is None
    assert _one(spark, D.url_date, "https://x.vn/a-20240231.htm") == "2024-02-31"
    assert _one(spark, lambda c: D.parse_day(D.url_date(c)), "https://x.vn/a-20240231.htm") is None


def test_source_date_formats(spark):
    assert _one(spark, D.parse_common, "Ngày 5-1-2024 10:00") == dt.date(2024, 1, 5)
    assert _one(spark, D.parse_vnexpress, "Thứ hai, 1/1/2024, 10:00 (GMT+7)") == dt.datetime(2024, 1, 1, 10, 0)
    assert _one(spark, D.parse_vnexpress, "1/1/2024, 10:00") is None
    assert _one(spark, D.parse_iso_local, "2024-03-01T00:30:00+07:00") == dt.date(2024, 3, 1)
    assert _one(spark, D.parse_two_digit_year, "05/01/95 08:15") == dt.date(1995, 1, 5)
    assert _one(spark, D.parse_two_digit_year, "05/01/24") == dt.date(2024, 1, 5)


def test_clean_company_name(spark):
    df = spark.createDataFrame([("Công ty Cổ phần FPT",), ("CTCP Hòa Phát",), (None,), ("NGÂN HÀNG TMCP X",)], "s string")
    got = [r["v"] for r in df.select(M.clean_company_name(F.col("s")).alias("v")).collect()]
    assert got == ["FPT", "Hòa Phát", "", "X"]


def _raw(spark, rows):
    return spark.createDataFrame(rows, "ticker string, url string, published_date string, arrival long")


def test_dedup_by_url_keeps_oldest_at_newest_position(spark):
    rows = [("T", "u", "2024-03-01", 0), ("T", "u", "2024-01-01", 1), ("T", "u", "2024-01-01", 2),
            ("T", "v", "2024-02-01", 3)]
    out = A.dedup_by_url(_raw(spark, rows)).orderBy(F.desc("pos_date"), "pos_arrival").collect()
    assert [(r["url"], r["arrival"]) for r in out] == [("u", 2), ("v", 3)]


def test_dedup_by_url_missing_date(spark):
    rows = [("T", "w", None, 0), ("T", "w", "2024-01-01", 1), ("T", "v", "2025-01-01", 2)]
    out = A.dedup_by_url(_raw(spark, rows)).orderBy(F.desc("pos_date"), "pos_arrival").collect()
    assert [(r["url"], r["published_date"]) for r in out] == [("w", "2024-01-01"), ("v", "2025-01-01")]


def test_dedup_by_content_keeps_first(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "content string, arrival long")
    assert sorted(tuple(r) for r in A.dedup_by_content(df).collect()) == [("a", 1), ("b", 2)]


def test_clean_articles_end_to_end(spark):
    rows = [("BID", "s", "k", "", "https://a.vn/x-20240105.htm", None, "  body\n\ttext  ", 1),
            ("BID", "s", "k", "T", "https://a.vn/y.htm", None, "c", 2),
            ("BID", "s", "k", "T", "https://a.vn/z-20240231.htm", "2024-01-01", "c", 3)]
    df = spark.createDataFrame(rows, "ticker string, source string, keyword string, title string, url string, "
                                     "published_date string, content string, arrival long")
    out = A.clean_articles(df).collect()
    assert len(out) == 1 and out[0]["title"] == "body text..." and out[0]["date"] == dt.date(2024, 1, 5)
