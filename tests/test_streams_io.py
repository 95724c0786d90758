import datetime as dt
import os

from pyspark.sql import functions as F

from tickerflow import schemas
from tickerflow.sources import io
from tickerflow.streaming import streams as ST
from tickerflow.operators import tickermap as M


def _events(spark, folder):
    t0 = dt.datetime(2024, 1, 1, 8, 0)
    rows = [(t0 + dt.timedelta(hours=h), f"u{h % 3}", "VIC" if h % 2 else "FPT") for h in range(30)]
    spark.createDataFrame(rows, "ts timestamp, url string, related string").write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder).schema


def test_stream_intake_one_row_per_url(spark, tmp_path):
    src = str(tmp_path / "ev")
    schema = _events(spark, src)
    s = ST.file_stream(spark, src, schema)
    out = ST.run_to_table(spark, ST.intake_unique_urls(s.select("url", "ts")), "t-urls", mode="append")
    assert sorted(r["url"] for r in out.collect()) == ["u0", "u1", "u2"]


def test_stream_daily_mentions(spark, tmp_path):
    src = str(tmp_path / "ev")
    schema = _events(spark, src)
    s = ST.file_stream(spark, src, schema)
    out = ST.run_to_table(spark, ST.daily_mentions(s), "t-mentions", mode="update", upsert_keys=["w", "related"])
    got = {(str(r["w"]["start"].date()), r["related"]): r["n"] for r in out.collect()}
    want = {}
    t0 = dt.datetime(2024, 1, 1, 8, 0)
    for h in range(30):
        k = (str((t0 + dt.timedelta(hours=h)).date()), "VIC" if h % 2 else "FPT")
        want[k] = want.get(k, 0) + 1
    assert got == want


def test_streams_equal_batch_for_files_in_any_order(spark, tmp_path):
    """Six files, one per trigger, out of time order: still one row per URL and every event counted."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(hours=h), f"u{h % 5}", "VIC" if h % 2 else "FPT") for h in range(240)]
    src = tmp_path / "parts"
    for k in (3, 0, 5, 1, 4, 2):
        spark.createDataFrame(rows[k * 40:(k + 1) * 40], "ts timestamp, url string, related string").coalesce(1).write.mode("append").parquet(str(src))
    s = ST.file_stream(spark, str(src), spark.read.parquet(str(src)).schema, max_files=1)
    urls = ST.run_to_table(spark, ST.intake_unique_urls(s.select("url", "ts")), "o-urls", mode="append")
    assert sorted(r["url"] for r in urls.collect()) == [f"u{k}" for k in range(5)]
    n = ST.run_to_table(spark, ST.daily_mentions(s), "o-mentions", mode="update", upsert_keys=["w", "related"])
    got = [(r["n"], r["related"]) for r in n.collect()]
    assert len(got) == 20 and sum(x for x, _ in got) == 240


def test_stream_within_a_delay_keeps_late_rows_apart(spark, tmp_path):
    """Files out of order: a row is late by the newest row of earlier batches, a URL comes once within the limit."""
    t0 = dt.datetime(2024, 1, 1)
    batches = [[(0, "a"), (1, "b"), (1, "b")], [(30, "a"), (2, "c"), (31, "d")], [(5, "e"), (28, "d"), (32, "a")], [(80, "d"), (60, "f"), (None, "g")]]
    src, rows = tmp_path / "late", "ts timestamp, url string, related string"
    for k, part in enumerate(batches):
        at = [(None if h is None else t0 + dt.timedelta(hours=h), u, "VIC") for h, u in part]
        spark.createDataFrame(at, rows).coalesce(1).write.mode("append").parquet(str(src))
        for f in src.glob("part-*.parquet"):
            if f.stat().st_mtime > 1_750_000_000:  # the new one: files are read in the order of their times
                os.utime(f, (1_700_000_000 + 100 * k,) * 2)
    s = ST.file_stream(spark, str(src), spark.read.parquet(str(src)).schema, max_files=1)
    hours = lambda df: sorted(("-" if r["ts"] is None else str(int((r["ts"] - t0).total_seconds() // 3600)), r["url"]) for r in df.collect())
    kept, late = ST.run_within(spark, s, "w-urls", "24 hours", once_per="url")
    assert hours(late) == [("-", "g"), ("5", "e")]
    # limits by batch: none, -23, 7, 8; a at 30 meets a at 0, a at 32 no longer; d at 28 and 80 meet d at 31
    assert hours(kept) == sorted([("0", "a"), ("1", "b"), ("2", "c"), ("31", "d"), ("32", "a"), ("60", "f")])
    kept, late = ST.run_within(spark, s, "w-all", "24 hours")
    assert kept.count() + late.count() == sum(map(len, batches)) and late.count() == 2
    assert kept.groupBy(F.window("ts", "1 day"), "related").count().agg(F.sum("count")).first()[0] == kept.count()


def test_csv_roundtrip_and_empty_guard(spark, tmp_path):
    rows = [("BID", dt.date(2024, 1, 2)) + tuple(float(i) for i in range(16))]
    df = spark.createDataFrame(rows, schemas.FEATURES)
    folder = str(tmp_path / "csv")
    assert io.write_csv(df, folder)
    back = io.read_csv(spark, folder, schemas.FEATURES).collect()
    assert len(back) == 1 and back[0]["ticker"] == "BID" and back[0]["sentiment_ma5"] == 15.0
    assert not io.write_csv(df.limit(0), str(tmp_path / "none"))


def test_name_map_roundtrip_keeps_order(spark, tmp_path):
    m = spark.createDataFrame([(5, "zeta", "Z"), (1, "alpha", "A"), (3, "mid", "M")], "ord long, name string, ticker string")
    folder = str(tmp_path / "maps")
    io.write_name_maps(m, folder)
    got = [(r["name"], r["ticker"]) for r in io.read_name_maps(spark, folder).orderBy("chunk", "pos").collect()]
    assert got == [("alpha", "A"), ("mid", "M"), ("zeta", "Z")]


def test_listing_entries_rules(spark):
    listing = spark.createDataFrame(
        [(0, "FPT", "Công ty Cổ phần FPT", "FPT"), (1, "HPG", "Tập đoàn Hòa Phát", "Hòa Phát"), (2, "", "X", "Y")],
        "row_order long, symbol string, organ_name string, organ_short_name string")
    m = {r["name"]: r["ticker"] for r in M.build_ticker_map(listing, "row_order").collect()}
    # short name equal to the ticker is skipped; its cleaned core equals the ticker too
    assert m == {"Công ty Cổ phần FPT": "FPT", "Hòa Phát": "HPG", "Tập đoàn Hòa Phát": "HPG"}
