"""Article cleaning, deduplication and profiling (pipeline stages 3-5).

P1-P10, A1-A8, A14, A19, O1. Text work never partitions by ticker (a handful of
values); dedup shuffles on the URL or the content hash, with map-side partial
aggregation so a hot key costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T

LENGTH_STEPS = [1, 100, 200, 300, 400]


def clean_articles(raw: DataFrame) -> DataFrame:
    """``clean_row`` over raw rows (P1, F1-F4, F9), then P2 and P3.

    Output: ticker, source, date DATE, title, content, url (+ arrival when present).
    A NULL title/content counts as empty (documented deviation: the reference
    turns None into the text 'None').
    """
    title = T.ustrip(F.coalesce(F.col("title"), F.lit("")))
    content = T.collapse_ws(F.coalesce(F.col("content"), F.lit("")))
    date_text = F.coalesce(D.url_date(F.col("url")), F.col("published_date"))
    extra = ["arrival"] if "arrival" in raw.columns else []
    df = raw.select(
        "ticker", "source", date_text.alias("_date"), title.alias("_title"), content.alias("content"), "url", *extra
    )
    df = df.withColumn("title", T.title_fallback(F.col("_title"), F.col("content")))
    df = df.filter((F.col("content") != "") & F.col("_date").isNotNull() & (F.col("_date") != ""))
    df = df.withColumn("date", D.parse_day(F.col("_date"))).filter(F.col("date").isNotNull())
    return df.select("ticker", "source", "date", "title", "content", "url", *extra)


def date_window(df: DataFrame, lower: str | None = None, upper: str | None = None,
                exclude_years: list[int] | None = None, col: str = "date") -> DataFrame:
    """Lower bound (P4), inclusive range (P5) and excluded years."""
    if lower is not None:
        df = df.filter(F.col(col) >= F.lit(lower).cast("date"))
    if upper is not None:
        df = df.filter(F.col(col) <= F.lit(upper).cast("date"))
    if exclude_years:
        df = df.filter(~F.year(col).isin(exclude_years))
    return df


def before(df: DataFrame, lower: str, col: str = "date") -> DataFrame:
    """Complement of P4, kept for inspection."""
    return df.filter(F.col(col) < F.lit(lower).cast("date"))


def dedup_by_url(raw: DataFrame, key: list[str] | None = None) -> DataFrame:
    """``save_results`` (A1): per (ticker, url) keep the row with the **oldest**
    published date (ties: the latest arrival); its output position is that of the
    **newest** duplicate. A missing date sorts above every date.

    ``pos_date`` / ``pos_arrival`` carry the position: order the output by
    ``pos_date DESC, pos_arrival ASC``. Only dates and arrivals are aggregated; the
    kept rows are found again by (key, date, arrival), so titles and texts are in no
    aggregate and, where they aren't selected, in no exchange. ``arrival`` must be unique.
    """
    key = key or ["ticker", "url"]
    d = F.coalesce(F.col("published_date"), F.lit("None"))
    order = F.struct(d.alias("d"), (-F.col("arrival")).alias("na"))
    win = raw.groupBy(*key).agg(F.min(order).alias("_keep"), F.max(order).alias("_pos")).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], (-F.col("_keep.na")).alias("_arrival"),
        F.col("_pos.d").alias("pos_date"), (-F.col("_pos.na")).alias("pos_arrival"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)] + [F.col("arrival") == F.col("_arrival")]
    rest = [c for c in raw.columns if c not in key]
    return raw.join(win, on).select(*key, *rest, "pos_date", "pos_arrival")


def dedup_by_content(df: DataFrame, order_col: str = "arrival", key: list[str] | None = None) -> DataFrame:
    """``drop_duplicates(subset=['content'], keep='first')`` (A2) with an explicit
    first: the smallest ``order_col``, which must be unique. An aggregate, not a window, so a hot
    content value is pre-combined on the map side; contents are grouped by SHA-256, so
    no text is a key. ``key`` defaults to the content alone."""
    key = key or ["content"]
    d = df.withColumn("_digest", F.sha2("content", 256))
    own = [k for k in key if k != "content"] + ["_digest"]
    first = d.groupBy(*own).agg(F.min(order_col).alias("_first")).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(own)], "_first")
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(own)] + [F.col(order_col) == F.col("_first")]
    return d.join(first, on, "left_semi").select(*df.columns)


def profile_nulls(df: DataFrame, group: str | None = None) -> DataFrame:
    """Non-null count (A3), null count (A4) per column, rows (A19), distinct content (A5, by SHA-256)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in df.columns:
        if c == group:
            continue
        aggs.append(F.count(c).alias(f"{c}_count"))
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"))
    if "content" in df.columns:
        aggs.append(F.countDistinct(F.sha2("content", 256)).alias("content_nunique"))
    return df.groupBy(group).agg(*aggs) if group else df.agg(*aggs)


def profile_lengths(df: DataFrame, group: str | None = None, min_len: int = 10) -> DataFrame:
    """Counts of content shorter than 1/100/200/300/400 (A6), rows kept by the
    ``length >= min_len`` filter (P7), and rows with a line break (P8)."""
    ln = F.length("content")
    aggs = [F.count_if(ln < k).alias(f"len_lt_{k}") for k in LENGTH_STEPS]
    aggs.append(F.count_if(ln >= min_len).alias(f"len_ge_{min_len}"))
    aggs.append(F.count_if(F.col("content").contains("\n") | F.col("content").contains("\r")).alias("with_newline"))
    return df.groupBy(group).agg(*aggs) if group else df.agg(*aggs)


def keep_min_length(df: DataFrame, min_len: int = 10) -> DataFrame:
    """``content.str.len() >= min_len``; NULL content is dropped like in pandas."""
    return df.filter(F.length("content") >= min_len)


def counts_by_year(df: DataFrame, by_ticker: bool = False) -> DataFrame:
    """Value counts per year (A7), or per year × ticker."""
    keys = [F.year("date").alias("year")] + ([F.col("ticker")] if by_ticker else [])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def counts_by_ticker(df: DataFrame, before_day: str | None = None) -> DataFrame:
    """Articles per ticker (A8); its key set is the distinct tickers (A14). With
    ``before_day`` also how many are older, in the same pass."""
    early = [] if before_day is None else [F.count_if(F.col("date") < F.lit(before_day).cast("date")).alias("n_before")]
    return df.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), *early)


def sort_for_write(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows by ticker then date for a ``partitionBy('ticker')`` sink (O1).

    A range partitioning on (ticker, date, url) rather than a hash on ticker: a
    ticker holding a third of all rows spreads over many tasks, each writing a
    sorted slice; part-file order follows the range order.
    """
    keys = ["ticker", "date", "url"]
    part = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return part.sortWithinPartitions(*keys)


def filtered_by(df: DataFrame, **values) -> DataFrame:
    """Rows whose columns equal the given values (P9); None asks for NULL."""
    for name, value in values.items():
        df = df.filter(F.col(name).eqNullSafe(F.lit(value)))
    return df
