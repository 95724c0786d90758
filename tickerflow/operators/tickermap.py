"""Company name → ticker map: build, update, deduplicate, normalise (pipeline stage 6).

F11, F12, P15, U3, A15, S4, S5. The map is an *ordered* dictionary in the
reference: insertion order decides "first match". Here it is a table
``(ord, name, ticker)``; ``ord`` is the position of the first insertion and a
re-assignment keeps the position but takes the later ticker, exactly like a
Python dict update.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ustrip

# Legal-form prefixes removed from company names, in this order.
LEGAL_PREFIXES = [
    "Công ty Cổ phần", "CTCP", "Tổng Công ty", "Tập đoàn",
    "Công ty", "Doanh nghiệp", "Ngân hàng TMCP", "Ngân hàng",
]

# Hand-added names applied over the listing (dict.update).
CUSTOM_NAMES = [
    ("Vingroup", "VIC"), ("VinFast", "VIC"), ("Vinhomes", "VHM"), ("Vincom", "VRE"),
    ("Vinamilk", "VNM"), ("Vietjet", "VJC"), ("Vietjet Air", "VJC"), ("Thế Giới Di Động", "MWG"),
    ("Bách Hóa Xanh", "MWG"), ("Điện Máy Xanh", "MWG"), ("Masan", "MSN"), ("Masan Group", "MSN"),
    ("WinMart", "MSN"), ("Hòa Phát", "HPG"), ("FPT Software", "FPT"), ("FPT Telecom", "FPT"),
    ("Long Châu", "FRT"), ("Viettel Global", "VGI"), ("Vietcombank", "VCB"), ("VietinBank", "CTG"),
    ("BIDV", "BID"), ("Techcombank", "TCB"), ("VPBank", "VPB"), ("MBBank", "MBB"),
    ("Sacombank", "STB"), ("Bamboo Airways", "BAV"), ("Thaco", "THACO"),
]

# The default map used when no listing source answers.
FALLBACK_NAMES = [
    ("VIC", "VIC"), ("Vingroup", "VIC"), ("VinFast", "VIC"),
    ("VHM", "VHM"), ("Vinhomes", "VHM"),
    ("VRE", "VRE"), ("Vincom", "VRE"),
    ("VNM", "VNM"), ("Vinamilk", "VNM"),
    ("VJC", "VJC"), ("Vietjet", "VJC"), ("Vietjet Air", "VJC"),
    ("FPT", "FPT"), ("FPT Software", "FPT"), ("FPT Telecom", "FPT"),
    ("BID", "BID"), ("BIDV", "BID"), ("Ngân hàng BIDV", "BID"),
    ("VCB", "VCB"), ("Vietcombank", "VCB"),
    ("CTG", "CTG"), ("VietinBank", "CTG"),
    ("TCB", "TCB"), ("Techcombank", "TCB"),
    ("MBB", "MBB"), ("MBBank", "MBB"),
    ("VPB", "VPB"), ("VPBank", "VPB"),
    ("ACB", "ACB"),
    ("STB", "STB"), ("Sacombank", "STB"),
    ("MWG", "MWG"), ("Thế Giới Di Động", "MWG"), ("Bách Hóa Xanh", "MWG"),
    ("MSN", "MSN"), ("Masan", "MSN"), ("Masan Group", "MSN"),
    ("HPG", "HPG"), ("Hòa Phát", "HPG"),
    ("VGI", "VGI"), ("Viettel Global", "VGI"),
    ("FRT", "FRT"), ("Long Châu", "FRT"),
    ("GAS", "GAS"), ("PLX", "PLX"), ("VHC", "VHC"),
    ("SSI", "SSI"), ("HDB", "HDB"), ("POW", "POW"),
]

# Alternative column spellings of a listing row, first non-empty wins.
TICKER_COLUMNS = ["ticker", "symbol"]
FULL_NAME_COLUMNS = ["organ_name", "organName", "companyName", "company"]
SHORT_NAME_COLUMNS = ["organ_short_name", "organShortName", "shortName"]


def clean_company_name(c: Column) -> Column:
    """Remove every legal-form prefix anywhere, case-insensitively, in list order,
    then strip (F11). NULL → ''."""
    out = F.coalesce(c, F.lit(""))
    for p in LEGAL_PREFIXES:
        out = F.regexp_replace(out, f"(?iu)\\Q{p}\\E", "")
    return ustrip(out)


def first_non_empty(df: DataFrame, candidates: list[str]) -> Column:
    """Row-level first non-empty value among the candidate columns present."""
    present = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in candidates if c in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def listing_entries(listing: DataFrame, row_order: str) -> DataFrame:
    """Candidate (seq, name, ticker) rows per listing row, in insertion order:
    short, core(short), full, core(full) with the reference's conditions (F12).

    ``seq`` = row_order * 4 + slot, so it orders entries like dict insertions.
    """
    t = first_non_empty(listing, TICKER_COLUMNS)
    full = first_non_empty(listing, FULL_NAME_COLUMNS)
    short = first_non_empty(listing, SHORT_NAME_COLUMNS)
    base = listing.select(F.col(row_order).cast("long").alias("_r"), t.alias("ticker"),
                          full.alias("full"), short.alias("short")).filter(F.col("ticker").isNotNull())

    def ok_name(n: Column) -> Column:
        return n.isNotNull() & (n != F.col("ticker")) & (F.length(n) > 1)

    def ok_core(core: Column, n: Column) -> Column:
        return ok_name(n) & (F.length(core) > 2) & (core != F.col("ticker")) & (core != n)

    cs, cf = clean_company_name(F.col("short")), clean_company_name(F.col("full"))
    slots = F.array(
        F.struct(F.lit(0).alias("slot"), F.col("short").alias("name"), ok_name(F.col("short")).alias("ok")),
        F.struct(F.lit(1).alias("slot"), cs.alias("name"), ok_core(cs, F.col("short")).alias("ok")),
        F.struct(F.lit(2).alias("slot"), F.col("full").alias("name"), ok_name(F.col("full")).alias("ok")),
        F.struct(F.lit(3).alias("slot"), cf.alias("name"), ok_core(cf, F.col("full")).alias("ok")),
    )
    e = base.select("_r", "ticker", F.explode(slots).alias("e")).filter(F.col("e.ok"))
    return e.select((F.col("_r") * 4 + F.col("e.slot")).alias("seq"), F.col("e.name").alias("name"), "ticker")


def dict_fold(entries: DataFrame) -> DataFrame:
    """Collapse (seq, name, ticker) insertions into an ordered map (U3):
    position of the first insertion, ticker of the last."""
    return entries.groupBy("name").agg(
        F.min("seq").alias("ord"), F.max_by("ticker", "seq").alias("ticker")
    ).select("ord", "name", "ticker")


def update_map(base: DataFrame, updates: DataFrame) -> DataFrame:
    """``base.update(updates)`` on ordered maps (U3): updates come after every base entry."""
    top = base.agg(F.max("ord").alias("_m"))
    shifted = updates.crossJoin(F.broadcast(top)).select(
        (F.coalesce(F.col("_m"), F.lit(-1)) + 1 + F.col("ord")).alias("seq"), "name", "ticker")
    return dict_fold(base.select(F.col("ord").alias("seq"), "name", "ticker").unionByName(shifted))


def names_frame(spark, pairs: list[tuple[str, str]]) -> DataFrame:
    """A small fixed name list as an ordered map table."""
    return spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(pairs)], "ord long, name string, ticker string")


def build_ticker_map(listing: DataFrame, row_order: str, custom: DataFrame | None = None) -> DataFrame:
    """Listing → ordered name map, then the custom names applied on top (F12 + U3)."""
    m = dict_fold(listing_entries(listing, row_order))
    return update_map(m, custom) if custom is not None else m


def build_with_fallback(sources: list[DataFrame | None], row_order: str, custom: DataFrame,
                        fallback: DataFrame) -> DataFrame:
    """Vendor fallback (S7): the first listing source that has rows wins; with none,
    the fixed default map. Emptiness is checked with one ``isEmpty`` per source."""
    for src in sources:
        if src is not None and not src.isEmpty():
            return build_ticker_map(src, row_order, custom)
    return fallback


def first_name_per_ticker(m: DataFrame) -> DataFrame:
    """``clean_ticker_map`` (A15): keep the first name of every ticker in map order.

    Returns every entry with ``kept`` and the winning ``first_name``; an aggregate
    (not a window) so a ticker holding many names is pre-combined map-side.
    """
    win = m.groupBy("ticker").agg(F.min_by("name", "ord").alias("first_name"), F.min("ord").alias("_o"))
    return m.join(win, "ticker").select(
        "ord", "name", "ticker", (F.col("ord") == F.col("_o")).alias("kept"), "first_name")


def normalized_keys(m: DataFrame) -> DataFrame:
    """Scan dictionary (S5): key = lower(strip(name)); the later entry wins on a collision."""
    return m.groupBy(F.lower(ustrip(F.col("name"))).alias("key")).agg(F.max_by("ticker", "ord").alias("ticker"))


def map_from_column(df: DataFrame, map_col: str) -> DataFrame:
    """A name → ticker MAP column (JSON object as stored) to ordered rows."""
    return df.select(F.posexplode(F.map_entries(F.col(map_col))).alias("ord", "e")).select(
        F.col("ord").cast("long").alias("ord"), F.col("e.key").alias("name"), F.col("e.value").alias("ticker"))


def union_maps(maps: list[DataFrame]) -> DataFrame:
    return reduce(update_map, maps)
