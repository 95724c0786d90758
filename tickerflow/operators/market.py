"""Market-data frames: column normalisation, vendor frames, unions, symbol lists.

P13, P14, P17, U1, U2, O2, O4, O5 of the blueprint.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import global_row_number

# Candidate column spellings of the vendor frames, first present wins.
DATE_CANDIDATES = ["time", "Date", "date", "TradingDate", "tradingDate"]
OPEN_CANDIDATES = ["open", "Open", "OpenPrice"]
CLOSE_CANDIDATES = ["close", "Close", "ClosePrice", "closePrice"]
VOLUME_CANDIDATES = ["volume", "Volume", "TotalVolume", "totalVolume"]


def normalize_price_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name and rename ``time`` to ``date``."""
    out = df.toDF(*[c.lower() for c in df.columns])
    return out.withColumnRenamed("time", "date") if "time" in out.columns else out


def sort_prices(df: DataFrame) -> DataFrame:
    """Prices ordered by ticker and date (O2); a global sort is a range shuffle."""
    return df.orderBy("ticker", "date")


def find_column(columns: list[str], options: list[str]) -> str | None:
    """First candidate present in ``columns`` (P14); schema-time, not per row."""
    for o in options:
        if o in columns:
            return o
    return None


def standardize_index_frame(df: DataFrame, symbol: str) -> DataFrame | None:
    """Pick Date/Open/Close/Volume by candidate spelling; None when Date, Close or
    Volume is missing (the frame is skipped). Open is optional (P14, P17)."""
    cols = df.columns
    d, o = find_column(cols, DATE_CANDIDATES), find_column(cols, OPEN_CANDIDATES)
    c, v = find_column(cols, CLOSE_CANDIDATES), find_column(cols, VOLUME_CANDIDATES)
    if d is None or c is None or v is None:
        return None
    sel = [F.lit(symbol).alias("Symbol"), F.col(d).alias("Date")]
    if o is not None:
        sel.append(F.col(o).alias("Open"))
    sel += [F.col(c).alias("Close"), F.col(v).alias("Volume")]
    return df.select(*sel)


def union_all(frames: list[DataFrame | None], allow_missing: bool = False) -> DataFrame | None:
    """Concatenate frames by name (U1), or with missing columns as NULL.
    Skipped (None) frames are left out (P21)."""
    kept = [f for f in frames if f is not None]
    if not kept:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), kept)


def tag_report(df: DataFrame, symbol_col: str | None, symbol: str | None, report_type: str) -> DataFrame:
    """Add the constant Symbol / Report_Type columns of a company report."""
    sym = F.col(symbol_col) if symbol_col else F.lit(symbol)
    return df.withColumn("Symbol", sym).withColumn("Report_Type", F.lit(report_type))


def top_symbols(symbols: DataFrame, n: int, exclude: str, order_col: str = "ord",
                symbol_col: str = "symbol") -> DataFrame:
    """First ``n`` symbols in list order, then drop the index symbol.
    The limit comes before the filter, so the result may hold n-1 rows."""
    return symbols.orderBy(order_col).limit(n).filter(F.col(symbol_col) != exclude)


def split_halves(symbols: DataFrame, order_col: str = "ord", part_col: str = "part") -> DataFrame:
    """Label the first floor(n/2) symbols part 1, the rest part 2.

    The row number comes from a range-partitioned numbering (no single-partition
    window); n is a plain global count joined back as a one-row table.
    """
    numbered = global_row_number(symbols, [order_col], out="_rn")
    n = symbols.agg(F.count(F.lit(1)).alias("_n"))
    return numbered.crossJoin(F.broadcast(n)).withColumn(
        part_col, F.when(F.col("_rn") <= F.floor(F.col("_n") / 2), F.lit(1)).otherwise(F.lit(2))
    ).drop("_rn", "_n")
