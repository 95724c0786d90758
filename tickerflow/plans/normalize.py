"""Presentation of query results so Spark and the DuckDB oracle agree bit for bit.

Doubles are rounded to ``SIG`` significant digits, but to at most ``MAX_DECIMALS``
decimals, using only exact powers of ten (x * 10^k or x / 10^k with 0 <= k <= 22),
so both engines perform the same IEEE operations. Before rounding the value is
scaled by ``NUDGE``: decimal data (cents averaged over 20 rows) produces exact
ties such as ...8585 that two engines' last-bit noise would round apart; the nudge
moves every such tie clear of the boundary. ``+ 0.0`` folds -0.0 into 0.0.
Dates become ``yyyy-MM-dd`` text, integers BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIG = 9
MAX_DECIMALS = 6
NUDGE = "1.0000000000001"


def finish(df: DataFrame) -> DataFrame:
    """Apply the presentation rules column by column, by type."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            # one parsed expression per column (the same text the DuckDB oracle uses)
            c = F.expr(sql_sig(f"`{f.name}`"))
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def sql_sig(expr: str, digits: int = SIG) -> str:
    c = f"CAST({expr} AS DOUBLE)"
    x = f"({c} * CAST({NUDGE} AS DOUBLE))"
    k = f"least({digits - 1} - floor(log10(abs({x}))), {MAX_DECIMALS})"
    return (
        f"(CASE WHEN {c} IS NULL OR isnan({c}) THEN NULL WHEN {c} = 0 THEN CAST(0.0 AS DOUBLE) "
        f"WHEN {k} >= 0 THEN round({x} * pow(10.0, {k})) / pow(10.0, {k}) + CAST(0.0 AS DOUBLE) "
        f"ELSE round({x} / pow(10.0, -{k})) * pow(10.0, -{k}) + CAST(0.0 AS DOUBLE) END)"
    )


def sql_finish(inner: str, columns: dict[str, str]) -> str:
    """Wrap ``inner`` (a full SELECT, possibly with WITH) and present its columns.

    ``columns`` maps name → kind: d double, i bigint, s text, dt date, ts timestamp, b boolean.
    """
    out = []
    for name, kind in columns.items():
        q = f'"{name}"'
        if kind == "d":
            e = sql_sig(q)
        elif kind == "i":
            e = f"CAST({q} AS BIGINT)"
        elif kind == "dt":
            e = f"strftime(CAST({q} AS DATE), '%Y-%m-%d')"
        elif kind == "ts":
            e = f"strftime(CAST({q} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')"
        else:
            e = q
        out.append(f"{e} AS {q}")
    return f"SELECT {', '.join(out)} FROM (\n{inner}\n) AS _q"
