"""Sources and sinks (S1-S11): JSON / CSV per ticker, keyword folders, name maps.

Readers always pass a declared schema (no inference); writers partition by
ticker so a reader prunes whole folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

KEYWORD_GROUPS = ["keywords_direct", "keywords_competitors", "keywords_macro"]


# ---------------------------------------------------------------- S1 keyword folders
def _tag(group: str):
    return lambda k: F.struct(F.lit(group).alias("group"), k.alias("keyword"))


def load_keywords(spark: SparkSession, folder: str, multi_line: bool = True) -> DataFrame:
    """Every JSON file of a folder → (ticker, group, pos, keyword).

    ``multi_line``: one pretty-printed object per file (the shipped format);
    False reads JSON lines. The three lists are concatenated in the order direct,
    competitors, macro; a missing list counts as empty. ``pos`` is the position
    in that concatenation.
    """
    raw = spark.read.schema(schemas.KEYWORD_SET).option("multiLine", multi_line).json(folder)
    tagged = [F.transform(F.coalesce(F.col(g), F.array().cast("array<string>")), _tag(g)) for g in KEYWORD_GROUPS]
    allk = raw.select("ticker", F.concat(*tagged).alias("_k"))
    return allk.select("ticker", F.posexplode("_k").alias("pos", "_e")).select(
        "ticker", F.col("_e.group").alias("group"), "pos", F.col("_e.keyword").alias("keyword"))


def write_keyword_sets(df: DataFrame, folder: str) -> None:
    """Keyword sets (ticker + three lists) as JSON lines."""
    df.write.mode("overwrite").json(folder)


# ---------------------------------------------------------------- S2 / S8 article JSON per ticker
def ticker_from_path(suffix: str = "_") -> F.Column:
    """Ticker from a file name ``X_clean.json`` → ``X``."""
    return F.regexp_extract(F.input_file_name(), "([^/_]+)_[^/]*$", 1)


def write_articles_json(df: DataFrame, folder: str) -> None:
    """JSON lines per ticker folder (S8); UTF-8 is written as is (no escaping)."""
    df.write.mode("overwrite").partitionBy("ticker").json(folder)


def read_articles_json(spark: SparkSession, folder: str, schema: T.StructType = schemas.CLEAN_ARTICLE,
                       tickers: list[str] | None = None) -> DataFrame:
    """Per-ticker article folders (S2); the ticker comes from the folder name and a
    ticker filter prunes folders before any file is opened."""
    body = T.StructType([f for f in schema.fields if f.name != "ticker"])
    df = spark.read.schema(body.add("ticker", T.StringType())).json(folder)
    return df.filter(F.col("ticker").isin(tickers)) if tickers else df


def read_json_array_files(spark: SparkSession, pattern: str, schema: T.StructType | str) -> DataFrame:
    """Files holding one JSON array each (``X_clean.json``): multiLine read, ticker
    from the file name (S2)."""
    df = spark.read.schema(schema).option("multiLine", True).json(pattern)
    return df.withColumn("ticker", ticker_from_path()) if "ticker" not in df.columns else df


# ---------------------------------------------------------------- S3 / S9 / S11 CSV
def write_csv(df: DataFrame, folder: str, partition_by: str | None = "ticker") -> bool:
    """CSV with a header, one folder per ticker (S9). Written only when the frame has
    rows (S11); returns whether anything was written."""
    if df.isEmpty():
        return False
    w = df.write.mode("overwrite").option("header", True)
    (w.partitionBy(partition_by) if partition_by else w).csv(folder)
    return True


def read_csv(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema (S3); dates parse as ``yyyy-MM-dd``."""
    return spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(folder)


# ---------------------------------------------------------------- S4 / S10 name maps and relations
def write_name_maps(m: DataFrame, folder: str, chunk: int = 1000) -> None:
    """The ordered name map as JSON objects ``{name: ticker}``, ``chunk`` entries each,
    keys in map order (one object per line)."""
    g = m.withColumn("chunk", F.floor(F.col("ord") / chunk)).groupBy("chunk").agg(
        F.array_sort(F.collect_list(F.struct("ord", "name", "ticker"))).alias("_e"))
    out = g.select("chunk", F.map_from_entries(F.transform("_e", lambda x: F.struct(x["name"], x["ticker"])))
                   .alias("names"))
    out.write.mode("overwrite").json(folder)


def read_name_maps(spark: SparkSession, folder: str) -> DataFrame:
    """JSON name objects → ordered rows (chunk, pos, name, ticker) (S4); the key order
    of each object is kept by ``posexplode(map_entries(...))``."""
    df = spark.read.schema("chunk long, names map<string,string>").json(folder)
    return df.select("chunk", F.posexplode(F.map_entries("names")).alias("pos", "e")).select(
        "chunk", "pos", F.col("e.key").alias("name"), F.col("e.value").alias("ticker"))


def write_relations(doc: DataFrame, folder: str) -> None:
    """``{target, top_related[], stats{}}`` documents (S10), stats kept as a MAP."""
    doc.select("target", "top_related", F.col("stats").cast(schemas.RELATIONS["stats"].dataType)) \
        .write.mode("overwrite").json(folder)


def read_relations(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(schemas.RELATIONS).json(folder)
