"""Related-ticker statistics and the relations document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP_LIST = 10
TOP_MAP = 20


def related_counts(linked: DataFrame, target: str = "target", related: str = "related") -> DataFrame:
    """Articles per (target, related ticker) (A9); ``related`` is an array holding each
    ticker once per article (a set), so a count of rows is a count of articles."""
    ex = linked.select(F.col(target).alias("target"), F.explode(related).alias("related"))
    return ex.groupBy("target", "related").agg(F.count(F.lit(1)).alias("n"))


def top_related(counts: DataFrame, k: int = TOP_MAP) -> DataFrame:
    """Rank related tickers per target by count, ties by ticker (O6); keep the top ``k``.
    ``n_distinct`` is the number of distinct related tickers (A11)."""
    w = Window.partitionBy("target").orderBy(F.desc("n"), F.asc("related"))
    return (
        counts.withColumn("rk", F.row_number().over(w))
        .withColumn("n_distinct", F.count(F.lit(1)).over(Window.partitionBy("target")))
        .filter(F.col("rk") <= k)
    )


def relations_document(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """``{target, top_related[10], stats{20}}`` per target (S10); targets without any
    related ticker get an empty list and an empty map."""
    top = top_related(counts, TOP_MAP)
    per = top.groupBy("target").agg(F.array_sort(F.collect_list(F.struct("rk", "related", "n"))).alias("_t"))
    doc = per.select(
        "target",
        F.transform(F.filter("_t", lambda x: x["rk"] <= TOP_LIST), lambda x: x["related"]).alias("top_related"),
        F.map_from_entries(F.transform("_t", lambda x: F.struct(x["related"], x["n"]))).alias("stats"),
    )
    return targets.select("target").distinct().join(doc, "target", "left").select(
        "target",
        F.coalesce("top_related", F.array().cast("array<string>")).alias("top_related"),
        F.coalesce("stats", F.create_map().cast("map<string,bigint>")).alias("stats"),
    )
