"""Mixing sources to target weights by repetition rates.

Words are summed per source, targets follow from the weights, and each document of a source
is taken ``floor(rate)`` times plus once more with probability ``rate - floor(rate)``, where
rate = target / words of the source. The draw is a hash of seed and ``doc_id``, so reruns
and retried tasks agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = 17
#: Sources (rows of one string and four numbers) up to which their table is broadcast.
BROADCAST_SOURCES = 100_000

_OWN = ("size", "source_size", "target", "copies", "taken")


def n_words(text: Column) -> Column:
    """Runs of characters other than the six ASCII spaces; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target), one row per source, null last.

    The sources, in code point order, weigh ``weights`` in turn and share all words. A target
    stops at ``max_repeat`` times its source; the excess goes to the others by weight until
    none is above: target = least(max_repeat * size, level * weight), where level is the
    greatest of the levels that result from capping the k sources with the least
    size / weight, over all k.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on: the single-partition windows hold a table of sources, not of documents.
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    capped = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - max_repeat * F.coalesce(F.sum("source_size").over(capped), F.lit(0))
    level = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(capped), F.lit(0)))
    t = sums.withColumn("weight", weight).withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return t.select("source", "source_size", F.least((max_repeat * F.col("source_size")).cast("double"), F.col("level") * F.col("weight")).alias("target"))


def draw(seed: int) -> Column:
    """A number in [0, 1) from seed and doc_id; rows with equal ids draw alike."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(16**13))


def repetitions(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """``docs`` (doc_id, text, source) with size, source_size, target, copies and taken.

    Every row is kept, also with 0 copies. Null or empty text has size 0; a source without words
    has target 0 and no copies. Null is a source of its own. Repeated rows each count in the
    sums and are each taken alike. Columns with the names of results are replaced, all others stay.
    """
    sized = docs.drop(*_OWN).withColumn("size", n_words(F.col("text")))
    table = targets(sized, weights, max_repeat).withColumnRenamed("source", "_source")
    if table.count() <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = (F.floor(rate) + (draw(seed) < rate - F.floor(rate)).cast("long")).cast("long")
    out = sized.join(table, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    return out.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies"))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``."""
    names = [f"_in{i}" if c in _OWN else c for i, c in enumerate(docs.columns)]
    taken = repetitions(docs.toDF(*names), weights, max_repeat, seed)
    taken = taken.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return taken.select(*names).toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the table, with what the mix takes of it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return repetitions(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS turn FROM d GROUP BY source
), w AS (
  SELECT *, CASE turn % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s
), c AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(3.0 * source_size, (SELECT max(level) FROM c) * weight) AS target FROM c
), r AS (
  SELECT d.doc_id, d.size, t.source_size, CAST(t.target AS DOUBLE) AS target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken FROM r
"""
