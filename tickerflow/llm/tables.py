"""Intermediate tables in the shared folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: computed once, kept if executors are lost, and no
    later filter is pushed into what made it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The rows of ``counts`` with the greatest ``n``, ``limit`` at most, without sorting them.

    Counts fall into buckets (of one value up to 1024, of 1 % beyond); the buckets that fit are taken from
    the top. The driver only sees the sizes of some thousand buckets.
    """
    bucket = F.when(F.col("n") <= 1024, F.col("n")).otherwise(1024 + F.floor(F.log2(F.col("n") / 1024.0) * 64)).cast("long")
    total, least = 0, None
    for r in sorted(counts.groupBy(bucket.alias("b")).agg(F.count("n").alias("c")).collect(), reverse=True):
        total += r["c"]
        if total > limit:
            break
        least = r["b"]
    return counts.where(bucket >= least) if least is not None else counts.limit(0)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of each action in the block when the action ends (else only after the driver's
    next garbage collection, so that they add up). Nothing in the block may be cached or persisted."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Scratch:
    """Intermediate tables of one operator, which ``clear`` deletes once nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        self.paths.append(scratch_path(self.spark, name))
        df.write.parquet(self.paths[-1], compression=compression)
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def clear(self) -> None:
        for name in self.paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.paths = []
