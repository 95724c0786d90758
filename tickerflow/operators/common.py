"""Small distributed building blocks shared by several operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F


def global_row_number(df: DataFrame, order_cols: list[str], out: str = "rn",
                      partitions: int | None = None) -> DataFrame:
    """1-based row number over a total order without a single-partition window.

    Range-partition on the order, number rows inside each partition, then add the
    row count of all earlier partitions. Only the per-partition counts (one row
    per partition) meet in one place; ``order_cols`` must be a total order.
    The rows are checkpointed with their partition numbers before both uses: a second
    evaluation may be cut into other partitions (AQE coalesces each by its own sizes).
    """
    r = df.repartitionByRange(partitions, *order_cols) if partitions else df.repartitionByRange(*order_cols)
    r = r.withColumn("_pid", F.spark_partition_id()).checkpoint()
    r = r.withColumn("_lrn", F.row_number().over(Window.partitionBy("_pid").orderBy(*order_cols)))
    counts = r.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    offs = counts.select("_pid", F.coalesce(
        F.sum("_c").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ).alias("_off"))
    return r.join(F.broadcast(offs), "_pid").withColumn(out, F.col("_off") + F.col("_lrn")).drop(
        "_pid", "_lrn", "_off")


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Hash-repartition ``df`` only when it has fewer partitions than the cluster's
    default parallelism (e.g. one large single-row-group file feeding CPU-heavy
    text work). A scan of many files is left alone: no shuffle is added there."""
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, key) if key else df.repartition(want)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder as Parquet and read again: computed once (a checkpoint runs its
    plan twice), kept if executors are lost, and with its size known to the planner."""
    from ..session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Counted:
    """Row counts of the stages of a plan, taken while the plan runs (A19): ``counted("before", df)`` passes its rows through;
    after an action ``counts()`` has the rows of each stage. No stage is run again for its count."""

    def __init__(self) -> None:
        self.stages: dict[str, Observation] = {}

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        self.stages[name] = Observation()
        return df.observe(self.stages[name], F.count(F.lit(1)).alias("rows"))

    def counts(self) -> dict[str, int]:
        return {name: o.get.get("rows", 0) for name, o in self.stages.items()}


# Row bound under which a derived dimension table (a name dictionary, an alias
# list) is shipped whole to every task.
BROADCAST_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` only behind a size check: one count, and above ``max_rows``
    the table is returned as is so Spark plans a shuffle join instead."""
    return F.broadcast(df) if df.count() <= max_rows else df


def cpu_parallel(df: DataFrame, key: str | None = None) -> DataFrame:
    """Repartition a small-in-bytes but CPU-heavy input (distinct entities before
    fuzzy scoring, long entities before a containment join) to the cluster's
    parallelism. AQE would coalesce such a shuffle by size into one or two tasks;
    an explicit partition count is left as is."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n, key) if key else df.repartition(n)
