"""Structured Streaming versions of two batch operators.

The reference has no stream; these are user-level re-aims of the seen-URL set
(X5) and of the related-ticker counts (A9), built on file sources. Without a
``delay`` their results equal the batch ones however the input is split into files and
in whatever order these arrive; the state then holds every URL, or every (key, day). With a
``delay`` state older than the watermark goes: a URL can come again after that time, and rows
later than that are not counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def intake_unique_urls(stream: DataFrame, ts: str = "ts", delay: str | None = None) -> DataFrame:
    """Incremental article intake, one row per URL (T1); with ``delay`` one row per
    URL and watermark delay."""
    if delay is None:
        return stream.dropDuplicates(["url"])
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["url"])


def daily_mentions(stream: DataFrame, ts: str = "ts", key: str = "related", delay: str | None = None) -> DataFrame:
    """Mentions per key and tumbling day (T2); rows later than ``delay`` are dropped where it is given."""
    return ((stream if delay is None else stream.withWatermark(ts, delay))
            .groupBy(F.window(ts, "1 day").alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n")))


def run_to_table(spark: SparkSession, df: DataFrame, name: str, mode: str = "append",
                 upsert_keys: list[str] | None = None) -> DataFrame:
    """Drain a stream with ``availableNow`` into parquet under the shared checkpoint
    folder and return the result as a batch DataFrame.

    ``append``: rows are final when written. ``update``: every micro-batch writes
    its changed rows with the batch id; the latest version per ``upsert_keys`` wins
    on read (a merge without a table format).
    """
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    if mode == "append":
        q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt) \
            .outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.read.schema(df.schema).parquet(out)

    def sink(batch: DataFrame, batch_id: int):
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(out)

    q = df.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).outputMode(mode) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    res = spark.read.parquet(out)
    keys = upsert_keys or []
    vals = [c for c in res.columns if c not in keys and c != "_batch"]
    latest = res.groupBy(*keys).agg(F.max_by(F.struct(*vals), "_batch").alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])


def run_within(spark: SparkSession, stream: DataFrame, name: str, delay: str, ts: str = "ts",
               once_per: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Drain a stream with ``availableNow`` into (kept, late) rows, nothing dropped unseen.

    A row is late if it is older, by more than ``delay``, than the newest row of the earlier
    batches; late rows (a null ``ts`` among them) go to a side table. With ``once_per`` a row is kept only if no row with the
    same key was kept within the limit; of a batch the oldest row of each key stays. What a batch
    needs of earlier ones is the kept rows above the limit, so that it doesn't grow with the stream.
    Every batch overwrites its own folder: a batch that runs again changes nothing.
    """
    kept, late, newest = (scratch_path(spark, f"{name}-{part}") for part in ("kept", "late", "newest"))
    schema = T.StructType([*stream.schema.fields, T.StructField("_batch", T.IntegerType())])
    clock = T.StructType([T.StructField("newest", T.TimestampType()), T.StructField("_batch", T.IntegerType())])

    def put(df: DataFrame, path: str, batch_id: int):
        df.write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")

    for path, s in ((kept, schema), (late, schema), (newest, clock)):
        put(spark.createDataFrame([], s).drop("_batch"), path, -1)

    def sink(batch: DataFrame, batch_id: int):
        own = batch.sparkSession
        before = own.read.schema(clock).parquet(newest).where(F.col("_batch") < batch_id)
        limit = before.agg((F.max("newest") - F.expr(f"interval {delay}")).alias("limit")).first()["limit"]
        on_time = F.col(ts).isNotNull() if limit is None else F.coalesce(F.col(ts) >= F.lit(limit), F.lit(False))
        put(batch.where(~on_time), late, batch_id)
        rows = batch.where(on_time)
        if once_per:
            first = rows.groupBy(once_per).agg(F.min_by(F.struct(*batch.columns), F.struct(ts, *[c for c in batch.columns if c != ts])).alias("_r"))
            rows = first.select("_r.*")
            if limit is not None:
                held = own.read.schema(schema).parquet(kept).where((F.col("_batch") < batch_id) & (F.col(ts) >= F.lit(limit)))
                rows = rows.join(held.select(once_per), once_per, "left_anti").select(*batch.columns)
        put(rows, kept, batch_id)
        put(batch.agg(F.max(ts).alias("newest")), newest, batch_id)

    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", scratch_path(spark, f"{name}-ckpt")) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return tuple(spark.read.schema(schema).parquet(path).drop("_batch") for path in (kept, late))
