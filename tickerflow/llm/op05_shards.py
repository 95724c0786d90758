"""Sharding by a minimax contiguous partition of ordered atomic groups.

Documents with equal texts form an atomic group. The groups, in the order of their text's
SHA-256, are cut into contiguous shards so that the largest shard is as small as it can be: a
binary search finds the smallest capacity that a greedy filling can keep with the given
number of shards. Among the cuts that keep this capacity, those nearest to equal shares are taken.

The ends of the groups (running sums of their sizes) stay in Spark. The driver sees ranges of
ends, summed up as (first end, last end, count), and asks for finer ones only where a lookup
of the search falls inside a range; both the search's answer and the cuts are exact. What it
holds depends on the number of shards, not on the groups.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

N_SHARDS = 24
#: Ranges of the first level, and into how many a range is split when it is needed finer.
RANGES, FINER = 4096, 4096
#: Parts that the rows of one group are numbered in.
SALTS = 64

_OWN = ("size", "text_crc32", "shard", "slot")


class Ends:
    """Looks up ends of groups; ``missed`` collects the ranges that were too coarse for a lookup."""

    def __init__(self, table: DataFrame):
        self.table = table  # (range, offset, range_size, end)
        self.level: dict[tuple, tuple] = {}
        self._take(table.groupBy("range").agg(F.min("end"), F.max("end"), F.count("end")).collect(), 0)
        self.total = int(self.last[-1]) if len(self.last) else 0

    def _take(self, rows, depth: int) -> None:
        for r in rows:
            self.level[tuple(r[:-3])] = (*r[-3:], depth)
        self.keys = sorted(self.level, key=lambda k: self.level[k][0])
        values = [self.level[k] for k in self.keys]
        self.first, self.last, self.count = (np.array([v[i] for v in values], np.int64) for i in range(3))
        self.missed: set[tuple] = set()

    def refine(self) -> bool:
        """Splits the missed ranges, one job for each depth; False if there was nothing to split."""
        todo = sorted(self.missed)
        for depth in sorted({self.level[k][3] for k in todo}):
            keys = [k for k in todo if self.level[k][3] == depth]
            part = lambda d: F.floor((F.col("end") - F.col("offset")).cast("double") / F.col("range_size") * float(FINER**d)).cast("long")
            rows = self.table.where(F.col("range").isin(sorted({k[0] for k in keys})))
            if depth:
                rows = rows.where(F.struct("range", part(depth)).isin([F.struct(F.lit(k[0]), F.lit(k[-1]).cast("long")) for k in keys]))
            rows = rows.groupBy("range", part(depth + 1).alias("part")).agg(F.min("end"), F.max("end"), F.count("end")).collect()
            for k in keys:
                del self.level[k]
            self._take(rows, depth + 1)
        return bool(todo)

    def floor(self, at: int, hopeful: bool = False) -> int:
        """The greatest end <= at, 0 without one; if that isn't known, a lower bound (hopeful: an upper bound)."""
        i = int(np.searchsorted(self.first, at, side="right")) - 1
        if i < 0:
            return 0
        if self.last[i] <= at:
            return int(self.last[i])
        if self.count[i] > 2:
            self.missed.add(self.keys[i])
            return at if hopeful else int(self.first[i])
        return int(self.first[i])

    def ceil(self, at: int) -> int:
        """The least end >= at (at most the total); an upper bound if that isn't known."""
        if at <= 0:
            return 0
        i = int(np.searchsorted(self.last, at, side="left"))
        if i == len(self.last):
            return self.total
        if self.first[i] >= at:
            return int(self.first[i])
        if self.count[i] > 2:
            self.missed.add(self.keys[i])
        return int(self.last[i])


def _fill(ends: Ends, capacity: int, shards: int, hopeful: bool) -> bool:
    """Whether greedy filling places all groups."""
    at = 0
    for _ in range(shards):
        nxt = ends.floor(at + capacity, hopeful)
        if nxt <= at:
            return False
        at = nxt
        if at >= ends.total:
            return True
    return False


def smallest_capacity(ends: Ends, largest: int, shards: int) -> int:
    """Binary search for the least feasible capacity; ranges that leave it open are refined."""
    while True:
        found = []
        for hopeful in (True, False):
            low, high = max(-(-ends.total // shards), largest), max(ends.total, largest)
            while low < high:
                middle = (low + high) // 2
                low, high = (low, middle) if _fill(ends, middle, shards, hopeful) else (middle + 1, high)
            found.append(low)
        if found[0] == found[1]:
            return found[0]
        ends.missed.clear()
        for capacity in {found[0], (found[0] + found[1]) // 2, found[1]}:
            for hopeful in (True, False):
                _fill(ends, capacity, shards, hopeful)
        ends.refine()


def choose_cuts(ends: Ends, capacity: int, shards: int) -> list[int]:
    """Ends of the shards, the last one the total; none is above the capacity, each is as near to an equal share as the rest allows."""
    while True:
        ends.missed.clear()
        least = [ends.total]  # least[k]: from here on the last k shards can hold the rest
        for _ in range(shards - 1):
            least.append(ends.ceil(least[-1] - capacity))
        cuts = [0]
        for k in range(1, shards):
            share = cuts[-1] + -(-(ends.total - cuts[-1]) // (shards - k + 1))
            low, high = ends.floor(share), ends.ceil(share)
            cut = low if share - low <= high - share else high
            cuts.append(max(min(cut, ends.floor(cuts[-1] + capacity)), least[shards - k], cuts[-1]))
        if not ends.refine():
            return [*cuts[1:], ends.total]


def group_key(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def shard(docs: DataFrame, shards: int = N_SHARDS) -> DataFrame:
    """``docs`` (doc_id, text) with size, text_crc32, shard and slot.

    Size: UTF-8 bytes plus 8; null text has none and counts as equal to empty text. Rows with equal
    texts (repeated rows too) share a shard. Slots number the rows of a shard from 0 without
    gaps: group by group, within a group in an order that spreads over tasks. With fewer
    groups than shards some shards stay empty; an empty table gives no rows. Columns with the
    names of results are replaced, all others stay; null and repeated ids are allowed.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.drop(*_OWN).withColumns({"size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8, "text_crc32": F.crc32(F.coalesce("text", F.lit("")).cast("binary")), "_key": group_key(F.col("text")), "_salt": F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))})
    parts = rows.groupBy("_key", "_salt").agg(F.sum("size").alias("size"), F.count("size").alias("n")).checkpoint()
    groups = parts.groupBy("_key").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).withColumn("range", F.conv(F.substring("_key", 1, 3), 16, 10).cast("int"))
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over RANGES rows at most
    ranges = groups.groupBy("range").agg(F.sum("size").alias("range_size"), F.sum("n").alias("_n")).withColumn("offset", F.coalesce(F.sum("range_size").over(whole), F.lit(0))).withColumn("row_offset", F.coalesce(F.sum("_n").over(whole), F.lit(0))).drop("_n")
    running = Window.partitionBy("range").orderBy("_key")
    table = groups.join(F.broadcast(ranges), "range").withColumn("end", F.col("offset") + F.sum("size").over(running.rowsBetween(Window.unboundedPreceding, 0))).withColumn("before", F.col("row_offset") + F.coalesce(F.sum("n").over(running.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).checkpoint()
    ends = Ends(table.select("range", "offset", "range_size", "end"))
    cuts = [0] * shards
    if ends.total:
        capacity = smallest_capacity(ends, table.agg(F.max("size")).first()[0], shards)
        cuts = choose_cuts(ends, capacity, shards)
    number = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c < F.col("end")))
    table = table.withColumn("shard", number.cast("int"))
    begin = table.groupBy("shard").agg(F.min("before").alias("_begin"))
    earlier = Window.partitionBy("_key").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)  # SALTS rows at most
    place = table.join(F.broadcast(begin), "shard").select("_key", "shard", (F.col("before") - F.col("_begin")).alias("_at"))
    place = parts.select("_key", "_salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_earlier")).join(place, "_key").withColumn("_at", F.col("_at") + F.col("_earlier")).drop("_earlier")
    own = F.row_number().over(Window.partitionBy("_key", "_salt").orderBy("doc_id"))
    return rows.withColumn("_own", own).join(place, ["_key", "_salt"]).withColumn("slot", F.col("_at") + F.col("_own") - 1).drop("_key", "_salt", "_own", "_at")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the table in 24 shards of near-equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
