"""Merkle dataset manifest with octopus multiproofs.

Every row is a leaf, the leaves of a source form a tree of runs of 16, and the roots of the sources form one
more such tree. Leaves get their places by a range sort and the counts of its partitions. Blocks of 4,096
places (three levels) are hashed in one go each, first over leaves, then over the nodes of the level that was reached.

Proofs are made for blocks of leaves, not one by one. A block works out the coordinates that its leaves need on
their ways to the root and that can't be derived from the leaves themselves (the octopus: each level adds the
siblings that neither are known nor become known from below). These nodes are fetched once by a join, the
interiors that the proofs share are derived once, and each leaf's proof is cut out of them. The way from a source's
root to the root of all is the same for all its blocks, so it is worked out once for each source.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .tables import Scratch, written

#: Children of a node; levels that a block hashes in one go, so that it has FAN**RISE places.
FAN, RISE = 16, 3
#: Nodes from this level on are fetched by very many blocks: their keys are salted.
HIGH, SALTS = 6, 64
#: Rows of a lookup table (one for each source and partition) up to which it is broadcast.
BROADCAST_ROWS = 1_000_000
#: Every fifth document, by crc32 of its id, is tampered with.
TAMPERED = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_NODES = "tree string, n long, level int, idx long, hash string, top boolean"


def sha(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def heights(n: int) -> list[int]:
    """Nodes of each level of a tree with n leaves, 1 at the last."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // FAN))
    return out


def field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(text: Column) -> Column:
    return F.sha2(F.concat(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text)), 256)


def tree_key(source: Column) -> Column:
    """A key without nulls in the order of the sources (null first, UTF-8 bytewise)."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _joined(df: DataFrame, lookup: DataFrame, on: list[str]) -> DataFrame:
    return df.join(F.broadcast(lookup) if lookup.count() <= BROADCAST_ROWS else lookup, on)


def placed(rows: DataFrame, order: list[str], scratch: Scratch, rise: int) -> DataFrame:
    """``rows`` (tree, ...) with n (rows of the tree), pos (place in ``order`` within the tree) and block."""
    d = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    d = scratch(d.withColumn("_task", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "manifest-sorted")
    parts = d.groupBy("tree", "_task").agg(F.count("_at").alias("_rows"), F.min("_at").alias("_first"))
    tasks = Window.partitionBy("tree").orderBy("_task")  # one row for each task that holds rows of the tree
    start = F.coalesce(F.sum("_rows").over(tasks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = scratch(parts.select("tree", "_task", "_first", start.alias("_start"), F.sum("_rows").over(Window.partitionBy("tree")).alias("n")), "manifest-tasks")
    d = _joined(d, parts, ["tree", "_task"]).withColumn("pos", F.col("_at") - F.col("_first") + F.col("_start"))
    return d.withColumn("block", F.floor(F.col("pos") / FAN**rise)).drop("_task", "_at", "_first", "_start")


def _risen(rows: pd.DataFrame, rise: int) -> pd.DataFrame:
    """The nodes of the next ``rise`` levels over the nodes (tree, n, level, idx, hash) of one block."""
    rows = rows.sort_values("idx")
    tree, n, level = rows["tree"].iloc[0], int(rows["n"].iloc[0]), int(rows["level"].iloc[0])
    counts = heights(n)
    first, hashes, out = int(rows["idx"].iloc[0]), [h.encode() for h in rows["hash"]], []
    for above in range(level + 1, min(level + rise, len(counts) - 1) + 1):
        hashes = [sha(b"".join(hashes[i : i + FAN])) for i in range(0, len(hashes), FAN)]
        first //= FAN
        out += [(tree, n, above, first + i, h.decode(), counts[above] == 1) for i, h in enumerate(hashes)]
    return pd.DataFrame(out, columns=["tree", "n", "level", "idx", "hash", "top"])


def forest(leaves: DataFrame, scratch: Scratch, rise: int) -> DataFrame:
    """All nodes above the leaves (tree, n, pos, leaf) of every tree: (tree, n, level, idx, hash, top)."""

    def risen(rows: pd.DataFrame) -> pd.DataFrame:
        return _risen(rows, rise)

    largest = leaves.agg(F.max("n")).first()[0] or 0
    nodes, base = None, 0
    below = leaves.where("n > 1").select("tree", "n", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("hash"))
    while base == 0 or base < len(heights(largest)) - 1:
        own = below.withColumn("_block", F.floor(F.col("idx") / FAN**rise)).groupBy("tree", "_block").applyInPandas(risen, _NODES)
        own = scratch(own, f"manifest-nodes{base}")
        nodes = own if nodes is None else nodes.union(own)
        base += rise
        below = own.where((F.col("level") == base) & ~F.col("top")).drop("top")
    return nodes


def roots(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, n, root) of every tree."""
    single = leaves.where("n = 1").select("tree", "n", F.col("leaf").alias("root"))
    return single.union(nodes.where("top").select("tree", "n", F.col("hash").alias("root")))


def missing(places: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The least set of (level, idx) that the proofs of the leaves at ``places`` need besides these leaves."""
    out, known = [], np.unique(places)
    for level, count in enumerate(heights(n)[:-1]):
        runs = np.unique(known // FAN)
        children = (runs[:, None] * FAN + np.arange(FAN)).ravel()
        out += [(level, int(i)) for i in np.setdiff1d(children[children < count], known, assume_unique=True)]
        known = runs
    return out


def runs_to_root(places: np.ndarray, hashes: list[bytes], fetched: dict[tuple[int, int], bytes], n: int) -> list[dict[int, bytes]]:
    """For each level the joined hashes of the runs that hold the given leaves; interiors are derived once."""
    out, known = [], dict(zip(places.tolist(), hashes))
    for level, count in enumerate(heights(n)[:-1]):
        joined = {}
        for run in sorted({i // FAN for i in known}):
            children = range(run * FAN, min((run + 1) * FAN, count))
            joined[run] = b"".join(known[i] if i in known else fetched[level, i] for i in children)
        out.append(joined)
        known = {run: sha(all_) for run, all_ in joined.items()}
    return out


def way(runs: list[dict[int, bytes]], place: int) -> list[tuple[bytes, bytes]]:
    """The siblings of one leaf, level by level: those left and those right of its way to the root."""
    out = []
    for joined in runs:
        place, at = divmod(place, FAN)
        all_ = joined[place]
        out.append((all_[: 64 * at], all_[64 * at + 64 :]))
    return out


def fold(leaf: bytes, steps: list[tuple[bytes, bytes]]) -> bytes:
    for left, right in steps:
        leaf = sha(left + leaf + right)
    return leaf


def _needed(rows: pd.DataFrame) -> pd.DataFrame:
    """(tree, n, block, level, idx) that the leaves (tree, n, block, pos) of one block miss."""
    tree, n, block = rows["tree"].iloc[0], int(rows["n"].iloc[0]), int(rows["block"].iloc[0])
    return pd.DataFrame([(tree, n, block, level, idx) for level, idx in missing(rows["pos"].to_numpy(), n)], columns=["tree", "n", "block", "level", "idx"])


def fetched(wanted: DataFrame, leaves: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(tree, block, level, idx, hash): what each block of ``wanted`` (tree, n, pos, block) needs besides its leaves."""
    need = wanted.select("tree", "n", "block", "pos").groupBy("tree", "block").applyInPandas(_needed, "tree string, n long, block long, level int, idx long")
    need = scratch(need, "manifest-needed")
    known = nodes.select("tree", "level", "idx", "hash")
    if need.where("level = 0").limit(1).count():
        known = known.union(leaves.where("n > 1").select("tree", F.lit(0), "pos", "leaf"))
    salts = lambda level: F.when(level >= HIGH, SALTS).otherwise(1)
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), salts(F.col("level")) - 1)))
    need = need.withColumn("salt", F.pmod(F.col("block"), salts(F.col("level"))).cast("int"))
    return need.join(known, ["tree", "level", "idx", "salt"]).select("tree", "block", "level", "idx", "hash")


def _split(rows: pd.DataFrame) -> dict[tuple[int, int], bytes]:
    return dict(zip(zip(rows["level"].tolist(), rows["idx"].tolist()), (h.encode() for h in rows["hash"])))


def _upper(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """For each leaf (a source's root) of one block of the upper tree its siblings on the left and right, level by level."""
    n, places = int(left["n"].iloc[0]), left["pos"].to_numpy()
    runs = runs_to_root(places, [h.encode() for h in left["leaf"]], _split(right), n)
    ways = [way(runs, p) for p in places.tolist()]
    return pd.DataFrame({"tree": left["source_tree"], "subroot": left["leaf"], "lefts": [[a.decode() for a, _ in w] for w in ways], "rights": [[b.decode() for _, b in w] for w in ways]})


@dataclass
class Manifest:
    """``leaves`` (tree, n, pos, block, leaf, and the columns of the rows), ``nodes`` above them, one row for each source in
    ``sources`` (tree, subroot, lefts, rights: the siblings on its way to the root), and the ``root``, None without rows."""

    leaves: DataFrame
    nodes: DataFrame
    sources: DataFrame
    root: str | None
    scratch: Scratch


def manifest(docs: DataFrame, rise: int = RISE) -> Manifest:
    """The manifest of ``docs`` (doc_id integer, text, lang, source, n_chars).

    Null values hash as ``-``, empty texts as ``0:``; whole texts of any length are hashed. The rows of a null source form the
    first tree. Within a source, rows with a null doc_id come first and equal ids go by their leaf hashes, so repeated
    rows are leaves of their own, next to each other. Other columns aren't read, whatever their names. An empty
    table has no rows and the root None.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0, leaf_hash(F.translate(F.col("text"), UPPER, LOWER)))
    rows = docs.select(tree_key(F.col("source")).alias("tree"), "doc_id", leaf_hash(F.col("text")).alias("leaf"), tampered.alias("tampered"))
    leaves = scratch(placed(scratch(rows, "manifest-rows"), ["doc_id", "leaf"], scratch, rise), "manifest-leaves")
    nodes = forest(leaves, scratch, rise)
    own = roots(leaves, nodes).select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), F.col("root").alias("leaf"))
    upper = scratch(placed(own, ["source_tree"], scratch, rise), "manifest-sources")
    above = forest(upper, scratch, rise)
    root = roots(upper, above).first()
    right = fetched(upper, upper, above, scratch).groupBy("tree", "block")
    sources = upper.groupBy("tree", "block").cogroup(right).applyInPandas(_upper, "tree string, subroot string, lefts array<string>, rights array<string>")
    return Manifest(leaves, nodes, scratch(sources, "manifest-ways"), root and root["root"], scratch)


def _proven(left: pd.DataFrame, right: pd.DataFrame, root: str) -> pd.DataFrame:
    """The proofs of the wanted leaves of one block, and what they give for the tampered leaves."""
    left = left.sort_values("pos")
    above, right = right[right["level"] < 0].iloc[0], right[right["level"] >= 0]
    n, places = int(left["n"].iloc[0]), left["pos"].to_numpy()
    hashes = [h.encode() for h in left["leaf"]]
    runs = runs_to_root(places, hashes, _split(right), n)
    upper = [(a.encode(), b.encode()) for a, b in zip(above["lefts"], above["rights"])]
    proof, folded = [], []
    for place, leaf, tampered in zip(places.tolist(), hashes, left["tampered"]):
        steps = way(runs, place) + upper
        proof.append(hashlib.sha256(b"".join(s for step in steps for s in step)).hexdigest())
        folded.append(fold(tampered.encode() if isinstance(tampered, str) else leaf, steps).decode())
    return pd.DataFrame({"doc_id": left["doc_id"], "leaf": left["leaf"], "subroot": above["hash"], "root": root, "proof_sha256": proof, "folded_root": folded, "verified": [f == root for f in folded]})


def proofs(m: Manifest, wanted: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each of ``wanted``, any rows of ``m.leaves``.

    proof_sha256 hashes the siblings from the leaf to the root; folded_root is what the siblings make of the
    tampered leaf where there is one, else of the leaf itself.
    """
    sources, blocks, root = m.sources, wanted.select("tree", "block").distinct(), m.root
    if sources.count() <= BROADCAST_ROWS // 1000:  # up to 10 KB each
        sources = F.broadcast(sources)
    # the way above a source's root comes once for each block
    above = blocks.join(sources, "tree").select("tree", "block", F.lit(-1).alias("level"), F.lit(0).cast("long").alias("idx"), F.col("subroot").alias("hash"), "lefts", "rights")
    right = fetched(wanted, m.leaves, m.nodes, m.scratch).unionByName(above, allowMissingColumns=True)

    def proven(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return _proven(a, b, root)

    schema = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    left = wanted.select("tree", "block", "n", "pos", F.col("doc_id").cast("string").alias("doc_id"), "leaf", "tampered")  # pandas has no long with nulls
    out = left.groupBy("tree", "block").cogroup(right.groupBy("tree", "block")).applyInPandas(proven, schema)
    return out.withColumn("doc_id", F.col("doc_id").cast(wanted.schema["doc_id"].dataType))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proof of every document of the table."""
    m = manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    out = written(proofs(m, m.leaves), "manifest-proofs")
    m.scratch.clear()
    return out


_FIELDS = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"
_LOWERED = f"translate(text, '{UPPER}', '{LOWER}')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_FIELDS.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: crc32 bit by bit: each byte is followed by eight steps (-1); then both trees by recursion over levels, and the fold by recursion over steps.
SQL = f"""
WITH RECURSIVE
crc AS (SELECT doc_id, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda x, e: CASE WHEN e >= 0 THEN xor(x, e) ELSE xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1)) END),
    CAST(4294967295 AS BIGINT)) AS crc FROM documents),
d AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf_sql('text')} AS leaf,
    CASE WHEN crc % {TAMPERED} = 0 THEN {_leaf_sql(_LOWERED)} END AS tampered,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM documents JOIN crc USING (doc_id)),
node(tree, level, idx, hash, n) AS (
  SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM d
  UNION ALL
  SELECT tree, any_value(level) + 1, idx // 16, sha256(string_agg(hash, '' ORDER BY idx)), any_value((n + 15) // 16)
  FROM node WHERE n > 1 GROUP BY tree, idx // 16),
sub AS MATERIALIZED (SELECT tree, hash AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos FROM node WHERE n = 1),
upper(level, idx, hash, n) AS (
  SELECT 0, pos, subroot, count(*) OVER () FROM sub
  UNION ALL
  SELECT any_value(level) + 1, idx // 16, sha256(string_agg(hash, '' ORDER BY idx)), any_value((n + 15) // 16)
  FROM upper WHERE n > 1 GROUP BY idx // 16),
every AS (SELECT tree, level, idx, hash FROM node WHERE n > 1 UNION ALL SELECT NULL, level, idx, hash FROM upper WHERE n > 1),
side AS MATERIALIZED (SELECT tree, level, idx,
    coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM every WINDOW w AS (PARTITION BY tree, level, idx // 16 ORDER BY idx)),
step AS MATERIALIZED (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY above, level) AS k, l, r FROM (
  SELECT d.doc_id, 0 AS above, s.level, s.l, s.r FROM d JOIN side s ON s.tree = d.tree AND s.idx = d.pos // CAST(pow(16, s.level) AS BIGINT)
  UNION ALL
  SELECT d.doc_id, 1, s.level, s.l, s.r FROM d JOIN sub ON sub.tree = d.tree JOIN side s ON s.tree IS NULL AND s.idx = sub.pos // CAST(pow(16, s.level) AS BIGINT))),
fold(doc_id, k, x) AS (
  SELECT doc_id, CAST(1 AS BIGINT), coalesce(tampered, leaf) FROM d
  UNION ALL
  SELECT f.doc_id, f.k + 1, sha256(s.l || f.x || s.r) FROM fold f JOIN step s ON s.doc_id = f.doc_id AND s.k = f.k),
folded AS (SELECT doc_id, arg_max(x, k) AS folded_root FROM fold GROUP BY doc_id),
proof AS (SELECT d.doc_id, sha256(coalesce(string_agg(l || r, '' ORDER BY k), '')) AS proof_sha256 FROM d LEFT JOIN step USING (doc_id) GROUP BY d.doc_id)
SELECT d.doc_id, d.leaf, sub.subroot, (SELECT hash FROM upper WHERE n = 1) AS root, proof_sha256, folded_root,
  folded_root = (SELECT hash FROM upper WHERE n = 1) AS verified
FROM d JOIN sub ON sub.tree = d.tree JOIN proof ON proof.doc_id = d.doc_id JOIN folded ON folded.doc_id = d.doc_id"""
