"""Near duplicates by HyperMinHash sketches.

A sketch deals the shingles of a document to BUCKETS buckets by their hashes and keeps of the least hash in
each bucket a 16-bit register: the count of its leading zeros and the MANTISSA bits that follow. Documents with
equal shingle sets become one row. Then

* bands of ROWS registers are hashed to keys; documents that share the key of a band are candidates. For this an
  empty bucket borrows the register of the first filled one in an order of its own, so that bands of short texts
  select as well as those of long ones. A pair at the threshold of 0.8 has BANDS bands, each of which agrees with a
  probability of 0.8^ROWS; it shares none with a probability of about 1e-8, a pair at 0.85 with 1e-13;
* candidates are estimated from their registers: the share of equal ones among the buckets that either of them
  fills, corrected for registers that are equal by chance (see ``collisions``). Pairs whose estimate is more than six
  standard deviations under the threshold go;
* the others are verified on their whole sets.

A key that very many documents share isn't expanded into pairs. The first rounds compare its documents with one of
them only (a different one each round), which joins most of a large group. What is left are documents of
different classes: under short keys pair by pair, under long ones in blocks of rows, each document outside the
largest class of its group with all of the group. So no link between different classes is lost, whatever a group's size.
"""

from __future__ import annotations

import hashlib
import math
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .components import components
from .op03_jaccard import _links as verified
from .op03_jaccard import _product as overlaps
from .op03_jaccard import _sets as shingle_sets
from .op03_jaccard import _whole_sets as whole_sets
from .tables import Scratch, written
from .words import SPACE_SPLIT, blocks, mix

SHINGLE, PERCENT = 2, 80
BUCKETS, ROWS, BANDS, MANTISSA = 256, 6, 80, 10
#: Bits of a hash below those that choose the bucket; the register of an empty bucket.
BITS, EMPTY = 53, 0xFFFF
#: Standard deviations that an estimate may lie under the threshold.
DEVIATIONS = 6
#: Rounds that compare the documents of a key with one of them.
STAR_ROUNDS = 2
#: Keys of more documents are long; rows and columns of a block.
LONG, BLOCK = 64, 256
#: Rows (one for each group) up to which a lookup table is broadcast.
BROADCAST_ROWS = 1_000_000


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The registers (documents x BUCKETS, uint16) of shingle sets."""
    least = np.full(len(sets) * BUCKETS, 1 << BITS, np.uint64)
    if sets and sum(map(len, sets)):
        doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        hashes = mix(np.concatenate(sets).astype(np.uint64))
        bucket = (hashes >> np.uint64(64 - 8)).astype(np.int64)
        np.minimum.at(least, doc * BUCKETS + bucket, hashes & np.uint64((1 << BITS) - 1))
    fraction, exponent = np.frexp(least.astype(np.float64))  # exact up to 2^53
    out = ((BITS - exponent) << MANTISSA) + ((2 * fraction - 1) * (1 << MANTISSA)).astype(np.int64)
    out = np.where(least == 0, (BITS + 1) << MANTISSA, out)
    return np.where(least == 1 << BITS, EMPTY, out).astype(np.uint16).reshape(-1, BUCKETS)


def _order(seed: int, n: int, rows: int = 1) -> np.ndarray:
    """Fixed permutations of n numbers, one in each row."""
    return np.argsort(mix(np.arange(rows * n, dtype=np.uint64) + np.uint64(seed << 32)).reshape(rows, n), axis=1)


_BANDS = _order(1, BUCKETS, BANDS)[:, :ROWS]
#: Where an empty bucket looks first; then all buckets by the ranks of its row of _RANKS.
_PROBES, _RANKS = _order(2, BUCKETS, 12), _order(3, BUCKETS, BUCKETS).astype(np.int16)


def filled_up(sketch: np.ndarray) -> np.ndarray:
    """Sketches whose empty buckets borrow the register of the first filled bucket in their order; empty sketches stay."""
    out = sketch.copy()
    for probe in _PROBES:
        out = np.where(out == EMPTY, sketch[:, probe], out)
    for row in np.flatnonzero((out == EMPTY).any(axis=1) & (sketch != EMPTY).any(axis=1)):
        have, want = np.flatnonzero(sketch[row] != EMPTY), np.flatnonzero(out[row] == EMPTY)
        out[row, want] = sketch[row, have[_RANKS[np.ix_(want, have)].argmin(axis=1)]]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """The keys (documents x BANDS) of sketches that aren't empty: 63-bit hashes of a band's number and registers."""
    full = filled_up(sketch).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(sketch), BANDS))
    for k in range(ROWS):
        key = mix((key << np.uint64(16)) ^ full[:, _BANDS[:, k]] ^ (key >> np.uint64(48)))
    return (key >> np.uint64(1)).astype(np.int64)


def collisions(nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """The probability that the registers of different least hashes are equal.

    With a and b hashes of the two sets in a bucket the least ones have the densities a*exp(-a*x), b*exp(-b*x), and a
    register at x covers hashes of a width of x / (2 * ln 2 * 2^MANTISSA) on average over an octave. The integral of the
    product is a * b / (a + b)^2 times that factor, and only the ratio of the sizes matters.
    """
    return nx * ny / (nx + ny) ** 2 / (2 * math.log(2) * (1 << MANTISSA))


def possible(equal: np.ndarray, filled: np.ndarray, nx: np.ndarray, ny: np.ndarray, percent: int) -> np.ndarray:
    """Whether the estimate leaves a link possible; equal: buckets with equal registers, filled: buckets that either set fills."""
    threshold, chance = percent / 100, collisions(nx.astype(np.float64), ny.astype(np.float64))
    filled = np.maximum(filled, 1)
    estimate = (equal / filled - chance) / (1 - chance)
    return (estimate >= threshold - DEVIATIONS * np.sqrt(threshold * (1 - threshold) / filled)) & (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny))


def _sketches(batches, shingle: int):
    for batch in batches:
        sets = [x for b in blocks(batch.column("text"), SPACE_SPLIT, lower=True) for x in shingle_sets(b, shingle)]
        sketch = registers(sets)
        digest = pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), digest, pa.array([r.tobytes() for r in sketch], pa.binary())], names=["doc_id", "n_shingles", "digest", "sketch"])


def _array(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def _keys(batches):
    for batch in batches:
        for low in range(0, len(batch), 256):
            part = batch.slice(low, 256)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column("id").to_numpy(), BANDS)), pa.array(band_keys(_array(part.column("sketch"))).ravel())], names=["id", "key"])


def _estimated(batches, percent: int):
    for batch in batches:
        x, y = _array(batch.column("xa")), _array(batch.column("xb"))
        equal = ((x == y) & (x != EMPTY)).sum(axis=1)
        filled = ((x != EMPTY) | (y != EMPTY)).sum(axis=1)
        keep = possible(equal, filled, batch.column("na").to_numpy(), batch.column("nb").to_numpy(), percent)
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in "ab"], names=["a", "b"])


def _likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches leave a link possible."""
    for side in "ab":
        pairs = pairs.join(reps.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("sketch").alias(f"x{side}")), side)
    pairs = pairs.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return pairs.mapInArrow(partial(_estimated, percent=percent), "a long, b long")


def _hub_pairs(cells: DataFrame, turn: int) -> DataFrame:
    """Each document of a key (id, key, label) with the key's hub of this round, unless both are in one class."""
    hub = cells.groupBy("key").agg(F.min_by(F.struct(F.col("id").alias("hub"), F.col("label").alias("hub_label")), F.struct(F.xxhash64("id", F.lit(turn)), "id")).alias("h")).select("key", "h.*")
    return cells.join(hub, "key").where("label <> hub_label and id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()


def _short_pairs(cells: DataFrame) -> DataFrame:
    """All pairs of a key whose documents are in different classes and not in one group of long keys."""
    x, y = (cells.select("key", *[F.col(c).alias(c + s) for c in ("id", "label", "grp")]) for s in "ab")
    pairs = x.join(y, "key").where("ida < idb and labela <> labelb").where(~F.coalesce(F.col("grpa") == F.col("grpb"), F.lit(False)))
    return pairs.select(F.col("ida").alias("a"), F.col("idb").alias("b")).distinct()


def _block_links(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the rows (left) and columns of one block: one for each row and class of another label that it links with.

    The sketches choose the rows and columns whose whole sets are multiplied.
    """
    none = pd.DataFrame({"a": [], "b": []}).astype("int64")
    x, y = rows[rows["left"]], rows[~rows["left"]]
    if not len(x) or not len(y):
        return none
    sx, sy = (np.frombuffer(b"".join(d["sketch"]), np.uint16).reshape(-1, BUCKETS) for d in (x, y))
    equal, filled = np.zeros((len(x), len(y)), np.int32), np.zeros((len(x), len(y)), np.int32)
    for k in range(BUCKETS):
        has = (sx[:, None, k] != EMPTY) | (sy[None, :, k] != EMPTY)
        filled += has
        equal += (sx[:, None, k] == sy[None, :, k]) & has
    nx, ny = (d["tokens"].map(len).to_numpy() for d in (x, y))
    other = x["label"].to_numpy()[:, None] != y["label"].to_numpy()[None, :]
    open_ = other & possible(equal, filled, nx[:, None], ny[None, :], percent)
    i, j = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
    if not len(i):
        return none
    x, y, nx, ny, open_ = x.iloc[i], y.iloc[j], nx[i], ny[j], open_[np.ix_(i, j)]
    both = overlaps(list(x["tokens"]), list(y["tokens"])).round().astype(np.int64)
    i, j = np.nonzero(open_ & (100 * both >= percent * (nx[:, None] + ny[None, :] - both)))
    _, first = np.unique(np.stack([i, y["label"].to_numpy()[j]]), axis=1, return_index=True)
    a, b = x["id"].to_numpy()[i[first]], y["id"].to_numpy()[j[first]]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _group_links(members: DataFrame, reps: DataFrame, sets_of, percent: int, scratch: Scratch) -> DataFrame:
    """Links that join all classes with links between them within the groups (id, label, grp)."""
    sizes = members.groupBy("grp", "label").agg(F.count("id").alias("n"))
    sizes = sizes.groupBy("grp").agg(F.sum("n").alias("n"), F.max("n").alias("largest"), F.max_by("label", F.struct("n", "label")).alias("main"))
    sizes = scratch(sizes.withColumn("m", F.col("n") - F.col("largest")).where("m > 0").drop("largest"), "near-groups")
    d = members.join(F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes, "grp").withColumn("out", F.col("label") != F.col("main"))
    d = scratch(d, "near-members")
    d = d.join(reps.select("id", "sketch"), "id").join(sets_of(d.select(F.col("id").alias("doc_id")).distinct()), "id")
    count = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    own = lambda c: F.pmod(F.xxhash64("id"), count(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), count(c) - 1))
    columns = [F.col(c) for c in ("id", "label", "sketch", "tokens")]
    x = d.where("out").select("grp", own("m").alias("i"), every("n").alias("j"), F.lit(True).alias("left"), *columns)
    y = d.select("grp", every("m").alias("i"), own("n").alias("j"), F.lit(False).alias("left"), *columns)

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        return _block_links(rows, percent)

    return x.unionByName(y).groupBy("grp", "i", "j").applyInPandas(links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, star_rounds: int = STAR_ROUNDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs`` (doc_id integer, text).

    Words are runs of characters other than the six ASCII spaces, A-Z lower-cased; a set holds the distinct
    shingles, with fewer words the whole sequence as one. Documents link where 100 * intersection >= percent *
    union; component_id is the smallest doc_id that links reach and kept marks its row. Without text or
    words the set is empty, n_shingles 0, the row linked with nothing and kept. Rows with a null id link with
    nothing, have a null component and are kept. Rows that share an id count as one document with several
    texts, in one class. Whole texts of any length are read, other columns aren't. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    plain = spark.sparkContext.broadcast((np.zeros(0, np.int64), np.zeros(0, np.int64)))  # sets in the order of hashes
    sets_of = partial(whole_sets, text=text, order=plain, shingle=shingle, percent=percent, written=scratch)
    sketches = scratch(text.mapInArrow(partial(_sketches, shingle=shingle), "doc_id long, n_shingles long, digest binary, sketch binary"), "near-sketches")
    known = sketches.where("doc_id is not null and n_shingles > 0")
    reps = scratch(known.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "near-reps")
    cells = reps.select("id", "sketch").mapInArrow(_keys, "id long, key long")
    shared = cells.groupBy("key").agg(F.count("id").alias("c")).where("c > 1")
    cells = scratch(cells.join(shared.hint("shuffle_hash"), "key"), "near-keys")

    links, checked, labels = None, None, None
    for turn in range(star_rounds + 1):
        left = cells.withColumn("label", F.col("id"))
        if labels is not None:
            left = cells.join(labels, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")
            open_ = left.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
            left = left.where("c > 2").join(open_, "key", "left_semi")
        if turn < star_rounds:
            pairs = _hub_pairs(left, turn)
        else:
            left = scratch(left, "near-open")
            spokes = left.where(F.col("c") > LONG)
            spokes = spokes.join(spokes.groupBy("key").agg(F.min("id").alias("hub")), "key").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
            groups = components(spokes, scratch).withColumnRenamed("component", "grp")
            labelled = groups.join(labels if labels is not None else groups.select("id", F.col("id").alias("component")), "id", "left")
            members = labelled.select("id", F.coalesce("component", "id").alias("label"), "grp")
            in_groups = scratch(_group_links(members, reps, sets_of, percent, scratch), "near-links")
            links = in_groups if links is None else links.union(in_groups)
            pairs = _short_pairs(left.where(F.col("c") <= LONG).join(groups, "id", "left"))
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = scratch(pairs, "near-pairs")
        found = scratch(verified(_likely(pairs, reps, percent), text, plain, shingle, percent, scratch), "near-links")
        links = found if links is None else links.union(found)
        checked = pairs if checked is None else checked.union(pairs)
        if turn >= star_rounds or labels is None or found.limit(1).count():
            labels = components(links, scratch)
    classes = reps.select("digest", "id").join(labels, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    out = sketches.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    out = written(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "near-classes")
    scratch.clear()
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of all documents of the table."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: All pairs that share a shingle, then the classes by recursion over links.
SQL = f"""
WITH RECURSIVE
words AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
cell AS MATERIALIZED (SELECT doc_id, unnest(s) AS t FROM sets),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM cell x JOIN cell y ON x.t = y.t AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
link AS MATERIALIZED (SELECT a, b FROM pair JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * n >= {PERCENT} * (len(x.s) + len(y.s) - n)),
near AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN near l ON l.a = r.seen),
class AS (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN class USING (doc_id)"""
