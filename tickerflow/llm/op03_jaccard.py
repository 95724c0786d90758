"""N-gram Jaccard join: which documents share most of their word shingles.

The join is a product of the sparse document by shingle matrix with its transpose,
taken block by block and never in full:

* Documents with the same set become one row of the matrix (a representative).
* Columns are ordered from rare to frequent. Two sets with a similarity of t share a shingle
  among the first ``n - ceil(t * n) + 1`` of each, so only these columns are multiplied. Very
  frequent shingles, such as those of lines that many documents share, come last and
  hardly ever are among them. The order comes from counts over all documents; it
  decides the cost only, any order gives the same result.
* Overlaps are accumulated per pair, and a pair goes as soon as the overlap so far plus what
  the rest of the smaller side could add is below the overlap that the two sizes demand.
* The pairs left are compared by their whole sets.

Links are wanted for the classes that they connect. The first rounds multiply each column by one of
its documents only (a different one each round), which already connects a large group of near copies in time
proportional to its size. Then all pairs whose documents aren't yet in one class are multiplied, so no link
between different classes is lost: pairs of short columns one by one, those of documents that long columns
connect in blocks of rows, as dense products of BLOCK by BLOCK documents over the shingles that they have.
Links are counted once the classes are known: only sets of one class can link, so each class is multiplied by itself
in blocks, which give sums per set and no pairs. Small classes share a block. Shingles are compared by 63-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .components import components
from .tables import Scratch, most_frequent, written
from .words import Block, SLICE_ROWS, SPACE_SPLIT, blocks, slices

SHINGLE, PERCENT = 4, 85
#: Rounds that multiply each column by one document.
STAR_ROUNDS = 2
#: A shingle is frequent if HOT_DF documents have it in the first HOT_SHARE of their sets (in the order of hashes, where
#: the compared columns come from). HOT_MAX (16 bytes each) are kept in the order; further ones count as rare.
HOT_SHARE, HOT_DF, HOT_MAX = 0.25, 8, 1_000_000
#: Columns of more documents are long; rows and columns of a block, shingles of a product.
LONG, BLOCK, WIDTH = 64, 256, 4096
#: Classes of at most SMALL sets share blocks of about that many sets when links are counted.
SMALL = 32
#: Ids (8 bytes each) up to which a list of documents is broadcast.
BROADCAST_IDS = 1_000_000
_COUNT_TOKENS = 1_000_000


def _sets(b: Block, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each document of a block, as non-negative 63-bit numbers."""
    hashes = b.hashes()
    full = (b.grams(hashes, shingle) >> np.uint64(1)).astype(np.int64)
    out = []
    for low, high in zip(b.bounds[:-1].tolist(), b.bounds[1:].tolist()):
        if high - low >= shingle:
            out.append(np.unique(full[low : high - shingle + 1]))
        elif high > low:
            own = b.grams(hashes[low:high], high - low)[:1] + np.uint64(high - low)
            out.append((own >> np.uint64(1)).astype(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def _count(batches, shingle: int):
    """(token, documents) of the first shingles of the sets."""
    held, n = [], 0

    def counts():
        token, c = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(token), pa.array(c.astype(np.int64))], names=["token", "n"])

    for batch in slices(batches):
        for b in blocks(batch.column("text"), SPACE_SPLIT, lower=True):
            own = [x[: math.ceil(HOT_SHARE * len(x))].copy() for x in _sets(b, shingle)]  # a view would keep the whole set
            held += own
            n += sum(map(len, own))
            if n >= _COUNT_TOKENS:
                yield counts()
                held, n = [], 0
    if n:
        yield counts()


def _coded(b: Block, shingle: int, hot: np.ndarray, code: np.ndarray) -> list[np.ndarray]:
    """Sets in which frequent shingles have the greatest numbers, the most frequent the greatest."""
    out = []
    for own in _sets(b, shingle):
        if len(hot) and len(own):
            at = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
            found = hot[at] == own
            if found.any():
                own = np.sort(np.where(found, code[at], own))
        out.append(own)
    return out


def _rows(batches, shingle: int, percent: int, order, whole: bool):
    hot, code = order.value
    for batch in slices(batches):
        sets = [x for b in blocks(batch.column("text"), SPACE_SPLIT, lower=True) for x in _coded(b, shingle, hot, code)]  # SLICE_ROWS at most
        ids = batch.column("doc_id")
        if whole:
            yield pa.RecordBatch.from_arrays([ids, _lists(sets)], names=["id", "tokens"])
            continue
        digest = pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets], pa.binary())
        prefix = [x[: len(x) - -(-percent * len(x) // 100) + 1] for x in sets]
        yield pa.RecordBatch.from_arrays([ids, pa.array([len(x) for x in sets], pa.int64()), digest, _lists(prefix)], names=["doc_id", "n_shingles", "digest", "prefix"])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64)))


def _order(text: DataFrame, shingle: int, written: Scratch):
    """The frequent shingles (sorted) and their numbers."""
    counts = text.mapInArrow(partial(_count, shingle=shingle), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = most_frequent(written(counts.where(F.col("n") >= HOT_DF), "frequent"), HOT_MAX).toPandas()
    rows = rows.sort_values(["n", "token"], ascending=[False, True])
    token = rows["token"].to_numpy(np.int64)
    code = np.int64(2**63 - 1) - np.arange(len(token), dtype=np.int64)
    by = np.argsort(token)
    return token[by], code[by]


def _needed(a: Column, b: Column, percent: int) -> Column:
    """The overlap that sets of these sizes must have."""
    return F.ceil(percent * (a + b) / (100 + percent))


def _surviving(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs whose overlap within both prefixes leaves a link possible."""
    for side in "ab":
        own = reps.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("prefix").alias(f"p{side}"))
        pairs = pairs.join(own, side)
    pairs = pairs.where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
    seen = F.least(F.element_at("pa", -1), F.element_at("pb", -1))
    rest = lambda s: F.col(f"n{s}") - F.size(F.filter(f"p{s}", lambda t: t <= F.col("seen")))
    pairs = pairs.withColumn("seen", seen).withColumn("both", F.size(F.array_intersect("pa", "pb")))
    return pairs.where(F.col("both") + F.least(rest("a"), rest("b")) >= _needed(F.col("na"), F.col("nb"), percent)).select("a", "b")


def _whole_sets(ids: DataFrame, text: DataFrame, order, shingle: int, percent: int, written: Scratch) -> DataFrame:
    """(id, tokens) of the documents ``ids`` (doc_id)."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    sets = text.join(ids, "doc_id", "left_semi").mapInArrow(partial(_rows, shingle=shingle, percent=percent, order=order, whole=True), "id long, tokens array<bigint>")
    return written(sets, "sets")


def _product(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Overlaps of all sets of x with all of y: a product of the two incidence matrices, WIDTH columns at a time."""
    columns = np.unique(np.concatenate(x))
    out = np.zeros((len(x), len(y)), np.float32)

    def places(sets):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        token = np.concatenate(sets)
        at = np.minimum(np.searchsorted(columns, token), len(columns) - 1)
        own = columns[at] == token
        row, at = row[own], at[own]
        by = np.argsort(at, kind="stable")
        return row[by], at[by]

    (rx, cx), (ry, cy) = places(x), places(y)
    for low in range(0, len(columns), WIDTH):
        a, b = np.zeros((len(x), WIDTH), np.float32), np.zeros((len(y), WIDTH), np.float32)
        for m, r, c in ((a, rx, cx), (b, ry, cy)):
            s = slice(*np.searchsorted(c, [low, low + WIDTH]))
            m[r[s], c[s] - low] = 1
        out += a @ b.T
    return out


def _linked(x: pd.DataFrame, y: pd.DataFrame, percent: int) -> np.ndarray:
    """Whether each row of x links with each of y, by their whole sets."""
    both = _product(list(x["tokens"]), list(y["tokens"])).round().astype(np.int64)
    sizes = x["tokens"].map(len).to_numpy()[:, None] + y["tokens"].map(len).to_numpy()[None, :]
    return 100 * both >= percent * (sizes - both)


def _block_links(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the rows (left) and columns of one block: one for each row and class of another label that it links with."""
    x, y = rows[rows["left"]], rows[~rows["left"]]
    if not len(x) or not len(y):
        return pd.DataFrame({"a": [], "b": []}).astype("int64")
    link = _linked(x, y, percent) & (x["label"].to_numpy()[:, None] != y["label"].to_numpy()[None, :])
    i, j = np.nonzero(link)
    # one link of each row to each class is enough to join them
    _, first = np.unique(np.stack([i, y["label"].to_numpy()[j]]), axis=1, return_index=True)
    i, j = i[first], j[first]
    a, b = x["id"].to_numpy()[i], y["id"].to_numpy()[j]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _with_group(d: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """``d`` with the columns of its group (one row for each key, written): broadcast within the bound, so that the rows of a hot group stay where they are."""
    return d.join(F.broadcast(groups) if groups.count() <= BROADCAST_IDS else groups, key)


def _blocks(clusters: DataFrame, text: DataFrame, order, shingle: int, percent: int, written: Scratch) -> DataFrame:
    """Links that join all classes with links between them within the clusters (id, label, cluster).

    The rows of the product are the documents outside the largest class of their cluster, the columns all.
    """
    groups = clusters.groupBy("cluster", "label").agg(F.count("id").alias("n")).groupBy("cluster")
    groups = groups.agg(F.sum("n").alias("n"), (F.sum("n") - F.max("n")).alias("m"), F.max_by("label", F.struct("n", "label")).alias("main")).where("m > 0")
    d = _with_group(clusters, written(groups, "jaccard-groups"), "cluster").withColumn("out", F.col("label") != F.col("main"))
    d = written(d, "jaccard-clusters")
    d = d.join(_whole_sets(d.select(F.col("id").alias("doc_id")).distinct(), text, order, shingle, percent, written), "id")
    count = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    own = lambda c: F.pmod(F.xxhash64("id"), count(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), count(c) - 1))
    x = d.where("out").select("cluster", own("m").alias("i"), every("n").alias("j"), F.lit(True).alias("left"), "id", "label", "tokens")
    y = d.select("cluster", every("m").alias("i"), own("n").alias("j"), F.lit(False).alias("left"), "id", "label", "tokens")

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        return _block_links(rows, percent)

    return x.unionByName(y).groupBy("cluster", "i", "j").applyInPandas(links, "a long, b long").distinct()


def _links(pairs: DataFrame, text: DataFrame, order, shingle: int, percent: int, written: Scratch) -> DataFrame:
    """The pairs that are links by their whole sets."""
    pairs = written(pairs, "pairs")
    sets = _whole_sets(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), text, order, shingle, percent, written)
    for side in "ba":
        pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("tokens").alias(f"t{side}")), side)
    both = F.size(F.array_intersect("ta", "tb"))
    pairs = pairs.select("a", "b", F.size("ta").alias("na"), F.size("tb").alias("nb"), both.alias("both"))
    return pairs.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _count_block(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """(digest, linked): with how many documents of other sets of its class each set of one block links."""
    own = [hashlib.blake2b(t.tobytes(), digest_size=16).digest() == d for t, d in zip(rows["tokens"], rows["digest"])]
    rows = rows[own].drop_duplicates("digest")  # an id can have further texts
    diagonal = bool((rows["i"] == rows["j"]).all())
    x = rows[rows["left"]]
    y = x if diagonal else rows[~rows["left"]]
    if not len(x) or not len(y):
        return pd.DataFrame({"digest": [], "linked": []}).astype({"linked": "int64"})
    link = (_linked(x, y, percent) & (x["component"].to_numpy()[:, None] == y["component"].to_numpy()[None, :])).astype(np.int64)
    if diagonal:
        np.fill_diagonal(link, 0)
    out = [pd.DataFrame({"digest": x["digest"], "linked": link @ y["copies"].to_numpy()})]
    if not diagonal:
        out.append(pd.DataFrame({"digest": y["digest"], "linked": link.T @ x["copies"].to_numpy()}))
    return pd.concat(out).query("linked > 0")


def _link_counts(members: DataFrame, text: DataFrame, order, shingle: int, percent: int, written: Scratch) -> DataFrame:
    """(digest, linked) of the sets with links to other sets; members (digest, id, copies, component), one row for each set."""
    groups = written(members.groupBy("component").agg(F.count("digest").alias("k")).where("k > 1"), "jaccard-groups")
    d = written(_with_group(members, groups, "component"), "jaccard-members")
    small = F.col("k") <= SMALL
    shared = max(1, math.ceil(d.where(small).count() / SMALL))
    d = d.join(_whole_sets(d.select(F.col("id").alias("doc_id")).distinct(), text, order, shingle, percent, written), "id")
    parts = F.when(small, 1).otherwise(F.ceil(F.col("k") / BLOCK)).cast("int")
    d = d.withColumn("block", F.when(small, F.pmod(F.xxhash64("component"), F.lit(shared))).otherwise(F.col("component")))
    d = d.withColumn("own", F.pmod(F.xxhash64("digest"), parts).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    d = d.select(small.alias("small"), "block", F.least("own", "part").alias("i"), F.greatest("own", "part").alias("j"), (F.col("own") <= F.col("part")).alias("left"), "digest", "component", "copies", "tokens")

    def counts(rows: pd.DataFrame) -> pd.DataFrame:
        return _count_block(rows, percent)

    return d.groupBy("small", "block", "i", "j").applyInPandas(counts, "digest binary, linked long").groupBy("digest").agg(F.sum("linked").alias("linked"))


def jaccard_classes(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, star_rounds: int = STAR_ROUNDS, count_links: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of ``docs`` (doc_id integer, text).

    Words are runs of characters other than the six ASCII spaces, A-Z lower-cased; a set holds the distinct
    shingles, with fewer words the whole sequence as one. Documents link where 100 * intersection
    >= percent * union; component_id is the smallest doc_id that links reach. Without text or words the set is
    empty, n_shingles 0 and component_id the own id. Rows with a null id get their n_shingles, link
    with nothing and have a null component. Rows that share an id count as one document with several
    texts, in one class. Other columns aren't read. An empty table gives no rows.

    With ``count_links`` n_links follows: with how many other rows the row links, those with the same set
    included; repeated rows count each. Without words, and with a null id, it is 0.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = spark.sparkContext.broadcast(_order(text, shingle, scratch))
    rows = partial(_rows, shingle=shingle, percent=percent, order=order, whole=False)
    sets = scratch(text.mapInArrow(rows, "doc_id long, n_shingles long, digest binary, prefix array<bigint>"), "jaccard-sets")
    known = sets.where("doc_id is not null and n_shingles > 0")
    reps = scratch(known.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("prefix").alias("prefix"), F.count("doc_id").alias("copies")), "jaccard-reps")
    cells = reps.select("id", F.explode("prefix").alias("token"))
    shared = cells.groupBy("token").agg(F.count("id").alias("c")).where("c > 1")
    cells = cells.join(shared.hint("shuffle_hash"), "token")
    cells = scratch(cells.join(reps.select("id", "n", F.size("prefix").alias("p"), F.element_at("prefix", -1).alias("last")), "id"), "jaccard-cells")

    links, checked, labels = None, None, None
    for turn in range(star_rounds + 1):
        left = cells.withColumn("label", F.col("id"))
        if labels is not None:
            left = cells.join(labels.select("id", "component"), "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")
            open_ = left.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token")
            left = left.where("c > 2").join(open_, "token", "left_semi")
        if turn < star_rounds:
            hub = left.groupBy("token").agg(F.min_by(F.struct(F.col("id").alias("hub"), F.col("label").alias("hub_label")), F.struct(F.xxhash64("id", F.lit(turn)), "id")).alias("h")).select("token", "h.*")
            pairs = left.join(hub, "token").where("label <> hub_label and id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
        else:
            spokes = left.where(F.col("c") > LONG)
            spokes = spokes.join(spokes.groupBy("token").agg(F.min("id").alias("hub")), "token").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
            clusters = components(spokes, scratch).withColumnRenamed("component", "cluster")
            known = labels if labels is not None else clusters.select("id", F.col("id").alias("component"))
            in_blocks = _blocks(clusters.join(known, "id", "left").select("id", F.coalesce("component", "id").alias("label"), "cluster"), text, order, shingle, percent, scratch)
            links = links.union(scratch(in_blocks, "jaccard-links")) if links is not None else scratch(in_blocks, "jaccard-links")
            left = left.where(F.col("c") <= LONG).join(clusters, "id", "left")
            x, y = (left.select("token", *[F.col(c).alias(c + s) for c in ("id", "n", "p", "last", "label", "cluster")]) for s in "ab")
            pairs = x.join(y, "token").where((F.col("ida") < F.col("idb")) & (F.col("labela") != F.col("labelb")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & ~F.coalesce(F.col("clustera") == F.col("clusterb"), F.lit(False)))
            pairs = pairs.groupBy(F.col("ida").alias("a"), F.col("idb").alias("b")).agg(F.count("token").alias("both"), *[F.first(c).alias(c) for c in ("na", "nb", "pa", "pb", "lasta", "lastb")])
            rest = F.when(F.col("lasta") <= F.col("lastb"), F.col("na") - F.col("pa")).otherwise(F.col("nb") - F.col("pb"))
            pairs = pairs.where(F.col("both") + rest >= _needed(F.col("na"), F.col("nb"), percent)).select("a", "b")
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = scratch(pairs, "jaccard-pairs")
        found = scratch(_links(_surviving(pairs, reps, percent), text, order, shingle, percent, scratch), "jaccard-links")
        links = found if links is None else links.union(found)
        checked = pairs if checked is None else checked.union(pairs)
        if turn >= star_rounds or labels is None or found.limit(1).count():
            labels = components(links, scratch)
    classes = reps.select("digest", "id", "copies").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    if count_links:
        linked = _link_counts(classes, text, order, shingle, percent, scratch)
        classes = classes.join(linked, "digest", "left").withColumn("links", F.col("copies") - 1 + F.coalesce("linked", F.lit(0)))
    out = sets.select("doc_id", "n_shingles", "digest").join(classes.drop("id", "copies", "linked"), "digest", "left")
    known = F.col("doc_id").isNotNull()
    more = [F.when(known, F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links")] if count_links else []
    out = written(out.select("doc_id", "n_shingles", F.when(known, F.coalesce("component", "doc_id")).alias("component_id"), *more), "jaccard-classes")
    scratch.clear()
    return out


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their class, one row for each id; same columns.

    Rows without words, and rows with a null id, all stay.
    """
    classes = jaccard_classes(docs, shingle, percent)
    kept = classes.where("doc_id = component_id").groupBy("doc_id").agg((F.max("n_shingles") > 0).alias("_has"), F.count("doc_id").alias("_rows"))
    if kept.count() <= BROADCAST_IDS:
        kept = F.broadcast(kept)
    names = [f"_in{i}" if c not in ("doc_id", "text") else c for i, c in enumerate(docs.columns)]
    d = docs.toDF(*names)
    stay = d.join(kept, "doc_id")
    single = ~F.col("_has") | (F.col("_rows") == 1)  # the others are repeated ids only
    once = stay.where(single).unionByName(stay.where(~single).dropDuplicates(["doc_id"])).select(*names)
    return once.unionByName(d.where("doc_id is null")).toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and numbers of links of all documents of the table."""
    return jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"), count_links=True)
