"""Vector code compression: product codes whose codebooks are learned over metric trees.

Vectors become integers, are cut into consecutive parts, and each part position has its own codebook. Tasks
take the vectors in chunks and build, once for each chunk and part position, a metric tree by the anchors hierarchy:

* Anchors: the point farthest from its anchor becomes a new one and takes over the points that are nearer to it. A
  point within half the distance of the two anchors can't change sides, so it isn't looked at.
* Middle-out: about sqrt(n) anchors are the middle layer. Below, each is divided again in the same way, down to
  LEAF points; above, the two balls whose common ball is smallest are joined until one is left.
* Every ball keeps the sum and the count of its points.

The trees are written as a table, one row for each chunk. A round walks each tree from its root: a ball
inherits the candidate entries of its parent and drops those that another candidate beats for every point of
the ball. When one is left, the entry owns the ball and takes its sum and count; only in leaves with several
candidates the points are compared one by one. Integers make all sums and comparisons exact, so neither the chunks
nor the partitions change the result. The driver sees sums of entries only, PARTS * ENTRIES rows of one part's length.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .tables import Scratch, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Integer components saturate here, so that squared distances of up to 2,048 components fit 64 bits.
LIMIT = 1 << 25
#: Components of a chunk (its trees are one row of some 2 MB), points of a leaf.
CHUNK_VALUES, LEAF = 1 << 18, 48
#: Rows up to which the sums by label are broadcast.
BROADCAST_ROWS = 1_000_000

_INTS = T.ArrayType(T.IntegerType())
_LONGS = T.ArrayType(T.LongType())
_TREE = {"order": np.int32, "points": np.int32, "low": np.int32, "high": np.int32, "parent": np.int32, "depth": np.int32, "centre": np.int32, "radius": np.int64, "sums": np.int64}


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return np.einsum("...i,...i->...", d, d)


def _anchors(x: np.ndarray, k: int) -> np.ndarray:
    """The anchor (number) of each point, with k anchors at most, fewer if all points lie on them."""
    owner = np.zeros(len(x), np.int64)
    distance = _squares(x, x[0])
    pivots = x[:1]
    while len(pivots) < k:
        far = int(np.argmax(distance))
        if not distance[far]:
            break
        own = np.flatnonzero(4 * distance > _squares(pivots, x[far])[owner])
        d = _squares(x[own], x[far])
        nearer = d < distance[own]
        own = own[nearer]
        owner[own], distance[own] = len(pivots), d[nearer]
        pivots = np.concatenate([pivots, x[far : far + 1]])
    return owner


def _joined(balls: list[tuple]) -> tuple:
    """Balls (children, points, centre, radius) joined two by two, always those with the smallest common ball."""
    n = len(balls)
    centre = np.array([b[2] for b in balls])
    radius = np.array([b[3] for b in balls])
    cost = np.sqrt(_squares(centre[:, None], centre[None])) + radius[:, None] + radius[None]
    np.fill_diagonal(cost, np.inf)
    for _ in range(n - 1):
        i, j = divmod(int(np.argmin(cost)), n)
        a, b = balls[i], balls[j]
        size = len(a[1]) + len(b[1])
        c = (a[2] * len(a[1]) + b[2] * len(b[1])) / size
        r = max(np.sqrt(_squares(c, a[2])) + a[3], np.sqrt(_squares(c, b[2])) + b[3])
        balls[i], balls[j] = ((a, b), np.concatenate([a[1], b[1]]), c, r), None
        centre[i], radius[i] = c, r
        cost[j], cost[:, j] = np.inf, np.inf
        own = np.sqrt(_squares(centre, c)) + radius + r
        own[np.isinf(cost[i])] = np.inf
        cost[i], cost[:, i] = own, own
        last = i
    return balls[last] if n > 1 else balls[0]


def _ball(x: np.ndarray, own: np.ndarray) -> tuple:
    c = x[own].mean(axis=0)
    return None, own, c, float(np.sqrt(_squares(x[own], c).max()))


def _divided(x: np.ndarray, own: np.ndarray) -> tuple:
    """The tree over the points ``own``: anchors in the middle, divided below, joined above."""
    if len(own) <= LEAF:
        return _ball(x, own)
    anchor = _anchors(x[own], int(np.ceil(np.sqrt(len(own)))))
    by = np.argsort(anchor, kind="stable")
    groups = np.split(own[by], np.flatnonzero(np.diff(anchor[by])) + 1)
    return _joined([_divided(x, g) for g in groups]) if len(groups) > 1 else _ball(x, own)


def build_tree(x: np.ndarray) -> dict[str, np.ndarray]:
    """The tree of integer points (n > 0 rows) as arrays: ``points`` in the order of the leaves, balls from the root downwards."""
    x = x.astype(np.int64)
    nodes, level, low = [], [(_divided(x.astype(np.float64), np.arange(len(x))), -1, 0)], 0
    order = np.empty(len(x), np.int64)
    depth = 0
    while level:
        below = []
        for ball, parent, low in level:
            at = len(nodes)
            nodes.append((low, low + len(ball[1]), parent, depth))
            if ball[0] is None:
                order[low : low + len(ball[1])] = ball[1]
            else:
                a, b = ball[0]
                below += [(a, at, low), (b, at, low + len(a[1]))]
        level, depth = below, depth + 1
    low, high, parent, depth = (np.array(v) for v in zip(*nodes))
    points = x[order]
    until = np.concatenate([np.zeros((1, x.shape[1]), np.int64), np.cumsum(points, axis=0)])
    sums = until[high] - until[low]
    centre = sums // (high - low)[:, None]
    radius = np.array([_squares(points[a:b], c).max() for a, b, c in zip(low, high, centre)])
    tree = {"order": order, "points": points, "low": low, "high": high, "parent": parent, "depth": depth, "centre": centre, "radius": radius, "sums": sums}
    return {k: v.astype(_TREE[k]) for k, v in tree.items()}


def walk(tree: dict[str, np.ndarray], book: np.ndarray):
    """Yields (entry, low, high, sum of the points or None) for stretches of ``points`` that cover them all.

    A ball's candidate loses to another one if its distance is greater at every point of the ball: the difference of
    the squared distances is linear, so it is least at the ball's edge. Equal distances go to the lower index.
    """
    k = len(book)
    between = _squares(book[:, None], book[None])
    centre, radius, parent, depth = tree["centre"].astype(np.int64), tree["radius"], tree["parent"], tree["depth"]
    distance = _squares(centre[:, None], book[None])
    leaf = np.ones(len(centre), bool)
    leaf[parent[1:]] = False
    open_ = np.zeros((len(centre), k), bool)  # candidates of balls that no entry owns
    levels = np.searchsorted(depth, np.arange(depth[-1] + 2))
    for first, last in zip(levels[:-1], levels[1:]):
        at = np.arange(first, last)
        candidates = open_[parent[at]] if first else np.ones((1, k), bool)
        at, candidates = at[candidates.any(axis=1)], candidates[candidates.any(axis=1)]
        if not len(at):
            return
        d = distance[at]
        best = np.where(candidates, d, np.iinfo(np.int64).max).argmin(axis=1)
        more = d - np.take_along_axis(d, best[:, None], 1)
        reach = 2 * np.sqrt(radius[at].astype(np.float64)[:, None] * between[best]) * (1 + 1e-9)
        beaten = (more > reach) | ((more >= 0) & (reach == 0) & (np.arange(k) > best[:, None]))
        candidates = candidates & ~beaten
        owned = candidates.sum(axis=1) == 1
        for i, e in zip(at[owned], best[owned]):
            yield int(e), tree["low"][i], tree["high"][i], tree["sums"][i]
        rest = ~owned & ~leaf[at]
        open_[at[rest]] = candidates[rest]
        for i, c in zip(at[~owned & leaf[at]], candidates[~owned & leaf[at]]):
            some = np.flatnonzero(c)
            low, high = tree["low"][i], tree["high"][i]
            own = some[_squares(tree["points"][low:high].astype(np.int64)[:, None], book[some][None]).argmin(axis=1)]
            cut = [0, *(np.flatnonzero(np.diff(own)) + 1), len(own)]
            for a, b in zip(cut[:-1], cut[1:]):
                yield int(own[a]), low + a, low + b, None


def _integers(column, dim: int) -> np.ndarray:
    """Rows of ``dim`` finite components as integers."""
    values = np.asarray(column.flatten(), np.float64).reshape(-1, dim)
    return np.clip(np.floor(values * SCALE), -LIMIT, LIMIT).astype(np.int64)


def _lists(arrays: list[np.ndarray], kind) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([a.size for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([a.ravel() for a in arrays]).astype(kind)))


def _chunks(batches, dim: int, parts: int, size: int):
    """One row for each chunk of ``size`` vectors: ids, labels and the tree of each part position."""
    held, n = [], 0

    def row(table):
        x = _integers(table.column("x").combine_chunks(), dim)
        trees = [build_tree(p) for p in np.split(x, parts, axis=1)]
        fields = [_lists([t[k] for t in trees], kind) for k, kind in _TREE.items()]
        trees = pa.StructArray.from_arrays(fields, names=list(_TREE))
        one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
        return pa.RecordBatch.from_arrays([one(table.column("id").combine_chunks()), one(table.column("label").combine_chunks()), one(trees)], names=["ids", "labels", "trees"])

    for batch in batches:
        held.append(batch)
        n += len(batch)
        while n >= size:
            table = pa.Table.from_batches(held)
            yield row(table.slice(0, size))
            held, n = table.slice(size).to_batches(), n - size
    if n:
        yield row(pa.Table.from_batches(held))


def _trees(batch, at: int, parts: int) -> list[dict[str, np.ndarray]]:
    """The trees of one row."""
    column = batch.column("trees")
    first = column.offsets[at].as_py()
    out = [{} for _ in range(parts)]
    for k in _TREE:
        field = column.values.field(k)
        offsets, values = field.offsets.to_numpy(), field.values.to_numpy(zero_copy_only=False)
        for p in range(parts):
            out[p][k] = values[offsets[first + p] : offsets[first + p + 1]]
    for t in out:
        for k in ("points", "centre", "sums"):
            t[k] = t[k].reshape(len(t["order"]) if k == "points" else len(t["low"]), -1)
    return out


def _entry_sums(batches, books):
    """(part, entry, position, total) over a task's chunks; position -1 is the count."""
    book = books.value
    parts, entries, width = book.shape
    total = np.zeros((parts, entries, width + 1), np.int64)
    for batch in batches:
        for at in range(len(batch)):
            for p, tree in enumerate(_trees(batch, at, parts)):
                for e, low, high, cached in walk(tree, book[p]):
                    total[p, e, 0] += high - low
                    total[p, e, 1:] += cached if cached is not None else tree["points"][low:high].sum(axis=0, dtype=np.int64)
    at = np.indices(total.shape).reshape(3, -1)
    yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(at[2] - 1), pa.array(total.ravel())], names=["part", "entry", "position", "total"])


def _codes(batches, books):
    """(id, label, entries, error) of every vector."""
    book = books.value
    parts = len(book)
    for batch in batches:
        for at in range(len(batch)):
            trees = _trees(batch, at, parts)
            codes = np.zeros((len(trees[0]["order"]), parts), np.uint8)
            error = np.zeros(len(codes), np.int64)
            for p, tree in enumerate(trees):
                for e, low, high, _ in walk(tree, book[p]):
                    own = tree["order"][low:high]
                    codes[own, p] = e
                    error[own] += _squares(tree["points"][low:high].astype(np.int64), book[p][e])
            side = lambda name: batch.column(name).slice(at, 1).flatten()
            yield pa.RecordBatch.from_arrays([side("ids"), side("labels"), pa.array([c.tobytes().hex() for c in codes]), pa.array(error)], names=["id", "label", "code", "error"])


def finite(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector is there and has neither null nor non-finite components."""
    x = F.col(column).cast("array<double>")
    return vectors.where(F.col(column).isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))


def start_books(vectors: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """The first codebooks (part, entry, position): the parts of the vectors (id, x) with the smallest ids; ties by components."""
    fits = vectors.where((F.size("x") > 0) & (F.size("x") % parts == 0) & F.col("id").isNotNull())
    rows = fits.orderBy("id", "x").limit(entries).collect()
    if rows and any(len(r["x"]) != len(rows[0]["x"]) for r in rows):
        rows = fits.where(F.size("x") == len(rows[0]["x"])).orderBy("id", "x").limit(entries).collect()
    if not rows:
        return None
    x = np.clip(np.floor(np.array([r["x"] for r in rows], np.float64) * SCALE), -LIMIT, LIMIT).astype(np.int64)
    return np.ascontiguousarray(x.reshape(len(x), parts, -1).transpose(1, 0, 2))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """(vec_id, label, code, error) of each row of ``vectors`` (vec_id, embedding, label) that has a finite vector,
    and the codebooks (part, entry, position).

    Rows with a null vector, null or non-finite components go. Components become floor(4096 * x) and saturate at 2^25.
    The common length is that of the vector with the smallest id whose length is a positive multiple of ``parts``; a
    vector of another length keeps its row with null code and error. Null ids are coded, but start no codebook; with
    fewer vectors than entries the codebooks are shorter; unused entries stay. Repeated rows and ties: equal
    vectors get equal codes, equal distances the lower index. Null labels are allowed, other columns aren't
    read. An empty table gives no rows and no codebooks.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    kept = finite(vectors).select(F.col("vec_id").alias("id"), F.col("label"), F.col("embedding").cast("array<double>").alias("x"))
    id_type, label_type = (kept.schema[c].dataType for c in ("id", "label"))
    coded_type = T.StructType([T.StructField("id", id_type), T.StructField("label", label_type), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    books = start_books(kept, parts, entries)
    if books is None:
        none = kept.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return none.withColumnRenamed("id", "vec_id"), None
    dim = parts * books.shape[2]
    tree = T.StructType([T.StructField(k, _LONGS if kind is np.int64 else _INTS) for k, kind in _TREE.items()])
    rows = T.StructType([T.StructField("ids", T.ArrayType(id_type)), T.StructField("labels", T.ArrayType(label_type)), T.StructField("trees", T.ArrayType(tree))])
    chunks = scratch(kept.where(F.size("x") == dim).mapInArrow(partial(_chunks, dim=dim, parts=parts, size=max(CHUNK_VALUES // dim, 1)), rows), "code-trees")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        sums = chunks.mapInArrow(partial(_entry_sums, books=shared), "part long, entry long, position long, total long")
        total = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
        for r in sums.groupBy("part", "entry", "position").agg(F.sum("total").alias("total")).collect():
            total[r["part"], r["entry"], r["position"] + 1] = r["total"]
        count = total[:, :, :1]
        books = np.where(count > 0, total[:, :, 1:] // np.maximum(count, 1), books)
    coded = chunks.mapInArrow(partial(_codes, books=spark.sparkContext.broadcast(books)), coded_type)
    other = kept.where(F.size("x") != dim).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    out = written(coded.unionByName(other), "codes")
    scratch.clear()
    return out.withColumnRenamed("id", "vec_id"), books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, the error summed over the rows of equal labels, nulls together (null if none has a code)."""
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    if totals.count() <= BROADCAST_ROWS:
        totals = F.broadcast(totals)
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors of the table, with their errors and the digest of the codebooks."""
    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = F.lit(None if books is None else books_digest(books)).cast("string")
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def _sql() -> str:
    parts = ["""
kept AS MATERIALIZED (SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cell AS (SELECT vec_id, len(embedding) // 8 AS w, unnest(range(len(embedding))) AS i, unnest(embedding) AS x FROM kept),
q AS MATERIALIZED (SELECT vec_id, i // w AS part, i % w AS pos, CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM cell),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 16),
b0 AS MATERIALIZED (SELECT part, e, pos, x FROM q JOIN first USING (vec_id))"""]
    for k in range(ROUNDS + 1):
        parts.append(f"""
a{k} AS MATERIALIZED (SELECT vec_id, part, min(d * 16 + e) AS k FROM (
  SELECT q.vec_id, q.part, b.e, CAST(sum((q.x - b.x) * (q.x - b.x)) AS BIGINT) AS d
  FROM q JOIN b{k} b ON q.part = b.part AND q.pos = b.pos GROUP BY q.vec_id, q.part, b.e) GROUP BY vec_id, part)""")
        if k < ROUNDS:
            parts.append(f"""
b{k + 1} AS MATERIALIZED (SELECT b.part, b.e, b.pos, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN (
  SELECT q.part, a.k % 16 AS e, q.pos, CAST(floor(CAST(sum(q.x) AS DOUBLE) / count(*)) AS BIGINT) AS x
  FROM q JOIN a{k} a ON q.vec_id = a.vec_id AND q.part = a.part GROUP BY q.part, a.k % 16, q.pos) m
  ON b.part = m.part AND b.e = m.e AND b.pos = m.pos)""")
    return "WITH " + ",".join(parts) + f""",
coded AS (SELECT vec_id, string_agg(format('{{:02x}}', k % 16), '' ORDER BY part) AS code, CAST(sum(k // 16) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, e, pos)) FROM b{ROUNDS}) AS codebooks_sha256
FROM kept JOIN coded USING (vec_id)"""


#: One Lloyd round after the other over single components.
SQL = _sql()
