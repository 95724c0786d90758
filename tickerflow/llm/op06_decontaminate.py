"""Benchmark decontamination by suffix arrays over the training documents.

Every task builds suffix arrays over blocks of its documents (a shard each), sorted by
their first ``window`` words, and binary-searches every suffix of the benchmark items in
them. A suffix that agrees with a document suffix in ``window`` words is an occurrence of
a window; neighbouring occurrences join to longest verbatim matches, which are returned
with their places. Documents with a match can then be removed.

Only document suffixes whose first two words follow each other in some item enter the
array: no other suffix can agree with an item in two words or more (items of one word keep
all suffixes that start with it). The benchmark is read in blocks of at most
``BENCH_BLOCK_WORDS`` words; each block is one pass over the documents. Between two passes the documents and
their hits are written, so a task holds one block, whatever the size of the benchmark, and an executor lost in a pass
only repeats that pass.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ship_package
from .tables import written
from .words import ALNUM, blocks

WINDOW = 10
#: Words of items that a task holds at once (8 bytes each, and as much again for the suffixes).
BENCH_BLOCK_WORDS = 1_000_000


def _items(rows: list, window: int) -> dict:
    """Vocabulary, suffixes and pairs of a block of items: what a task searches for."""
    column = pa.array([r["text"] for r in rows], pa.large_string())
    hashes, ends, owner = [], [], []
    for b in blocks(column, ALNUM, lower=True):
        hashes.append(b.hashes())
        base = sum(map(len, hashes[:-1]))
        ends.append(np.repeat(b.bounds[1:], np.diff(b.bounds)) + base)
        owner.append(b.doc + b.first)
    hashes, ends, owner = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((hashes, np.uint64), (ends, np.int64), (owner, np.int64)))
    vocabulary, word = np.unique(hashes, return_inverse=True)
    word = word.astype(np.int64) + 1  # 0: a word of no item
    start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
    size = np.diff(np.r_[start, len(owner)])
    length = np.repeat(np.minimum(size, window), size)
    place = np.arange(len(word))
    whole = place + length <= ends  # the suffixes that have a window
    place, length = place[whole], length[whole]
    two = length >= 2
    pairs = np.unique(word[place[two]] * (len(vocabulary) + 1) + word[place[two] + 1])
    return {"vocabulary": vocabulary, "word": np.r_[word, np.zeros(window, np.int64)], "place": place, "length": length, "item": owner[place], "pairs": pairs, "single": np.unique(word[place[~two]]), "ids": [None if r["item_id"] is None else str(r["item_id"]) for r in rows]}


def _keys(word: np.ndarray, place: np.ndarray, length: np.ndarray, window: int) -> np.ndarray:
    """The first ``length`` (at most ``window``) words of suffixes as byte strings that sort as the words do."""
    columns = np.zeros((len(place), window), ">u4")
    for k in range(window):
        inside = k < length
        columns[inside, k] = word[place[inside] + k]
    return columns.view(f"S{4 * window}").ravel()


def suffix_matches(column, items: dict, window: int):
    """Yields, for each shard of documents: its first document, for each occurrence the document, word, length and item; and the words of each document."""
    size = len(items["vocabulary"]) + 1
    by_length = [(k, np.flatnonzero(items["length"] == k)) for k in np.unique(items["length"])]
    for b in blocks(column, ALNUM, lower=True):
        hashes = b.hashes()
        at = np.searchsorted(items["vocabulary"], hashes)
        at[at == size - 1] = 0
        word = np.where(items["vocabulary"][at] == hashes, at + 1, 0) if size > 1 else np.zeros(len(hashes), np.int64)
        end = np.repeat(b.bounds[1:], np.diff(b.bounds))
        found = []
        if len(word):
            follows = np.r_[word[1:], 0] * (np.arange(len(word)) + 1 < end)
            keep = np.zeros(len(word), bool)
            if len(items["pairs"]):
                pair = word * size + follows
                near = np.minimum(np.searchsorted(items["pairs"], pair), len(items["pairs"]) - 1)
                keep |= items["pairs"][near] == pair
            if len(items["single"]):
                keep |= np.isin(word, items["single"])
            place = np.flatnonzero(keep)
            left = np.minimum(end[place] - place, window)
            key = _keys(np.r_[word, np.zeros(window, np.int64)], place, left, window)
            order = np.argsort(key, kind="stable")  # the suffix array of the shard
            place, key = place[order], key[order]
            for k, suffixes in by_length:
                # suffixes of the items, each between the first and last document suffix that starts with it
                of = _keys(items["word"], items["place"][suffixes], np.full(len(suffixes), k), window)
                head = key if k == window else _keys(np.r_[word, np.zeros(window, np.int64)], place, np.minimum(left[order], k), window)
                low, high = np.searchsorted(head, of, "left"), np.searchsorted(head, of, "right")
                n = high - low
                hit = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                found.append((place[hit], np.full(len(hit), k), np.repeat(items["item"][suffixes], n)))
        where, length, item = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        yield b, np.searchsorted(b.bounds, where, side="right") - 1, where, length, item


def _scan(batches, shared, window: int):
    items = shared.value
    for batch in batches:
        out = {n: [] for n in RESULT}
        before = [batch.column(n).to_pylist() for n in ("hits", "items")] if "hits" in batch.schema.names else None
        for b, doc, where, length, item in suffix_matches(batch.column("text"), items, window):
            mark = np.zeros(len(b.starts) + 1, np.int64)
            np.add.at(mark, where, 1)
            np.add.at(mark, where + length, -1)
            covered = np.cumsum(mark)
            order = np.argsort(doc, kind="stable")
            item = item[order]
            cut = np.searchsorted(doc[order], np.arange(b.n_docs + 1))
            for d in range(b.n_docs):
                lo, hi = b.bounds[d], b.bounds[d + 1]
                named = {items["ids"][i] for i in set(item[cut[d] : cut[d + 1]].tolist())} - {None}
                runs = []
                earlier = before[0][b.first + d] if before else []
                if cut[d] < cut[d + 1] or earlier:
                    inside = np.zeros(hi - lo + 2, np.int64)
                    inside[1:-1] = covered[lo:hi]
                    for x in earlier:
                        inside[x["from"] + 1 : x["to"] + 1] += 1
                    inside = inside > 0
                    runs = [{"from": int(x), "to": int(y)} for x, y in zip(np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1]))]
                    named |= set(before[1][b.first + d]) if before else set()
                longest = max(runs, key=lambda x: x["to"] - x["from"], default=None)
                out["n_words"].append(int(hi - lo))
                out["hits"].append(runs)
                out["items"].append(sorted(named))
                out["longest_match"].append(longest["to"] - longest["from"] if longest else 0)
                out["longest_at"].append(longest["from"] if longest else None)
        kept = [n for n in batch.schema.names if n not in RESULT]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *(pa.array(out[n], kind) for n, kind in RESULT.items())], names=[*kept, *RESULT])


RESULT = {"n_words": pa.int64(), "hits": pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])), "items": pa.list_(pa.string()), "longest_match": pa.int32(), "longest_at": pa.int32()}


def _bench_blocks(bench: DataFrame, max_words: int):
    """Lists of items of about ``max_words`` words (or one item), one after another."""
    rows, words = [], 0
    for r in bench.select("item_id", "text").where("text is not null").toLocalIterator():
        n = len(r["text"]) // 4 + 1
        if rows and words + n > max_words:
            yield rows
            rows, words = [], 0
        rows.append(r)
        words += n
    yield rows


def find_contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, max_words: int = BENCH_BLOCK_WORDS) -> DataFrame:
    """``docs`` with the columns ``n_words``, ``hits`` (covered runs of words, [from, to)), ``items``
    (ids of the items with an occurring window, sorted as strings), ``longest_match`` and
    ``longest_at`` (the longest covered run, in words, and its place; 0 and null without one).

    Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased. A window is
    ``window`` consecutive words of an item; an item of fewer words is one window, an item
    without words none. Null text has no words. Every row is judged by itself: repeated rows,
    repeated or null ids each get their own result. Items with a null id cover words but
    are named nowhere; equal items with different ids are all named. Columns of ``docs`` that
    are named as results are replaced, all others stay. An empty benchmark gives no hits, an
    empty table no rows. Very long texts are searched whole. A benchmark of more than ``max_words`` words runs
    its passes but the last when this is called.
    """
    spark = docs.sparkSession
    ship_package(spark)
    out = docs.drop(*RESULT)
    fields = StructType([f for f in out.schema.fields] + StructType.fromDDL("n_words bigint, hits array<struct<`from`: int, `to`: int>>, items array<string>, longest_match int, longest_at int").fields)
    for block, rows in enumerate(_bench_blocks(bench, max_words)):
        if block:
            names = [f"c{i}" for i in range(len(out.columns))]  # any names of docs can be written
            out = written(out.toDF(*names), "hits").toDF(*out.columns)
        shared = spark.sparkContext.broadcast(_items(rows, window))
        out = out.mapInArrow(partial(_scan, shared=shared, window=window), fields)
    return out


def remove_contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark; same columns."""
    names = [f"_in{i}" if c in RESULT else c for i, c in enumerate(docs.columns)]
    clean = find_contamination(docs.toDF(*names), bench, window).where(F.size("hits") == 0)
    return clean.select(*names).toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the table against the whole benchmark."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    covered = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["to"] - x["from"])
    return found.select("doc_id", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"), "longest_match", "longest_at")
