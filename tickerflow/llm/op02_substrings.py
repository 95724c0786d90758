"""Substring dedup by suffix automata over shards of reference passages.

A run of ``window`` words that a document shares with an earlier one (smaller id) is
removed. The references are all documents, so their automata can't be broadcast whole; they
are cut into shards that hold all copies of a window together, and only passages that can match
enter them:

* Each window of words has an anchor: the least hash among the runs of ``ANCHOR`` words in it.
  Equal windows have equal anchors. Neighbouring windows with the same anchor are one segment.
* Anchors of one document only can't match. The others go into a Bloom filter of bounded
  size, which is broadcast; it passes all segments that matter and few others.
* Equal segments become one reference with its smallest id. The references of an anchor are
  a shard: its automaton grows in the order of ids while the references stream through
  it, and their matching statistics tell for each window which id had it first.
* Anchors with very many different references (the edges of passages that many documents share)
  are cut further, into their windows, so that no shard grows with them.

The documents then lose the words of all windows whose first id is smaller than their own.

Each step is written, and the shuffles and tables of the steps before it are deleted, so the disk holds one step at a time.
"""

from __future__ import annotations

import hashlib
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .tables import Scratch, shuffles_dropped, written
from .words import SPACE_SPLIT, Block, blocks, mix, slices

WINDOW, ANCHOR = 13, 5
#: References of an anchor beyond which it is cut into windows, and anchors that are at most.
MAX_SHARD, MAX_CUT = 500, 1_000_000
#: Bits of the Bloom filter for each anchor, and at most (rounded up, 64 MB).
FILTER_BITS, MAX_FILTER_BITS, FILTER_HASHES = 12, 1 << 28, 3
#: Pieces of the filter on their way to the driver, and 64-bit words that it takes at a time (8 MB).
PIECES, TAKEN_WORDS = 1024, 1 << 20


def _anchors(b: Block, window: int, anchor: int):
    """(anchor, first window, last window, document) of the segments of a block; places are words."""
    grams = b.grams(b.hashes(), anchor)
    n = len(grams) - window + 1
    if n <= 0:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    least, at = grams[:n].copy(), np.arange(n)
    for k in range(1, window - anchor + 1):
        other = grams[k : k + n]
        less = other < least
        least[less] = other[less]
        at[less] = np.flatnonzero(less) + k
    doc = b.doc
    ok = np.flatnonzero(b.fits(window)[:n])
    if not len(ok):
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    new = np.r_[True, (at[ok][1:] != at[ok][:-1]) | (np.diff(ok) != 1) | (np.diff(doc[ok]) != 0)]
    first = ok[new]
    last = ok[np.r_[np.flatnonzero(new)[1:] - 1, len(ok) - 1]]
    return least[first], first, last, doc[first]


def _positions(anchor: np.ndarray, bits: int) -> list[np.ndarray]:
    return [mix(anchor ^ np.uint64(0xA5A5A5A5 + k)) % np.uint64(bits) for k in range(FILTER_HASHES)]


def _emit_anchors(batches, window: int, anchor: int):
    """The anchors of each document, once each."""
    for batch in batches:
        valid = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        for b in blocks(batch.column("text"), SPACE_SPLIT):
            key, _, _, doc = _anchors(b, window, anchor)
            use = valid[b.first + doc]
            key, doc = key[use], doc[use]
            order = np.lexsort((key, doc))
            key, doc = key[order], doc[order]
            new = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])] if len(key) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(key[new].view(np.int64))], names=["anchor"])


def _emit_bits(batches, bits: int):
    """(word, mask) of the filter for anchors."""
    for batch in batches:
        place = np.concatenate(_positions(batch.column("anchor").to_numpy().view(np.uint64), bits))
        mask = np.uint64(1) << (place & np.uint64(63))
        yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array(mask.view(np.int64))], names=["word", "mask"])


def _emit_pieces(batches, width: int):
    """(piece, its ``width`` words as bytes) of the filter, from rows of (word, mask); all words of a piece are among the batches."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        word, mask = batch.column("word").to_numpy(), batch.column("mask").to_numpy().view(np.uint64)
        order = np.argsort(word // width)
        piece, first = np.unique((word // width)[order], return_index=True)
        for p, own in zip(piece.tolist(), np.split(order, first[1:])):
            held.setdefault(p, np.zeros(width, np.uint64))[word[own] % width] = mask[own]
    for p, words in held.items():
        yield _batch([(p, words.tobytes())], {"piece": pa.int64(), "words": pa.binary()})


def _emit_packed(batches):
    """The anchors of a batch as the bytes of one row."""
    for batch in batches:
        yield _batch([(batch.column("anchor").to_numpy().tobytes(),)], {"anchors": pa.binary()})


def _held(cut: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether each anchor is one of the sorted anchors."""
    return cut[np.minimum(np.searchsorted(cut, key), len(cut) - 1)] == key if len(cut) else np.zeros(len(key), bool)


def _passing(key: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the filter holds each anchor."""
    keep = np.ones(len(key), bool)
    for place in _positions(key, 64 * len(bits)):
        keep &= (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
    return keep


def _segments(batch, shared_filter, window: int, anchor: int, cut: np.ndarray = np.zeros(0, np.int64)):
    """(row, anchor, words, first window, whether the anchor is one of the sorted ``cut``) of the segments of a batch that pass the filter."""
    bits = shared_filter.value
    for b in blocks(batch.column("text"), SPACE_SPLIT):
        key, first, last, doc = _anchors(b, window, anchor)
        keep = _passing(key, bits)
        raw = b.data.tobytes()
        key, first, last, doc = key[keep].view(np.int64), first[keep], last[keep], doc[keep]
        begin, end = b.starts[first], b.ends[last + window - 1]
        at = first - b.bounds[doc]
        for row, k, x, y, i, is_cut in zip((doc + b.first).tolist(), key.tolist(), begin.tolist(), end.tolist(), at.tolist(), _held(cut, key).tolist()):
            yield row, k, b" ".join(raw[x:y].split()), i, is_cut


def _emit_segments(batches, shared_filter, window: int, anchor: int):
    for batch in slices(batches):
        ids = batch.column("doc_id").to_pylist()
        rows = [(k, words, ids[row]) for row, k, words, *_ in _segments(batch, shared_filter, window, anchor) if ids[row] is not None]
        yield _batch(rows, {"anchor": pa.int64(), "words": pa.binary(), "doc_id": pa.int64()})


def _emit_members(batches, shared_filter, shared_cut, window: int, anchor: int):
    cut = shared_cut.value
    for batch in slices(batches):
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
        rows = []
        for row, _, words, at, is_cut in _segments(batch, shared_filter, window, anchor, cut):
            if ids[row] is not None:
                for j, piece in enumerate(_windows(words, window)) if is_cut else [(0, words)]:
                    rows.append((hashlib.md5(piece).digest(), ids[row], texts[row], at + j))
        yield _batch(rows, {"piece": pa.binary(), "doc_id": pa.int64(), "key": pa.int64(), "at": pa.int64()})


def _batch(rows: list[tuple], kinds: dict) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))


def _windows(words: bytes, window: int) -> list[bytes]:
    w = words.split(b" ")
    return [b" ".join(w[i : i + window]) for i in range(len(w) - window + 1)]


def _emit_windows(batches, window: int):
    for batch in batches:
        yield _batch([(x, d) for words, d in zip(batch.column("words").to_pylist(), batch.column("first_id").to_pylist()) for x in _windows(words, window)], {"words": pa.binary(), "first_id": pa.int64()})


class SuffixAutomaton:
    """Of several word sequences, each with an id; ids must not fall from one to the next."""

    def __init__(self):
        self.next, self.link, self.length, self.first = [{}], [-1], [0], [None]

    def _state(self, moves: dict, link: int, length: int, first) -> int:
        self.next.append(moves), self.link.append(link), self.length.append(length), self.first.append(first)
        return len(self.link) - 1

    def _split(self, p: int, q: int, word) -> int:
        """The state for the strings of q that are one word longer than p's."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1, self.first[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list, first_id) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = self._split(last, q, word)
                continue
            new, p = self._state({}, 0, self.length[last] + 1, first_id), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, self.next[p][word], word)
            last = new

    def first_ids(self, words: list, window: int) -> list:
        """For each window of the words: the id of the first sequence that holds it, or None."""
        state = length = 0
        out = []
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            while length > window or state and self.length[self.link[state]] >= window:  # the state of the last `window` words
                if self.length[self.link[state]] >= window:
                    state = self.link[state]
                length = min(length, window)
            if i >= window - 1:
                out.append(self.first[state] if length >= window else None)
        return out


def _shard(rows, window: int):
    """(words, first ids of its windows) of the references of one anchor, which come in the order of their ids."""
    automaton = SuffixAutomaton()
    held = next(rows, None)
    empty = True
    while held is not None:
        words, own = held[1].split(b" "), held[2]
        found = [None] * (len(words) - window + 1) if empty else automaton.first_ids(words, window)
        held_words, held = held[1], next(rows, None)
        if held is not None and None in found:
            automaton.add(words, own)
            empty = False
        yield hashlib.md5(held_words).digest(), [own if x is None else x for x in found]


def _emit_first(batches, window: int):
    """Rows sorted by (anchor, first_id)."""
    rows = (r for batch in batches for r in zip(batch.column("anchor").to_pylist(), batch.column("words").to_pylist(), batch.column("first_id").to_pylist()))
    kinds, out = {"piece": pa.binary(), "first_ids": pa.list_(pa.int64())}, []
    for _, own in groupby(rows, lambda r: r[0]):
        for x in _shard(iter(own), window):
            out.append(x)
            if len(out) >= 20_000:
                yield _batch(out, kinds)
                out = []
    yield _batch(out, kinds)


def _emit_kept(batches, window: int):
    for batch in slices(batches):
        starts = batch.column("starts").to_pylist()
        out = []
        for b in blocks(batch.column("text"), SPACE_SPLIT):
            raw = b.data.tobytes()
            for d in range(b.n_docs):
                low, high = int(b.bounds[d]), int(b.bounds[d + 1])
                words = raw[b.offsets[d] : b.offsets[d + 1]].split()
                runs = []
                if starts[b.first + d]:
                    mark = np.zeros(high - low + 1, np.int64)
                    at = np.unique(np.array(starts[b.first + d], np.int64))
                    mark[at] += 1
                    mark[at + window] -= 1
                    gone = np.r_[False, np.cumsum(mark[:-1]) > 0, False]
                    runs = [{"from": int(x), "to": int(y)} for x, y in zip(np.flatnonzero(gone[1:] & ~gone[:-1]), np.flatnonzero(~gone[1:] & gone[:-1]))]
                    words = [w for w, g in zip(words, gone[1:-1].tolist()) if not g]
                out.append((high - low, high - low - len(words), b" ".join(words).decode(errors="replace"), runs))
        kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_text": pa.string(), "removed": pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))}
        rest = _batch(out, kinds)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *rest.columns], names=["doc_id", *kinds])


def _anchor_filter(text: DataFrame, scratch: Scratch, window: int, anchor: int) -> np.ndarray:
    """Bloom filter of the anchors that two rows or more have, as 64-bit words."""
    counts = text.mapInArrow(partial(_emit_anchors, window=window, anchor=anchor), "anchor long").groupBy("anchor").agg(F.count("anchor").alias("n"))
    return _bloom(scratch(counts.where("n > 1").select("anchor"), "anchors"))


def _bloom(shared: DataFrame) -> np.ndarray:
    """Bloom filter of the anchors of a written table, as 64-bit words. The driver takes it as bytes, some pieces at a time."""
    bits = 64 << max(0, int(min(MAX_FILTER_BITS, FILTER_BITS * shared.count()) // 64).bit_length())
    words = shared.mapInArrow(partial(_emit_bits, bits=bits), "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    n, scratch = bits // 64, Scratch(shared.sparkSession)
    width = max(1, n // PIECES)
    pieces = scratch(words.repartition(F.expr(f"word div {width}")).mapInArrow(partial(_emit_pieces, width=width), "piece long, words binary"), "filter-pieces")
    out, step = np.zeros(n, np.uint64), max(1, TAKEN_WORDS // width)
    for at in range(0, n // width, step):
        for r in pieces.where((F.col("piece") >= at) & (F.col("piece") < at + step)).collect():
            out[r["piece"] * width :][:width] = np.frombuffer(r["words"], np.uint64)
    scratch.clear()
    return out


def _gone(text: DataFrame, keyed: DataFrame, window: int, anchor: int) -> DataFrame:
    """(doc_id, key, starts) of the documents that lose windows, written."""
    spark, size = text.sparkSession, {"window": window, "anchor": anchor}
    early, late = Scratch(spark), Scratch(spark)
    passing = spark.sparkContext.broadcast(_anchor_filter(text, early, **size))
    early.clear()
    refs = text.mapInArrow(partial(_emit_segments, shared_filter=passing, **size), "anchor long, words binary, doc_id long")
    refs = early(refs.groupBy("anchor", "words").agg(F.min("doc_id").alias("first_id")), "references")
    many = refs.groupBy("anchor").agg(F.count("words").alias("n")).where(F.col("n") > MAX_SHARD).orderBy(F.desc("n"), "anchor").limit(MAX_CUT)
    many = early(many.select("anchor"), "cut-anchors")  # MAX_CUT at most
    packed = [np.frombuffer(r["anchors"], np.int64) for r in many.mapInArrow(_emit_packed, "anchors binary").collect()]
    cut = spark.sparkContext.broadcast(np.sort(np.concatenate([np.zeros(0, np.int64), *packed])))
    few = refs.join(F.broadcast(many), "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor", "first_id", "words")
    first = few.mapInArrow(partial(_emit_first, window=window), "piece binary, first_ids array<bigint>")
    pieces = refs.join(F.broadcast(many), "anchor", "left_semi").mapInArrow(partial(_emit_windows, window=window), "words binary, first_id long")
    pieces = pieces.groupBy("words").agg(F.min("first_id").alias("first_id")).select(F.unhex(F.md5("words")).alias("piece"), F.array("first_id").alias("first_ids"))
    first = late(first.unionByName(pieces), "first-ids")
    early.clear()
    members = keyed.mapInArrow(partial(_emit_members, shared_filter=passing, shared_cut=cut, **size), "piece binary, doc_id long, key long, at long")
    gone = members.join(first, "piece").select("doc_id", "key", F.filter(F.transform("first_ids", lambda x, i: F.when(x < F.col("doc_id"), F.col("at") + i)), lambda x: x.isNotNull()).alias("starts"))
    gone = gone.where(F.size("starts") > 0).groupBy("doc_id", "key").agg(F.flatten(F.collect_list("starts")).alias("starts"))  # one document's windows
    gone = written(gone, "gone-windows")
    late.clear()
    return gone


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, removed) of each row of ``docs`` (doc_id integer, text).

    Words are runs of characters other than the six ASCII spaces, unchanged. A word goes if a window of ``window``
    words that covers it also starts in a row with a smaller doc_id; all windows are judged on the
    input. ``removed`` lists the maximal runs of gone words, [from, to); ``kept_text`` joins the rest
    by one space. Null or empty text has no words. Rows with equal ids don't remove from each other; rows
    with a null id lose nothing and remove nothing. Other columns aren't read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = {"window": window, "anchor": anchor}
    keyed = text.withColumn("key", F.xxhash64("text"))
    with shuffles_dropped(spark):
        gone = _gone(text, keyed, **size)
    return keyed.join(gone, ["doc_id", "key"], "left").mapInArrow(partial(_emit_kept, window=window), "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<`from`: int, `to`: int>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents of the table against each other."""
    kept = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
