"""Token counts by dynamic programming over a trie of pre-tokens.

A pre-token is a word with the space before it; its tokens are the pieces of the segmentation with the
least cost, and of those with the fewest pieces. A piece costs minus the logarithm of its probability (Zipf's, by
its rank in the vocabulary), in thousandths; a byte that no piece covers is a token of its own.

Tasks take the distinct pre-tokens of a block of documents and lay them out as a trie, by sorting
them: a node is a prefix that the word before doesn't share. The forward cost of a node, the best
over the pieces that can end there, is computed once for all words that share the prefix, depth by
depth, and the words' ends keep their counts of pieces. Words of over ``TRIE_BYTES`` bytes are
done one by one, by the same recurrence.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package
from .words import SPACE_SPLIT, blocks, mix

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
TRIE_BYTES = 31
SCALE = 1000
_SPACE = b" "
_BASE = np.uint64(0x9E3779B97F4A7C15)


def read_pieces(path: str) -> dict[bytes, int]:
    """Pieces and costs of a sentencepiece vocabulary, which Spark reads; a leading space is one space byte."""
    import sentencepiece

    with open(path, "rb") as f:
        model = sentencepiece.SentencePieceProcessor(model_proto=f.read())
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    ids.sort(key=lambda i: (-model.get_score(i), i))
    total = math.log(sum(1 / (rank + 2) for rank in range(len(ids)))) if ids else 0.0
    out: dict[bytes, int] = {}
    for rank, i in enumerate(ids):
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if _SPACE not in piece[1:]:
            out.setdefault(piece, round(SCALE * (math.log(rank + 2) + total)))
    return out


class Unigram:
    """Pieces by length and hash, and the recurrence over them."""

    def __init__(self, pieces: dict[bytes, int]):
        self.pieces = pieces
        self.unknown = max(pieces.values(), default=0) + 3 * SCALE
        self.by_length = {}
        for n in sorted({len(p) for p in pieces}):
            own = [p for p in pieces if len(p) == n]
            key = _hashes(np.frombuffer(b"".join(own), np.uint8).reshape(len(own), n).astype(np.uint64))[-1]
            order = np.argsort(key)
            self.by_length[n] = (key[order], np.array([pieces[p] for p in own], np.int64)[order])

    def count(self, word: bytes) -> int:
        """Pieces of one word, by the recurrence alone."""
        text, longest = _SPACE + word, max(self.by_length, default=1)
        best = [(0, 0)]
        for end in range(1, len(text) + 1):
            cost, n = best[end - 1]
            options = [(cost + self.unknown, n + 1)]
            for begin in range(max(0, end - longest), end):
                own = self.pieces.get(text[begin:end])
                if own is not None:
                    options.append((best[begin][0] + own, best[begin][1] + 1))
            best.append(min(options))
        return best[-1][1]

    def counts(self, words: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Pieces of distinct words: rows of bytes (zero after the end), with a space in front, and their lengths."""
        order = np.argsort(words.view(f"S{words.shape[1]}").ravel(), kind="stable")
        rows, length = words[order], length[order]
        n, width = rows.shape
        same = np.logical_and.accumulate(rows[1:] == rows[:-1], axis=1).sum(axis=1) if n > 1 else np.zeros(0, np.int64)
        shared = np.r_[0, same]  # letters in common with the word before
        # the cost of a state: thousandths and count of pieces in one number, so that the least is the best
        prefix = _hashes(rows.astype(np.uint64))
        power = np.cumprod(np.full(width + 1, _BASE), dtype=np.uint64)
        best = [np.zeros(n, np.int64)]
        out = np.zeros(n, np.int64)
        for depth in range(1, width + 1):
            node = np.flatnonzero((shared < depth) & (length >= depth))  # the words that begin a node of this depth
            cost = best[depth - 1][node] + (self.unknown << 20) + 1
            for size, (keys, costs) in self.by_length.items():
                if size > depth or not len(node):
                    break
                own = prefix[depth][node] - (prefix[depth - size][node] * power[size - 1] if depth > size else np.uint64(0))
                own = mix(own)
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                hit = np.flatnonzero(keys[at] == own)
                cost[hit] = np.minimum(cost[hit], best[depth - size][node[hit]] + (costs[at[hit]] << 20) + 1)
            full = np.zeros(n, np.int64)
            full[node] = np.arange(1, len(node) + 1)
            np.maximum.accumulate(full, out=full)  # the node that each word passes (the word itself may be shorter)
            best.append(np.r_[0, cost][full])
            ends = length == depth
            out[ends] = best[depth][ends] & 0xFFFFF
        back = np.empty(n, np.int64)
        back[order] = out
        return back


def _hashes(rows: np.ndarray):
    """Prefix hashes by depth of rows of bytes; the last one, mixed, is that of the whole rows."""
    out = [np.zeros(len(rows), np.uint64)]
    for k in range(rows.shape[1]):
        out.append(out[-1] * _BASE + rows[:, k] + np.uint64(1))
    return _Prefixes(out)


class _Prefixes(list):
    def __getitem__(self, k):
        return mix(super().__getitem__(-1)) if k == -1 else super().__getitem__(k)


def _emit(batches, shared):
    model = shared.value
    for batch in batches:
        words_of, tokens = [], []
        for b in blocks(batch.column("text"), SPACE_SPLIT):
            _, at, word = np.unique(b.hashes(), return_index=True, return_inverse=True)
            begin, size = b.starts[at], b.ends[at] - b.starts[at]
            n = np.zeros(len(at), np.int64)
            short = np.flatnonzero(size <= TRIE_BYTES)
            if len(short):
                step = np.arange(TRIE_BYTES)
                inside = step < size[short][:, None]
                rows = np.zeros((len(short), TRIE_BYTES + 1), np.uint8)
                rows[:, 0] = _SPACE[0]
                rows[:, 1:][inside] = b.data[(begin[short][:, None] + step)[inside]]
                n[short] = model.counts(rows, size[short] + 1)
            for k in np.flatnonzero(size > TRIE_BYTES):
                n[k] = model.count(b.data[begin[k] : begin[k] + size[k]].tobytes())
            total = np.r_[0, np.cumsum(n[word])] if len(at) else np.zeros(1, np.int64)
            words_of.append(np.diff(b.bounds))
            tokens.append(np.diff(total[b.bounds]))
        join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(join(words_of)), pa.array(join(tokens))], names=["doc_id", "n_words", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_words, n_tokens) of each row of ``docs`` (doc_id, text), with the vocabulary in the file ``tokenizer``.

    Words are runs of characters other than the six ASCII spaces. Null or empty text has no words and no
    tokens. Repeated rows and null ids each get their counts; other columns aren't read; an empty table gives none.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Unigram(read_pieces(tokenizer)))  # one vocabulary file
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(partial(_emit, shared=shared), f"doc_id {kind}, n_words long, n_tokens long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the table."""
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
