"""Similarity joins of names by the token-sort ratio.

The ratio of two texts is 200 * LCS / (length + length) of their token-sorted forms. With a ratio of t the two
forms differ by at most D = (length + length) * (1 - t / 100) insertions and deletions, and each of them
destroys at most q of a form's q-grams. So of the first q * D + 1 grams of a form, in any one order of all grams, one
is also among the first of the other form: candidates come from an equi-join on these, rarest grams first. The
pairs left after the lengths and the counts of common grams are compared by a bit-parallel LCS.
No pair is formed without a shared gram, and no table passes the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WS_RUN_RE, ustrip
from .common import bounded_broadcast, stored

WORD = 64


def token_sorted(c: Column) -> Column:
    """The words of a text in order, joined by one space."""
    return F.array_join(F.array_sort(F.split(ustrip(c), WS_RUN_RE)), " ")


def grams(text: str, q: int) -> list[str]:
    """The q-grams of a text; a repeated one carries the number of those before it. A shorter text is one gram."""
    seen: dict[str, int] = {}
    out = []
    for g in [text[i : i + q] for i in range(len(text) - q + 1)] or [text]:
        out.append(f"{g}\0{seen[g]}" if g in seen else g)
        seen[g] = seen.get(g, 0) + 1
    return out


def _with_grams(batches, q: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("x"), pa.array([grams(x, q) for x in batch.column("x").to_pylist()], pa.list_(pa.string()))], names=["x", "grams"])


def gram_size(threshold: float) -> int:
    """The longest grams of which a text always has more than a partner at the threshold can destroy (two characters at
    most); below a threshold of two thirds there are none."""
    share = (200 - 2 * threshold) / threshold  # of a text's length, with its longest partner
    if share >= 1:
        raise ValueError("a threshold above 200 / 3 is needed")
    return 2 if 2 * share < 0.5 else 1


def _allowed(length: Column, threshold: float) -> Column:
    """Insertions and deletions between texts of this length together."""
    return F.floor(length * (1 - threshold / 100) + 1e-9)


def _signed(texts: DataFrame, threshold: float, frequency: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(x, grams, token): the rare grams of each of the distinct token-sorted ``texts`` (x); and the counts of all grams."""
    q = gram_size(threshold)
    rows = texts.select("x").mapInArrow(partial(_with_grams, q=q), "x string, grams array<string>")
    every = rows.select("x", F.explode("grams").alias("gram"))
    if frequency is None:
        frequency = stored(every.groupBy("gram").agg(F.count("x").alias("n")), "grams")
    longest = F.floor(F.length("x") * ((200 - 2 * threshold) / threshold) + 1e-9)
    ranked = every.join(bounded_broadcast(frequency), "gram", "left").groupBy("x").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))).alias("ranked"))  # one text's grams
    out = rows.join(ranked, "x").select("x", "grams", F.explode(F.slice("ranked", F.lit(1), (q * longest + 1).cast("int"))).alias("r"))
    return out.select("x", "grams", F.col("r.gram").alias("token")), frequency


def candidates(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (x, y) of token-sorted texts of ``left`` and ``right`` (x) whose ratio may reach the threshold."""
    b, frequency = _signed(right, threshold)
    a, _ = _signed(left, threshold, frequency)
    pairs = a.join(b.select(F.col("x").alias("y"), F.col("grams").alias("others"), "token"), "token")
    lx, ly = F.length("x"), F.length("y")
    shorter = 200 * F.least(lx, ly) >= threshold * (lx + ly)
    common = F.size(F.array_intersect("grams", "others"))
    lost = gram_size(threshold) * _allowed(lx + ly, threshold)
    return pairs.where(shorter & (common >= F.greatest(F.size("grams"), F.size("others")) - lost)).select("x", "y").distinct()


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """LCS lengths of the pairs (a[i], b[i]): one bit for each character of ``b`` in as many machine words as it takes, all
    pairs of a batch one character of ``a`` at a time. Words are chained by the carry of their sums."""
    out = np.zeros(len(a), np.int64)
    words = np.array([-(-len(s) // WORD) for s in b], np.int64)
    for count in np.unique(words[words > 0]).tolist():
        own = np.flatnonzero(words == count)
        out[own] = _lcs_words([a[i] for i in own], [b[i] for i in own], count)
    return out


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, and where each starts."""
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), np.cumsum([0, *map(len, texts)])


def _lcs_words(a: list[str], b: list[str], words: int) -> np.ndarray:
    row_of: dict[str, int] = {}
    rows = np.array([row_of.setdefault(s, len(row_of)) for s in b])
    codes, starts = _codes(list(row_of))
    alphabet, code = np.unique(codes, return_inverse=True)
    text = np.repeat(np.arange(len(row_of)), np.diff(starts))
    bit = np.arange(len(codes)) - starts[text]
    masks = np.zeros((len(row_of), len(alphabet) + 1, words), np.uint64)  # last letter: in none of the texts
    np.bitwise_or.at(masks, (text, code, bit // WORD), np.uint64(1) << (bit % WORD).astype(np.uint64))
    letters, first = _codes(a)
    at = np.minimum(np.searchsorted(alphabet, letters), len(alphabet) - 1)
    letters = np.where(alphabet[at] == letters, at, len(alphabet))
    lengths = np.diff(first)
    rows_left = np.argsort(-lengths, kind="stable")  # pairs whose text has ended leave at the end
    v = np.full((len(a), words), np.iinfo(np.uint64).max, np.uint64)
    for k in range(int(lengths.max(initial=0))):
        live = rows_left[: np.searchsorted(-lengths[rows_left], -k, side="left")]
        found = masks[rows[live], letters[first[live] + k]]
        now, carry = v[live], np.zeros(len(live), np.uint64)
        for w in range(words):
            u = now[:, w] & found[:, w]
            total = now[:, w] + u
            over = total < u
            total, more = total + carry, carry
            over |= (total < more)
            now[:, w], carry = total | (now[:, w] & ~u), over.astype(np.uint64)
        v[live] = now
    size = np.array([len(s) for s in b])
    last = np.where(size % WORD == 0, np.uint64(0), np.uint64(np.iinfo(np.uint64).max) << (size % WORD).astype(np.uint64))
    v[:, -1] |= last  # bits beyond the text don't count
    return words * WORD - np.bitwise_count(v).sum(axis=1).astype(np.int64)


def _scored(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
        total = np.array([len(s) + len(t) for s, t in zip(x, y)], np.int64)
        ratio = np.where(total == 0, 100.0, 200.0 * lcs_lengths(x, y) / np.maximum(total, 1))
        yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), pa.array(ratio)], names=["x", "y", "score"])


def similar(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """All pairs (x, y, score) of token-sorted texts of ``left`` and ``right`` (x) with a ratio of at least ``threshold``."""
    from ..session import ship_package

    ship_package(left.sparkSession)
    pairs = candidates(left.select("x").distinct(), right.select("x").distinct(), threshold)
    return pairs.mapInArrow(_scored, "x string, y string, score double").where(F.col("score") >= threshold)
