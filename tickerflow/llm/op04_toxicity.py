"""Toxicity by a fuzzy lexicon and the context of its hits.

Learning: on a bounded sample of the labelled rows, words and word beginnings (stems) that toxic documents have far
oftener than others become the lexicon. Its terms form a trie; the trie is intersected
with the Levenshtein automaton of distance one (for terms of ``FUZZY_LENGTH`` letters or more)
and made deterministic, once. Tasks run all words of a block through the automaton side by
side, letter by letter.

Each hit is judged in its window of ``CONTEXT`` characters before and after: quotation
marks on both sides, or a word of reporting before it, make it a quotation. Counts of exact, misspelled and quoted
hits, with the strongest term, enter a logistic score whose weights are fitted on the
same sample, with a prior that holds where the sample is silent (as for quotations, if
no labelled row quotes).
"""

from __future__ import annotations

import unicodedata
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .tables import written
from .words import text_buffers

FOLDS, HELD_OUT = 5, 0
#: Labelled rows to learn from, about this many of each label (hash of the id; all if there are fewer).
SAMPLE = {1: 20_000, 0: 40_000}
MIN_ROWS, MIN_ODDS = 5, 3.0
#: Terms of one automaton; a larger lexicon is matched part by part.
PART_TERMS = 200
STEMS, MIN_STEM_WORDS = (4, 5, 6), 5
FUZZY_LENGTH, CONTEXT, BLOCK = 5, 60, 1 << 19

# Quotation marks, and words that report speech.
QUOTES = '"“”„«»‘’‹›'
REPORTING = "said says wrote writes called quoted quote word term insult reads".split()

#: Weights before any row is seen: bias, exact, misspelled, quoted hits (log of 1 + count), odds of the strongest unquoted term.
PRIOR, PRIOR_STRENGTH = np.array([-4.0, 3.0, 4.0, -0.5, 1.0]), np.array([0.2, 0.5, 8.0, 2.0, 0.5])


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


#: Code points with an entry in the tables below; those beyond are letters of rare scripts without capitals.
_TABLE = 0x20000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Whether each code point is part of a word (letters, marks and decimal digits, $ and @ as letters are misspelled with
    them; of ASCII and Latin-1 signs only letters from U+00C0 on), and its small letter."""
    word, lower = np.zeros(_TABLE, bool), np.arange(_TABLE, dtype=np.uint32)
    for c in range(_TABLE):
        kind = unicodedata.category(chr(c))
        word[c] = (kind[0] in "LM" or kind == "Nd") if c >= 0xC0 else chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz$@"
        if kind in ("Lu", "Lt") and len(chr(c).lower()) == 1:
            lower[c] = ord(chr(c).lower())
    return word, lower


_WORD, _LOWER = _tables()


def _lower(points: np.ndarray) -> np.ndarray:
    return np.where(points < _TABLE, _LOWER[np.minimum(points, _TABLE - 1)], points)


class _Part:
    """The trie of some terms within edit distance one, as a table; words are code points.

    Terms: (text, odds, is a stem). A word matches a term within one insertion, deletion or
    substitution of a letter (or exactly, for short terms), a stem if it begins with it.
    """

    def __init__(self, terms: list[tuple[str, float, bool]]):
        self.odds = np.array([0.0] + [o for _, o, _ in terms])
        children: list[dict[str, int]] = [{}]
        ends: list[list[int]] = [[]]
        fuzzy = [False]
        for k, (text, _, stem) in enumerate(terms, 1):
            node = 0
            loose = not stem and len(text) >= FUZZY_LENGTH
            fuzzy[0] |= loose
            for c in text:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({}), ends.append([]), fuzzy.append(False)
                node = children[node][c]
                fuzzy[node] |= loose  # some term beyond may be misspelled
            ends[node].append(k)
        letters = sorted({c for x in children for c in x})
        self.letters = np.array([ord(c) for c in letters] or [0], np.uint32)  # sorted
        stems = {k for k, t in enumerate(terms, 1) if t[2]}
        loose_terms = {k for k, t in enumerate(terms, 1) if not t[2] and len(t[0]) >= FUZZY_LENGTH}

        def closed(places: set) -> frozenset:
            """With deletions of letters, which read nothing; found stems stay found."""
            out = set(places)
            for node, edits in places:
                if node >= 0 and edits == 0 and fuzzy[node]:
                    out |= {(n, 1) for n in children[node].values() if fuzzy[n]}
            for node, edits in places:
                if node >= 0 and edits == 0:
                    out |= {(-k, 0) for k in ends[node] if k in stems}
            return frozenset((n, e) for n, e in out if not (e and (n, 0) in out))

        def after(places: frozenset, c: str | None) -> frozenset:
            out = set()
            for node, edits in places:
                if node < 0:
                    out.add((node, 0))
                    continue
                if c in children[node]:
                    nxt = children[node][c]
                    if not edits or fuzzy[nxt]:
                        out.add((nxt, edits))
                if not edits and fuzzy[node]:
                    out.add((node, 1))  # c is inserted
                    out |= {(n, 1) for x, n in children[node].items() if x != c and fuzzy[n]}  # c stands for x
            return closed(out)

        start = closed({(0, 0)})
        number, queue, rows = {frozenset(): 0, start: 1}, [start], [[0] * (len(letters) + 1)]
        self.exact, self.near = [0], [0]
        while queue:
            places = queue.pop(0)
            found = {0: [0], 1: [0]}
            for node, edits in places:
                if node < 0:
                    found[0].append(-node)
                else:
                    found[edits] += [k for k in ends[node] if not edits or k in loose_terms]
            self.exact.append(max(found[0], key=lambda k: self.odds[k]))
            self.near.append(max(found[1], key=lambda k: self.odds[k]))
            row = []
            for c in (None, *letters):
                nxt = after(places, c)
                if nxt not in number:
                    number[nxt] = len(number)
                    queue.append(nxt)
                row.append(number[nxt])
            rows.append(row)
        self.table = np.array(rows, np.int32)
        self.exact, self.near = np.array(self.exact, np.int32), np.array(self.near, np.int32)

    def match(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strongest terms (0: none) that each word matches exactly, and with an edit."""
        states = np.zeros(len(starts), np.int32)
        alive, state, at = np.arange(len(starts)), np.ones(len(starts), np.int32), starts.copy()
        while len(alive):
            k = np.minimum(np.searchsorted(self.letters, points[at]), len(self.letters) - 1)
            state = self.table[state, np.where(self.letters[k] == points[at], k + 1, 0)]
            at = at + 1
            done = at == ends[alive]
            states[alive[done]] = state[done]
            go = ~done & (state > 0)
            alive, state, at = alive[go], state[go], at[go]
        return self.exact[states], self.near[states]


class Automaton:
    """All terms (text, odds, is a stem), PART_TERMS in each part."""

    ordinary: frozenset[str] = frozenset()  # words that only look like misspelled terms

    def __init__(self, terms: list[tuple[str, float, bool]]):
        self.odds = np.array([0.0] + [o for _, o, _ in terms])
        self.parts = [(low, _Part(terms[low : low + PART_TERMS])) for low in range(0, len(terms), PART_TERMS)]

    def match(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strongest term (0: none) that each word matches, and whether it does exactly."""
        exact, near = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int32)
        for low, part in self.parts:
            for best, own in zip((exact, near), part.match(points, starts, ends)):
                own = np.where(own > 0, own + low, 0)
                better = (own > 0) & ((best == 0) | (self.odds[own] > self.odds[best]))
                best[better] = own[better]
        return np.where(exact > 0, exact, near), exact > 0


def features(column, automaton: Automaton) -> np.ndarray:
    """One row of features for each text."""
    data, offsets = text_buffers(column)
    out = np.zeros((len(offsets) - 1, len(PRIOR)))
    out[:, 0] = 1
    quotes, reporting = np.array([ord(c) for c in QUOTES], np.uint32), frozenset(REPORTING)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = min(max(int(np.searchsorted(offsets, offsets[first] + BLOCK, side="right")) - 1, first + 1), n)
        raw = data[offsets[first] : offsets[last]]
        begins = np.r_[0, np.cumsum(raw & 0xC0 != 0x80)][offsets[first : last + 1] - offsets[first]]  # documents, in code points
        text = raw.tobytes().decode("utf-8", "replace")
        points = _lower(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32))
        word = _WORD[np.minimum(points, _TABLE - 1)] | (points >= _TABLE)
        edge = np.zeros(len(points) + 1, bool)
        edge[begins] = True
        start, stop = word.copy(), word.copy()
        start[1:] &= ~word[:-1] | edge[1:-1]
        stop[:-1] &= ~word[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
        term, exact = automaton.match(points, starts, ends)
        for i in np.flatnonzero((term > 0) & ~exact) if automaton.ordinary else ():
            if points[starts[i] : ends[i]].tobytes().decode("utf-32-le", "replace") in automaton.ordinary:
                term[i] = 0
        hit = np.flatnonzero(term)
        if len(hit):
            doc = np.searchsorted(begins, starts[hit], side="right") - 1
            left, right = np.maximum(starts[hit] - CONTEXT, begins[doc]), np.minimum(ends[hit] + CONTEXT, begins[doc + 1])
            marks = np.r_[0, np.cumsum(np.isin(points, quotes))]
            quoted = (marks[starts[hit]] > marks[left]) & (marks[right] > marks[ends[hit]])
            for i in np.flatnonzero(~quoted):
                quoted[i] = not reporting.isdisjoint(text[left[i] : starts[hit][i]].lower().split())
            rows, odds = out[first:last], automaton.odds[term[hit]]
            np.add.at(rows[:, 1], doc[exact[hit] & ~quoted], 1)
            np.add.at(rows[:, 2], doc[~exact[hit] & ~quoted], 1)
            np.add.at(rows[:, 3], doc[quoted], 1)
            np.maximum.at(rows[:, 4], doc[~quoted], odds[~quoted] / 5)
        first = last
    out[:, 1:4] = np.log1p(out[:, 1:4])
    return out


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights: Newton steps towards the posterior mode."""
    w = PRIOR.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(PRIOR_STRENGTH), x.T @ (p - y) + PRIOR_STRENGTH * (w - PRIOR))
        w -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
    return w


def _near(batches, shared):
    """The words (term) that are within distance one of a term, but none themselves."""
    automaton = shared.value
    for batch in batches:
        words = batch.column("term").to_pylist()
        size = np.array([len(w) for w in words], np.int64)
        starts = np.r_[0, np.cumsum(size + 1)][:-1]
        points = np.frombuffer(" ".join(words).encode("utf-32-le"), np.uint32)
        term, exact = automaton.match(points, starts, starts + size)
        yield batch.filter(pa.array((term > 0) & ~exact))


def learn_lexicon(rows: DataFrame) -> Automaton:
    """The automaton of all terms that rows (text, toxic) teach, with the ordinary words near them."""
    total = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("toxic").alias("n")).collect()}
    if not total.get(1) or not total.get(0):
        return Automaton([])
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"((?:[a-z0-9$@]|[\p{L}\p{M}\p{Nd}&&[^\x{0}-\x{BF}]]){3,40})"), 1))
    counts = rows.select("toxic", F.explode(words).alias("term")).groupBy("term").agg(F.sum("toxic").cast("long").alias("bad"), F.sum(1 - F.col("toxic")).cast("long").alias("fine"))
    counts = written(counts.where("bad > 0 or fine > 1"), "toxic-words")
    odds = F.log((F.col("bad") + 0.5) / (total[1] + 1.0)) - F.log((F.col("fine") + 0.5) / (total[0] + 1.0))
    strong = lambda t, extra="true": t.withColumn("odds", odds).where((F.col("odds") >= MIN_ODDS) & (F.col("bad") >= MIN_ROWS)).where(extra).orderBy(F.desc("odds"), "term").collect()
    stems: list[tuple[str, float, bool]] = []
    begun = counts.select("bad", "fine", F.explode(F.array(*[F.substring("term", 1, n) for n in STEMS])).alias("stem"), F.col("term").alias("word")).where("length(word) > length(stem)")
    begun = begun.groupBy(F.col("stem").alias("term")).agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine"), F.count_if(F.col("bad") >= 2).alias("words"))
    for r in sorted(strong(begun, f"words >= {MIN_STEM_WORDS}"), key=lambda r: (len(r["term"]), r["term"])):
        if not any(r["term"].startswith(s) for s, _, _ in stems):
            stems.append((r["term"], float(r["odds"]), True))
    terms = [(r["term"], float(r["odds"]), False) for r in strong(counts) if not any(r["term"].startswith(s) for s, _, _ in stems)]
    automaton = Automaton(stems + terms)
    shared = rows.sparkSession.sparkContext.broadcast(automaton)
    near = counts.where("fine > 1").select("term", "fine").mapInArrow(partial(_near, shared=shared), "term string, fine long")
    automaton.ordinary = frozenset(r["term"] for r in near.select("term").collect())  # words of the sample
    return automaton


def _features(batches, shared):
    for batch in batches:
        x = features(batch.column("text"), shared.value)
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), *map(pa.array, x.T)], names=["toxic", *(f"x{i}" for i in range(x.shape[1]))])


def _score(batches, shared, weights: np.ndarray):
    for batch in batches:
        x = features(batch.column("text"), shared.value)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))))], names=["doc_id", "score"])


def learn(docs: DataFrame, labels: DataFrame) -> tuple[Automaton, np.ndarray]:
    """Automaton and weights from the labelled rows of the learning folds."""
    spark = docs.sparkSession
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(fold(F.col("doc_id")) != HELD_OUT)
    total = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("toxic").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, SAMPLE[1] / max(total.get(1, 0), 1)).otherwise(SAMPLE[0] / max(total.get(0, 0), 1))
    rows = docs.select("doc_id", "text").join(F.broadcast(known.where(draw < share)), "doc_id").select("text", "toxic")  # SAMPLE ids are broadcast
    rows = written(rows, "toxic-sample")
    automaton = learn_lexicon(rows)
    shared = spark.sparkContext.broadcast(automaton)
    names = [f"x{i}" for i in range(len(PRIOR))]
    table = rows.mapInArrow(partial(_features, shared=shared), "toxic int, " + ", ".join(f"{n} double" for n in names)).toPandas()
    return automaton, fit(table[names].to_numpy(), table["toxic"].to_numpy(float))


def score(docs: DataFrame, automaton: Automaton, weights: np.ndarray) -> DataFrame:
    """(doc_id, score) of each row; null text counts as empty and scores as a text without hits."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(partial(_score, shared=docs.sparkSession.sparkContext.broadcast(automaton), weights=weights), f"doc_id {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs`` (doc_id, text).

    Learns from ``labels`` (doc_id, toxic) whose crc32(doc_id) mod 5 isn't 0; of several labels of an id the
    greatest counts. Without labels of both kinds the lexicon is empty and every text scores as
    one without hits. Scores read the text only. Repeated rows score alike; a null id is held out. Other
    columns aren't read.
    """
    ship_package(docs.sparkSession)
    scored = score(docs, *learn(docs, labels))
    return scored.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the table."""
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
