"""Entity linking: spans from NER tags, validity, the five-step cascade, the
dictionary scan and per-article ticker sets (pipeline stage 7).

W12, P18-P20, J2-J7, F18, A13. The cascade runs once per **distinct**
(entity, target) pair, not per mention, and is joined back afterwards.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import WS_RUN_RE, ustrip
from .common import bounded_broadcast, stored
from .similarity import lcs_lengths, similar, token_sorted

# NER tags accepted into a span.
ACCEPTED_TAGS = ["B-ORG", "I-ORG", "B-LOC", "I-LOC", "B-PER", "I-PER"]

# Entity filters of the linking step.
BLACKLIST = [
    "việt nam", "hà nội", "hồ chí minh", "tp.hcm", "sài gòn",
    "hoàn", "phí", "link", "ngóng", "ott", "casa", "việc",
    "big", "top", "vn-index", "vnindex", "hnx", "upcom",
]
NOISE_WORDS = ["ngày", "tháng", "năm", "quý", "mức", "tỷ lệ", "cuối", "đầu", "nửa", "cột mốc"]

# Lower-case alias → ticker; None marks an unlisted company (it still ends the cascade).
ALIASES = [
    ("bidv", "BID"), ("vietinbank", "CTG"), ("vietcombank", "VCB"), ("vcb", "VCB"), ("agribank", None),
    ("techcombank", "TCB"), ("mbbank", "MBB"), ("mb", "MBB"), ("vpbank", "VPB"), ("acb", "ACB"),
    ("á châu", "ACB"), ("sacombank", "STB"), ("sài gòn thương tín", "STB"), ("stb", "STB"), ("vib", "VIB"),
    ("quốc tế", "VIB"), ("tpbank", "TPB"), ("tiên phong", "TPB"), ("hdbank", "HDB"),
    ("phát triển tp.hcm", "HDB"), ("msb", "MSB"), ("hàng hải", "MSB"), ("lpb", "LPB"),
    ("bưu điện liên việt", "LPB"), ("liên việt", "LPB"), ("seabank", "SSB"), ("đông nam á", "SSB"),
    ("ssb", "SSB"), ("shb", "SHB"), ("sài gòn - hà nội", "SHB"), ("eximbank", "EIB"),
    ("xuất nhập khẩu", "EIB"), ("eib", "EIB"), ("ocb", "OCB"), ("phương đông", "OCB"),
    ("vietcapitalbank", "BVB"), ("bản việt", "BVB"), ("bvb", "BVB"), ("vietbank", "VBB"),
    ("việt nam thương tín", "VBB"), ("vbb", "VBB"), ("abbank", "ABB"), ("an bình", "ABB"), ("ncb", "NVB"),
    ("quốc dân", "NVB"), ("navibank", "NVB"), ("pvcombank", "PVB"), ("đại chúng", "PVB"), ("pgbank", "PGB"),
    ("xăng dầu petrolimex", "PGB"), ("kienlongbank", "KLB"), ("kiên long", "KLB"), ("klb", "KLB"),
    ("baovietbank", "BVB"), ("bảo việt", "BVB"), ("vietabank", "VAB"), ("việt á", "VAB"), ("oceanbank", None),
    ("gpbank", "GPB"), ("dầu khí toàn cầu", "GPB"), ("ssi", "SSI"), ("chứng khoán sài gòn", "SSI"),
    ("vci", "VCI"), ("vietcap", "VCI"), ("vcbs", None), ("bsc", "BVS"), ("bidv securities", "BVS"),
    ("hsc", "HCM"), ("thành phố hồ chí minh", "HCM"), ("vps", "VPS"), ("vndirect", "VND"), ("vds", "VDS"),
    ("fpts", "FTS"), ("fpt securities", "FTS"), ("bsi", "BSI"), ("agriseco", "AGR"),
]

FUZZY_THRESHOLD = 90
SUBSTRING_MIN_ENTITY = 10
SUBSTRING_MIN_NAME = 15
SHORT_KEY = 3


def alias_frame(spark, pairs=None) -> DataFrame:
    """The alias dictionary as a table (alias, ticker NULL for unlisted)."""
    rows = pairs if pairs is not None else ALIASES
    return spark.createDataFrame(rows, "alias string, ticker string")


# ---------------------------------------------------------------- W12 / P20

def spans(tokens: DataFrame, doc: str = "article_id", accepted: list[str] | None = None) -> DataFrame:
    """Merge consecutive accepted tags into entity text (W12, gaps and islands).

    ``tokens``: (doc, pos, word, ner_tag). A ``B-`` tag does not open a new span
    after an accepted tag; any other tag closes it. Output (doc, start, entity).
    """
    acc = accepted or ACCEPTED_TAGS
    t = tokens.filter(F.col("ner_tag").isin(acc))
    w = Window.partitionBy(doc).orderBy("pos")
    t = t.withColumn("_g", F.col("pos") - F.row_number().over(w))
    g = t.groupBy(doc, "_g").agg(
        F.min("pos").alias("start"),
        F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("_w"),
    )
    return g.select(doc, "start", F.array_join(F.transform("_w", lambda x: x["word"]), " ").alias("entity"))


def spans_any_tag(tokens: DataFrame, doc: str = "article_id") -> DataFrame:
    """Variant that accepts every tag other than ``O``."""
    t = tokens.withColumn("ner_tag", F.when(F.col("ner_tag") != "O", F.lit("B-ORG")).otherwise(F.lit("O")))
    return spans(t, doc, ["B-ORG"])


def valid_entity(e: Column) -> Column:
    """``is_valid_entity`` (P20): length >= 3; no noise word as a substring of the
    lower-case text; not all (Unicode decimal) digits once space / - . , are removed; not blacklisted."""
    low = F.lower(e)
    noise = F.lit(False)
    for w in NOISE_WORDS:
        noise = noise | F.contains(low, F.lit(w))
    digits = F.translate(e, " /-.,", "").rlike("^\\p{Nd}+$")
    return (F.length(e) >= 3) & ~noise & ~digits & ~ustrip(low).isin(BLACKLIST)


# ---------------------------------------------------------------- F18 token-sort ratio

def token_sort(s: str) -> str:
    return " ".join(sorted(s.split()))


def token_sort_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """100 * (1 - indel / (len1 + len2)) on token-sorted strings = 200 * LCS / (len1 + len2)."""
    x, y = [token_sort(s) for s in a], [token_sort(s) for s in b]
    total = np.array([len(s) + len(t) for s, t in zip(x, y)], np.int64)
    return np.where(total == 0, 100.0, 200.0 * lcs_lengths(x, y) / np.maximum(total, 1))


def token_sort_ratio_py(a: str, b: str) -> float:
    return float(token_sort_ratios([a], [b])[0])


@F.pandas_udf(T.DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """F18 over given pairs (Arrow batches)."""
    return pd.Series(token_sort_ratios(list(a.fillna("")), list(b.fillna(""))))


# ---------------------------------------------------------------- cascade J2-J6

STEPS = ("alias", "exact", "substring", "fuzzy", "direct")
GRAM = 10  # characters that two names must share at least for one to hold the other


def _grams(c: Column) -> Column:
    """The distinct runs of ``GRAM`` characters of a text."""
    return F.when(F.length(c) >= GRAM, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(c) - (GRAM - 1)), lambda i: F.substr(c, i, F.lit(GRAM)))))


def contained_names(rest: DataFrame, names: DataFrame) -> DataFrame:
    """Containment between long names (J4): (entity, target, ticker) with the first
    non-target name in map order that holds the entity or that the entity holds.

    A text that holds another holds its first ``GRAM`` characters, so both directions are
    equi-joins on one gram (all grams of the longer side against the first of the
    shorter), verified with ``contains``; no pair without a shared gram is formed.
    """
    e = rest.filter((F.length("entity") >= SUBSTRING_MIN_ENTITY) & (F.length("_el") >= GRAM)).select("entity", "target", "_el")
    n = names.filter(F.length("name") >= SUBSTRING_MIN_NAME).select(
        F.lower("name").alias("_nl"), F.col("ticker").alias("_nt"), F.col("ord").alias("_no"))
    first, every = lambda c: F.substring(c, 1, GRAM).alias("_g"), lambda c: F.explode(_grams(F.col(c))).alias("_g")
    holds = e.select("*", every("_el")).join(n.select("*", first("_nl")), "_g").filter(F.contains("_el", "_nl"))
    held = e.select("*", first("_el")).join(n.select("*", every("_nl")), "_g").filter(F.contains("_nl", "_el"))
    both = holds.unionByName(held).filter(F.col("_nt") != F.col("target"))
    return both.groupBy("entity", "target").agg(F.min_by("_nt", "_no").alias("ticker"))


def fuzzy_best(entities: DataFrame, names: DataFrame, threshold: int = FUZZY_THRESHOLD) -> DataFrame:
    """Best name per entity by token-sort ratio (J5), over **all** names, ties to
    the first name in map order; only a best score >= threshold is returned.

    A similarity join of the distinct token-sorted entities and names (see ``similarity``). It finds every pair
    at or above the threshold; a best below it would be rejected anyway. Names with the same words
    are one text, for which the first in map order stands.
    """
    ents = entities.select("entity").distinct().withColumn("x", token_sorted(F.col("entity")))
    own = names.groupBy(token_sorted(F.col("name")).alias("y")).agg(F.min_by(F.struct("name", "ticker", "ord"), "ord").alias("n"))
    found = similar(ents, own.select(F.col("y").alias("x")), threshold).join(own, "y")
    best = found.groupBy("x").agg(F.max_by(F.struct("n", "score"), F.struct("score", -F.col("n.ord"))).alias("b"))
    return ents.join(best, "x").select("entity", F.col("b.n.name").alias("fuzzy_name"), F.col("b.n.ticker").alias("fuzzy_ticker"),
                                       F.col("b.score").alias("fuzzy_score"))


def resolve(pairs: DataFrame, names: DataFrame, aliases: DataFrame, threshold: int = FUZZY_THRESHOLD,
            steps: tuple[str, ...] = STEPS) -> DataFrame:
    """``map_to_tickers`` for distinct (entity, target) pairs → (entity, target, step, ticker).

    Order: alias (ends), exact (ends), substring (ends), then fuzzy **and** direct
    ticker both apply. The target itself and unlisted aliases are dropped (P18, P19).
    Each step takes the pairs that the steps before left over (written, so that neither they
    nor the mentions are computed again) and only the wanted ``steps``, and those before
    them, run. Aliases, names and tickers are bounded by the listing and broadcast behind a size check.
    """
    rest = pairs.select("entity", "target").distinct().withColumn("_el", F.lower(ustrip(F.col("entity"))))
    last = max(STEPS.index(x) for x in steps)
    found = []

    def step(name: str, key: str, table: DataFrame, rest: DataFrame) -> DataFrame:
        """``table``: (key, ticker), one row per key; a hit ends the cascade whatever its ticker is."""
        t = table.select(F.col(key).alias("_k"), F.col("ticker"), F.lit(True).alias("_hit"))
        out = rest.join(bounded_broadcast(t), F.col("_el") == F.col("_k"), "left").drop("_k")
        out = stored(out, f"linked-{name}")
        found.append(out.filter("_hit").select("entity", "target", F.lit(name).alias("step"), "ticker"))
        return out.filter(F.col("_hit").isNull()).drop("ticker", "_hit")

    rest = step("alias", "alias", aliases.select("alias", "ticker"), rest)
    if last >= STEPS.index("exact"):
        exact = names.groupBy(F.lower("name").alias("_el")).agg(F.min_by("ticker", "ord").alias("ticker"))
        rest = step("exact", "_el", exact, rest)
    if last >= STEPS.index("substring"):
        sub = stored(contained_names(rest, names), "linked-substring")
        found.append(sub.select("entity", "target", F.lit("substring").alias("step"), "ticker"))
        rest = rest.join(sub, ["entity", "target"], "left_anti")
    if "fuzzy" in steps:
        best = fuzzy_best(rest, names, threshold).select("entity", F.col("fuzzy_ticker").alias("ticker"))
        found.append(rest.join(best, "entity").select("entity", "target", F.lit("fuzzy").alias("step"), "ticker"))
    if "direct" in steps:
        tickers = names.select("ticker").distinct()
        found.append(rest.join(bounded_broadcast(tickers), F.upper("entity") == F.col("ticker")).select(
            "entity", "target", F.lit("direct").alias("step"), "ticker"))
    out = reduce(DataFrame.unionByName, found)
    return out.filter(F.col("step").isin(*steps) & F.col("ticker").isNotNull() & (F.col("ticker") != F.col("target")))


def related_per_article(mentions: DataFrame, resolved: DataFrame, doc: str = "article_id") -> DataFrame:
    """Join resolved pairs back to mentions; set of tickers per article.

    The mentions side grows with the texts: it is pinned to a shuffle (merge)
    join so a low size estimate can never make it the broadcast side."""
    j = mentions.select(doc, "entity", "target").hint("merge").join(
        resolved.select("entity", "target", "ticker"), ["entity", "target"])
    return j.groupBy(doc, "target").agg(F.array_sort(F.collect_set("ticker")).alias("related"))


# ---------------------------------------------------------------- J7 dictionary scan

SCAN_ROWS = 256  # texts of a batch that are Python strings at a time

def scan_partition(keys: list[tuple[str, str]], short: int = SHORT_KEY):
    """Build the per-task matcher for the dictionary scan.

    Keys of ``short`` characters or more match as plain substrings: one
    Aho-Corasick pass per text. Shorter keys need a regex word boundary on both
    sides (Python ``\\b``): a key made only of word characters matches exactly when
    it equals one of the text's maximal word runs, so those are a set lookup over
    ``\\w+`` runs; any other short key is searched with the boundary regex itself.
    """
    import re

    import ahocorasick

    always = {t for k, t in keys if k == ""}  # '' is contained in every text
    long_keys = [(k, t) for k, t in keys if len(k) >= short]
    word_keys: dict[str, set[str]] = {}
    other_keys = []
    for k, t in keys:
        if 0 < len(k) < short:
            if re.fullmatch(r"\w+", k):
                word_keys.setdefault(k, set()).add(t)
            else:
                other_keys.append((re.compile(r"\b" + re.escape(k) + r"\b"), t))
    auto = None
    if long_keys:
        auto = ahocorasick.Automaton()
        for k, t in long_keys:
            auto.add_word(k, t)
        auto.make_automaton()
    word_re = re.compile(r"\w+")

    def run(text: str) -> set[str]:
        found = set(always)
        if auto is not None:
            for _, t in auto.iter(text):
                found.add(t)
        if word_keys:
            for w in set(word_re.findall(text)):
                hit = word_keys.get(w)
                if hit:
                    found |= hit
        for rx, t in other_keys:
            if t not in found and rx.search(text):
                found.add(t)
        return found

    return run


def scan_batches(batches, run):
    """(doc, target, related) of Arrow batches (doc, target, text), in pieces of ``SCAN_ROWS`` rows: what is held as Python strings
    doesn't grow with Spark's batches. Lower-casing is Python's str.lower (the reference's rule)."""
    for part in (b.slice(at, SCAN_ROWS) for b in batches for at in range(0, len(b), SCAN_ROWS)):
        targets, texts = part.column("target"), part.column("text")
        related = [sorted(tk for tk in run((x.as_py() or "").lower()) if tk is not None and tk != t) for t, x in zip(targets.to_pylist(), texts)]
        yield pa.RecordBatch.from_arrays([part.column("doc"), targets, pa.array(related, pa.list_(pa.string()))], names=["doc", "target", "related"])


def dictionary_scan(articles: DataFrame, keys: DataFrame, doc: str = "arrival", target: str = "ticker",
                    max_keys: int = 200_000) -> DataFrame:
    """``scan_tickers_from_text`` (J7): every key contained in lower(title + '. ' + content).

    The key table is a few thousand names, the texts are the big side. Up to ``max_keys`` (counted) the
    keys are broadcast and each task builds one Aho-Corasick automaton and makes a single pass per
    text: one narrow map stage, one output row per article. A larger key table isn't gathered
    anywhere: texts and keys meet by grams (``scan_by_grams``).
    Output (doc, target, related ARRAY sorted, without the target) — A13.
    """
    from ..functions.text import article_text
    from ..session import ship_package

    text = articles.select(F.col(doc).cast("long").alias("doc"), F.col(target).alias("target"),
                           article_text(F.col("title"), F.col("content")).alias("text"))
    if keys.count() > max_keys:
        return scan_by_grams(text, keys).select(F.col("doc").alias(doc), F.col("target").alias(target), "related")
    spark = articles.sparkSession
    ship_package(spark)
    rows = spark.sparkContext.broadcast([(r["key"], r["ticker"]) for r in keys.select("key", "ticker").collect()])  # max_keys at most

    found = text.mapInArrow(lambda batches: scan_batches(batches, scan_partition(rows.value)), "doc long, target string, related array<string>")
    return found.select(F.col("doc").alias(doc), F.col("target").alias(target), "related")


def scan_by_grams(text: DataFrame, keys: DataFrame, short: int = SHORT_KEY) -> DataFrame:
    """The dictionary scan (doc, target, text) as joins, for key tables of any size: (doc, target, related).

    A text that holds a key holds each of the key's runs of ``short`` characters, so a key is anchored at the one that
    the fewest texts hold, and joined with the distinct runs of the texts; the pairs are verified by
    ``contains``. Shorter keys of word characters equal a maximal run of word characters; other short keys meet the
    texts by their first character and are verified by word boundaries. A frequent run makes a frequent join key, which
    adaptive execution splits; texts join again by a hash only once pairs are few. Lower-casing is Spark's.
    """
    rows = text.withColumn("_low", F.lower(F.coalesce("text", F.lit("")))).withColumn("_h", F.xxhash64("doc", "target", "_low"))
    low, key = F.col("_low"), F.col("key")
    once = rows.select("_h", "_low").dropDuplicates(["_h"])
    runs = lambda c, n: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substr(c, i, F.lit(n))))
    own = once.where(F.length("_low") >= short).select("_h", F.explode(runs(low, short)).alias("run"))
    long_keys = keys.where(F.length("key") >= short).select("key", F.explode(runs(key, short)).alias("run"))
    held = own.join(long_keys.select("run").distinct(), "run", "left_semi").groupBy("run").agg(F.count("_h").alias("n"))
    anchors = long_keys.join(held, "run").groupBy("key").agg(F.min_by("run", F.struct("n", "run")).alias("run"), F.count("run").alias("_found"))
    whole = keys.where(F.length("key") >= short).groupBy("key").agg(F.first(F.size(runs(key, short))).alias("_all"))
    anchors = anchors.join(whole, "key").where("_found = _all").select("key", "run")  # a run that no text holds: the key isn't held either
    pairs = own.join(anchors, "run").select("_h", "key").join(once, "_h").where(F.contains(low, key)).select("_h", "key")
    words = once.select("_h", F.explode(F.array_distinct(F.regexp_extract_all("_low", F.lit("([\\p{L}\\p{N}_]+)"), 1))).alias("key"))
    brief = keys.where((F.length("key") < short) & (F.length("key") > 0))
    pairs = pairs.union(words.join(brief.select("key").distinct(), "key", "left_semi").select("_h", "key"))
    odd = brief.where(~key.rlike("^[\\p{L}\\p{N}_]+$")).select("key", F.substring("key", 1, 1).alias("run")).distinct()
    chars = once.where(F.length("_low") > 0).select("_h", F.explode(runs(low, 1)).alias("run"))
    quoted = F.concat(F.lit("(?U)\\b\\Q"), key, F.lit("\\E\\b"))
    pairs = pairs.union(chars.join(odd, "run").select("_h", "key").join(once, "_h").where(F.rlike(low, quoted)).select("_h", "key"))
    found = pairs.join(keys.select("key", "ticker"), "key").where("ticker is not null").groupBy("_h").agg(F.collect_set("ticker").alias("related"))
    every = keys.where("key = '' and ticker is not null").agg(F.collect_set("ticker").alias("every"))  # one row: '' is in every text
    out = rows.join(found, "_h", "left").crossJoin(F.broadcast(every))
    related = F.array_union(F.coalesce("related", F.array().cast("array<string>")), F.coalesce("every", F.array().cast("array<string>")))
    return out.select("doc", "target", F.array_sort(F.filter(related, lambda t: ~F.col("target").eqNullSafe(t))).alias("related"))
