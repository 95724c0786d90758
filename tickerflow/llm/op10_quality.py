"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

A rule compares a share of two counts of a document with a cutoff. For each stratum
(language) and rule, a sequence of cutoffs from loose to strict is tested on the labelled good
documents that pass the base rules: with k of n rejected, the hypothesis "the rule rejects
more than ``risk / number of rules`` of the good documents" falls if the exact binomial
probability P(X <= k) is at most ``error / (rules * strata)`` (Bonferroni). Testing stops at the first
cutoff that doesn't pass (fixed sequence), so with probability 1 - ``error`` no stratum
loses more than ``risk`` of its good documents to the rules together. Among the passing cutoffs the loosest
one is taken that rejects at least 99 % of the labelled bad documents that the best one rejects. A rule without a
passing cutoff is off in its stratum: with few labels nothing is rejected but by the base rules.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import written

RISK, ERROR = 0.05, 0.05
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
#: Strata (rows of one string and a few numbers) up to which their cutoffs are broadcast.
BROADCAST_STRATA = 100_000

#: name, numerator, denominator, whether larger shares are rejected, cutoffs in percent from loose to strict.
RULES = (
    ("symbols", "n_symbols", "n_words", True, (200, 100, 50, 40, 30, 20, 10, 5)),
    ("marks", "n_marks", "n_words", True, (150, 100, 80, 60, 40, 20, 10)),
    ("upper", "n_upper", "word_chars", True, (70, 60, 50, 40, 30, 20, 15)),
    ("repeats", "n_repeat_words", "n_words", True, (28, 25, 20, 15, 10, 5)),
    ("dup_lines", "n_dup_lines", "n_lines", True, (70, 50, 40, 30, 20, 10)),
    ("short", "word_chars", "n_words", False, (250, 300, 350, 375, 400, 425)),
    ("long", "word_chars", "n_words", True, (1200, 1000, 900, 800, 750, 700, 650, 600)),
)
_OWN = ("n_words", "word_chars", "n_symbols", "n_marks", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def features(docs: DataFrame) -> DataFrame:
    """``docs`` (text) with the counts that the rules compare, and ``base_failed``.

    Words are runs of characters other than the six ASCII spaces; null text has none. Windows
    are compared by 64-bit hashes, within one text. No shuffle: each row is counted by itself.
    Write the result before filtering it: a filter that is pushed down would repeat the counting.
    """
    text, spaces = F.coalesce("text", F.lit("")), " \t\n\x0b\f\r"
    without = lambda chars: F.length("_t") - F.length(F.translate("_t", chars, ""))
    d = docs.drop(*_OWN).withColumn("_t", text)
    d = d.withColumns({
        "_h": F.transform(F.filter(F.split("_t", r"[\x20\x09-\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w)),
        "_lines": F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, spaces, "")) > 0),
        "word_chars": F.length(F.translate("_t", spaces, "")).cast("long"),
        "n_symbols": without("#*$%&|<>").cast("long"),
        "n_marks": without("!?").cast("long"),
        "n_upper": F.regexp_count("_t", F.lit(r"\p{Lu}")).cast("long"),
    })
    d = d.withColumns({
        "n_words": F.size("_h").cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_w": F.when(F.size("_h") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("_h") - WINDOW), lambda i: F.xxhash64(*[F.get("_h", i + j) for j in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>")),
    }).drop("_t", "_h", "_lines")
    # places of windows that occur twice or more: neighbours in the order of (hash, place)
    placed = F.array_sort(F.transform("_w", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_w")) < F.size("_w"), placed)).drop("_w")
    same = lambda x, i, j: F.coalesce(F.get("_s", i + j)["w"] == x["w"], F.lit(False))
    again = F.array_sort(F.transform(F.filter("_s", lambda x, i: F.when(i > 0, same(x, i, -1)).otherwise(False) | same(x, i, 1)), lambda x: x["i"]))
    covered = F.aggregate("_r", F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n")), lambda a, i: F.struct((i + WINDOW).alias("to"), (a["n"] + i + WINDOW - F.greatest(i, a["to"])).alias("n")), lambda a: a["n"])
    d = d.withColumn("_r", again).drop("_s").withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_r")
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _rejects(rule, cutoff) -> Column:
    _, above, below, larger, _ = rule
    share, limit = 100 * F.col(above), cutoff * F.col(below)
    return share > limit if larger else share < limit


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial (n, p), summed in logarithms; 1 where k > n * p, as no test passes there."""
    step = lambda a, j: F.struct((a["t"] + F.log(n - j + 1) - F.log(j) + math.log(p / (1 - p))).alias("t"), a["s"].alias("s"))
    plus = lambda a: F.struct(a["t"].alias("t"), (F.greatest(a["s"], a["t"]) + F.log1p(F.exp(-F.abs(a["s"] - a["t"])))).alias("s"))
    zero = n * math.log1p(-p)
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k > n * p, 1.0).otherwise(F.exp(F.aggregate(steps, F.struct(zero.alias("t"), zero.alias("s")), lambda a, j: plus(step(a, j)), lambda a: a["s"])))


def cutoffs(counted: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(lang, and one cutoff for each rule, null where the rule is off), from ``features`` and ``labels`` (doc_id, quality).

    A document with several labels is good if all are. Null labels and unlabelled documents don't count.
    """
    good = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("_good"))
    held = counted.where(~F.col("base_failed")).join(good, "doc_id")
    cells = [(r, s, c) for r in RULES for s, c in enumerate(r[4])]
    sums = [F.count_if(F.col("_good") == 1).alias("_n")]
    for r, s, c in cells:
        sums += [F.count_if((F.col("_good") == 1) & _rejects(r, c)).alias(f"k_{r[0]}_{s}"), F.count_if((F.col("_good") == 0) & _rejects(r, c)).alias(f"b_{r[0]}_{s}")]
    table = held.groupBy("lang").agg(*sums)
    rows = F.array(*[F.struct(F.lit(r[0]).alias("rule"), F.lit(s).alias("step"), F.lit(c).alias("cutoff"), F.col(f"k_{r[0]}_{s}").alias("k"), F.col(f"b_{r[0]}_{s}").alias("bad")) for r, s, c in cells])
    # one row per stratum, rule and cutoff from here on
    strata = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = table.withColumn("_strata", F.count("_n").over(strata)).select("lang", "_n", "_strata", F.inline(rows))
    passes = binomial_cdf(F.col("k"), F.col("_n"), risk / len(RULES)) <= error / (len(RULES) * F.col("_strata"))
    rule = Window.partitionBy("lang", "rule")
    table = table.withColumn("ok", F.min(passes).over(rule.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)))
    table = table.where("ok").withColumn("most", F.max("bad").over(rule)).where("bad > 0 and 100 * bad >= 99 * most")
    first = F.min_by("cutoff", "step")
    return table.groupBy("lang", "rule").agg(first.alias("cutoff")).groupBy("lang").agg(*[F.max(F.when(F.col("rule") == r[0], F.col("cutoff"))).alias(f"cut_{r[0]}") for r in RULES])


def judge(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """``counted`` with ``kept``: false if the base rules or a rule of the stratum reject the document."""
    if limits.count() <= BROADCAST_STRATA:
        limits = F.broadcast(limits)
    out = counted.join(limits.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    rejected = reduce(lambda a, b: a | b, [F.coalesce(_rejects(r, F.col(f"cut_{r[0]}")), F.lit(False)) for r in RULES])
    return out.withColumn("kept", ~(F.col("base_failed") | rejected)).drop("_lang", *[f"cut_{r[0]}" for r in RULES])


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang) that the rules keep, with the same columns.

    Null text and texts of under 20 words fail the base rules. Null lang is a stratum of its own. Repeated
    rows are judged alike. Without labels only the base rules reject; an empty table gives none.
    """
    names = [f"_in{i}" if c in _OWN else c for i, c in enumerate(docs.columns)]
    docs_in = docs.toDF(*names)
    limits = cutoffs(written(features(docs_in.select("doc_id", "lang", "text")).drop("text"), "quality"), labels).checkpoint()
    # The texts aren't written: they are counted again here. The random column holds the filter above the counting.
    judged = judge(features(docs_in).withColumn("_held", F.rand()), limits)
    return judged.where(F.col("kept") & (F.col("_held") >= 0)).select(*names).toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the table with its counts and the verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    counted = written(features(docs).drop("text"), "quality")
    limits = cutoffs(counted, spark.read.parquet(f"{sf_dir}/labels.parquet")).checkpoint()
    return judge(counted, limits).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    cells = ", ".join(f"('{n}', {s}, {c}, {100 * larger})" for n, _, _, larger, cuts in RULES for s, c in enumerate(cuts))
    share = lambda i: "CASE rule " + " ".join(f"WHEN '{r[0]}' THEN {r[i]}" for r in RULES) + " END"
    return rf"""
WITH t AS (
  SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT row, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t
), win AS (
  SELECT row, i, list_slice(w, CAST(i AS BIGINT) + 1, CAST(i AS BIGINT) + {WINDOW}) AS g FROM (SELECT row, w, unnest(range(len(w) - {WINDOW - 1})) AS i FROM t WHERE len(w) >= {WINDOW})
), twice AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT row, count(DISTINCT i + j) AS n FROM twice, range({WINDOW}) r(j) GROUP BY row
), f AS (
  SELECT t.row, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS BIGINT) AS n_marks,
    CAST(length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS BIGINT) AS n_upper,
    len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM t JOIN lines USING (row) LEFT JOIN rep USING (row)
), b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f
), good AS (
  SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), cells(rule, step, cutoff, larger) AS (VALUES {cells}
), x AS (
  SELECT lang, rule, step, cutoff, count(*) FILTER (good = 1) AS n, count(*) FILTER (good = 1 AND hit) AS k, count(*) FILTER (good = 0 AND hit) AS bad
  FROM (SELECT *, CASE WHEN larger > 0 THEN 100 * {share(1)} > cutoff * {share(2)} ELSE 100 * {share(1)} < cutoff * {share(2)} END AS hit FROM b JOIN good USING (doc_id), cells WHERE NOT base_failed)
  GROUP BY ALL
), p AS (
  SELECT *, CASE WHEN k > n * {RISK / len(RULES)!r} THEN 1.0 ELSE (SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK / len(RULES)!r}) + (n - j) * ln(1 - {RISK / len(RULES)!r}))) FROM (SELECT unnest(range(k + 1)) AS j)) END AS p FROM x
), o AS (
  SELECT *, min(p <= {ERROR / len(RULES)!r} / (SELECT count(DISTINCT coalesce(lang, chr(0))) FROM x)) OVER (PARTITION BY lang, rule ORDER BY step) AS ok FROM p
), c AS (
  SELECT lang, rule, larger, min_by(cutoff, step) AS cutoff FROM (SELECT *, max(bad) OVER (PARTITION BY lang, rule) AS most FROM o JOIN (SELECT DISTINCT rule, larger FROM cells) USING (rule) WHERE ok) WHERE bad > 0 AND 100 * bad >= 99 * most GROUP BY ALL
), hit AS (
  SELECT DISTINCT row FROM b JOIN c ON b.lang IS NOT DISTINCT FROM c.lang WHERE CASE WHEN larger > 0 THEN 100 * {share(1)} > cutoff * {share(2)} ELSE 100 * {share(1)} < cutoff * {share(2)} END
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND hit.row IS NULL AS kept FROM b LEFT JOIN hit USING (row)
"""


SQL = _sql()
