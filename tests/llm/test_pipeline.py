"""The corpus pipeline against a brute-force version on a small table, and the entry's registration."""

import collections
import hashlib
import math
import random
import re

import pytest
from test_llm_operators import _classes, _least_capacity, _passage, split

import __spark_entry__ as entry
import corpus_pipeline
from tickerflow.llm import catalog, op10_quality


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    rows = []
    for k in range(90):
        words = _passage(500 + k, rng.randrange(10, 90))
        if k % 9 == 0:
            words[5:5] = _passage(77, 12)  # a benchmark passage
        if k % 10 == 0:
            words = words[:6] * 12  # repeated words
        rows.append((k, " ".join(words), ["en", "de"][k % 2], ["a", "b", "c"][k % 3], len(words)))
    near = _passage(9, 80)
    for k in range(90, 110):
        words = list(near)
        words[k % 80] = f"x{k}"
        rows.append((k, " ".join(words), "en", "a", 80))
    rows += [(k, rows[4][1], "en", None, 1) for k in range(110, 116)] + [(116, None, "en", "a", 0), (117, "", None, "b", 0), rows[4]]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(0, 90, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(_passage(77, 12))), (2, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_pipeline_by_brute_force(spark, folder):
    path, rows = folder
    got = corpus_pipeline.run(spark, path).collect()

    def good(text):
        w = split(text)
        c = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        again = {k + j for k in range(len(w) - 7) if c[tuple(w[k : k + 8])] > 1 for j in range(8)}
        return len(w) >= 20 and 100 * len(again) <= 30 * len(w)

    left = [r for r in rows if good(r[1])]  # too few labels for any cutoff
    assert 0 < len(left) < len(rows)
    smallest = {c for _, _, c in _classes(left)}
    left = list({r[0]: r for r in left if r[0] in smallest}.values())
    item = _passage(77, 12)
    windows = {tuple(item[k : k + 10]) for k in range(3)}
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    left = [r for r in left if not any(tuple(w[k : k + 10]) in windows for w in [words(r[1])] for k in range(len(w) - 9))]
    size = collections.Counter()
    for r in left:
        size[r[3]] += len(split(r[1]))
    weight = dict(zip(sorted(size, key=lambda s: (s is None, s or "")), (5, 2, 1, 5)))
    capped = set()
    while True:
        level = (sum(size.values()) - sum(3 * size[s] for s in capped)) / sum(w for s, w in weight.items() if s not in capped)
        above = {s for s in size if s not in capped and level * weight[s] > 3 * size[s]}
        if not above:
            break
        capped |= above
    expected = collections.Counter()
    for r in left:
        rate = 3.0 if r[3] in capped else level * weight[r[3]] / size[r[3]]
        draw = int(hashlib.md5(f"17:{r[0]}".encode()).hexdigest()[:13], 16) / 16**13
        expected[r[:4]] += math.floor(rate) + (draw < rate - math.floor(rate))
    assert collections.Counter((r.doc_id, r.text, r.lang, r.source) for r in got) == +expected
    shards, of = collections.defaultdict(list), collections.defaultdict(set)
    groups = collections.Counter()
    for r in got:
        shards[r.shard].append(r)
        of[r.text].add(r.shard)
        groups[hashlib.sha256(r.text.encode()).hexdigest()] += len(r.text.encode()) + 8
    assert all(len(x) == 1 for x in of.values())
    assert all(sorted(r.slot for r in x) == list(range(len(x))) and 0 <= s < 24 for s, x in shards.items())
    assert max(sum(r.size for r in x) for x in shards.values()) == _least_capacity([groups[k] for k in sorted(groups)], 24)


def test_near_copies_between_the_limits(spark):
    """Two of 100 words replaced: 86 of 106 five-word shingles shared (a near copy), 89 of 105 four-word ones (0.848)."""
    words = [f"w{k}" for k in range(100)]
    two, three = list(words), list(words)
    for k in (30, 70):
        two[k] = f"x{k}"
    for k in (20, 50, 80):  # 81 of 111: none
        three[k] = f"y{k}"
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate((words, two, three))], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [0, 2]


def test_stages_keep_the_columns(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix", "shard"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns
        assert stage(spark, docs.limit(0), path).count() == 0
    assert set(docs.columns) < set(corpus_pipeline.STAGES[-1][1](spark, docs, path).columns)


def test_entry_registers_all():
    names = set(entry.queries())
    assert {f"op{k}_" for k in range(1, 11)} <= {re.match(r"op\d+_|", n)[0] for n in names} and "pipeline" in names
    assert set(catalog.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_sql_twins_with_cutoffs(spark, name, tmp_path, monkeypatch):
    """At a risk that few labels can pass, the cutoffs of both must agree too."""
    import duckdb

    from tickerflow.llm import op07_mixing

    sf = "/root/testdata/sf0.01"
    monkeypatch.setattr(op10_quality, "RISK", 0.9)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    if name == "op10_quality":
        docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
        counted = op10_quality.written(op10_quality.features(docs).drop("text"), "t")
        limits = op10_quality.cutoffs(counted, labels, risk=0.9)
        assert limits.count() > 0
        df = op10_quality.judge(counted, limits.checkpoint()).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
        sql = op10_quality._sql()
    else:
        df, sql = op07_mixing.query(spark, sf), op07_mixing.SQL
    order = sorted(df.columns)
    norm = lambda rows: sorted(tuple(round(x, 4) if isinstance(x, float) else x for x in r) for r in rows)
    assert norm(map(tuple, df.select(order).collect())) == norm(con.sql(f"SELECT {', '.join(order)} FROM ({sql})").fetchall())
