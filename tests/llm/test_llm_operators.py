"""The training-data operators against brute force, on whole small tables and on odd rows."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pytest

from tickerflow.llm import op01_lm_score as op1
from tickerflow.llm import op02_substrings as op2
from tickerflow.llm import op03_jaccard as op3
from tickerflow.llm import op04_toxicity as op4
from tickerflow.llm import op05_shards as op5
from tickerflow.llm import op06_decontaminate as op6
from tickerflow.llm import op07_mixing as op7
from tickerflow.llm import op08_main_text as op8
from tickerflow.llm import op09_token_counts as op9
from tickerflow.llm import op10_quality as op10
from tickerflow.llm.components import components
from tickerflow.session import ensure_checkpoint_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, hits string, label int, id string"
SF = "/root/testdata/sf0.001"


def _passage(seed, n):
    rng = random.Random(seed)
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def _rows():
    """Copies, near copies, shared passages, long words and texts, ties, nulls, repeated rows."""
    rng = random.Random(3)
    texts = []
    shared = _passage(1, 40)
    for k in range(60):
        words = _passage(100 + k, rng.randrange(5, 120))
        if k % 3 == 0:
            words[2:2] = shared[: rng.randrange(10, 40)]
        texts.append(" ".join(words))
    base = _passage(7, 90)
    for k in range(25):
        words = list(base)
        for _ in range(k % 4):
            words[rng.randrange(90)] = f"e{rng.randrange(9999)}"
        texts.append("\n".join([" ".join(words[:45]), " ".join(words[45:])]))
    texts += [texts[0]] * 6 + ["The  Cat\tsat", "the cat sat", "one", "ONE", "one two", "", None, "   \n\t", "é ü 日本 \x0b ß", "x" * 3000, " ".join(["again and again we say the same thing"] * 40), " ".join(_passage(9, 6000))]
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, "B"][i % 4], 0, 5, "h", 1, "x") for i, t in enumerate(texts)]
    return rows + [rows[0], rows[3], (None, texts[5], "en", "a", 0, 0, "h", 0, "x"), (None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def split(text):
    return (text or "").encode().split()


def same(got, expected):
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, expected))


# 1


def test_terms_of_every_script_and_quotation_marks(spark):
    """Cyrillic and Vietnamese terms, capitals of any script, misspellings; curly marks and dashes aren't letters."""
    import pyarrow as pa

    automaton = op4.Automaton([("идиот", 5.0, False), ("đồngốc", 5.0, False), ("idiot", 5.0, False), ("白痴だよね", 5.0, False)])
    hits = lambda t: [round(math.expm1(x)) for x in op4.features(pa.array([t]), automaton)[0][1:4]]
    assert hits("ИДИОТ") == hits("Ты идиот.") == hits("Đồngốc!") == hits("idiot—fool") == hits("idiot…") == hits("白痴だよね") == [1, 0, 0]
    assert hits("идот") == hits("đồngốcc") == hits("idi0t") == [0, 1, 0]
    assert hits("“idiot”") == hits("‘idiot’") == hits("«идиот»") == [0, 0, 1]
    assert hits("nothing here × ÷ ªº") == [0, 0, 0]
    rows = [(f"плохой đồngốc слово{k % 7}", 1) for k in range(30)] + [(f"хороший день слово{k % 7}", 0) for k in range(60)]
    lexicon = op4.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    points = np.frombuffer("плохой хороший đồngốc".encode("utf-32-le"), np.uint32)
    assert [t > 0 for t in lexicon.match(points, np.array([0, 7, 15]), np.array([6, 14, 21]))[0]] == [True, False, True]


def test_broken_pages_are_read_in_linear_time():
    """A page cut anywhere, quotes that never close, very long tags: the rest of an unfinished tag goes."""
    import time

    assert op8.split_page('a<div class="x') == (None, "a") and op8.split_page('<article>a<b title="1 > 0">b</b> <i x=">c</article>') == ("ab c", "")
    for cut in range(len(PAGE)):
        op8.split_page(PAGE[:cut])
    began = time.time()
    for bad in ("<div " + " ".join(f'a{i}="x"' for i in range(2000)), "<div data-props='{" + '"k":"v",' * 4000, "<a '>" * 5000, "<" * 20000, '<a "' * 9999, "<!" * 9999, "<article>" + "x y " * 200000):
        op8.split_page(bad)
    assert time.time() - began < 20


def test_lm_score_counts(docs, rows, monkeypatch):
    monkeypatch.setattr(op1, "KNOWN", 500)
    got = op1.score(docs).collect()
    words = [split((t or "").translate({c: c + 32 for c in range(65, 91)})) + [None] for _, t, *_ in rows]
    fold = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 for r in rows]
    c = collections.Counter(w for ws, f in zip(words, fold) if f != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    expected = [(r[0], f == 2, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 5)) for r, ws, f in zip(rows, words, fold)]
    same([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got], expected)
    assert all(r.score < 0 for r in got)


def test_lm_beats_the_base_on_held_out_documents(spark):
    got = op1.query(spark, "/root/testdata/sf0.01").where("held_out").groupBy().sum("score", "base_score").first()
    assert got[0] > got[1]


def test_lm_empty_and_unlearned(none, spark):
    assert op1.score(none).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    got = op1.score(spark.createDataFrame([(held, "a b"), (held, None)], "doc_id long, text string")).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]


def test_lm_learns_every_token_of_every_training_document():
    from tickerflow.llm import gru

    assert [k for low, high in op1.ROUNDS for k in range(low, high)] == list(range(24))  # each document in one round
    rng = np.random.default_rng(0)
    w = small_model()
    for n in (0, 1, 15, 16, 17, 1000, gru.LANES * 64 + 1, gru.LANES * 79 + 127):
        trainer = gru.Trainer(w, 0.01)
        trainer.learn(rng.integers(0, len(w["embedding"]) + len(w["leaf_embedding"]), n))
        assert trainer.tokens == n and math.isfinite(trainer.loss)
        assert trainer.w["leaf_touches"].sum() <= n and all(np.isfinite(x).all() for x in trainer.w.values())


def small_model():
    """Two classes with a place, one with leaves, three without."""
    from tickerflow.llm import gru

    rng = np.random.default_rng(1)
    return gru.new_weights(rng.random(6), rng.random((3, gru.PLACES)), rng.random((gru.PLACES, gru.LEAVES)))


def test_lm_is_a_distribution_over_all_its_words():
    from tickerflow.llm import gru

    w = small_model()
    n = len(w["embedding"]) + len(w["leaf_embedding"])
    assert n == 2 * gru.PLACES + 3 + gru.PLACES * gru.LEAVES
    h = np.tile(np.random.default_rng(2).standard_normal(gru.HIDDEN).astype(np.float32), (n, 1))
    assert np.exp(gru.log_probs(h, np.arange(n), w).astype(float)).sum() == pytest.approx(1, rel=1e-4)


def test_lm_averages_touched_rows_by_their_touches():
    from tickerflow.llm import gru

    a, b = small_model(), small_model()
    for w, n, x in ((a, 3, 1.0), (b, 1, 5.0)):
        w["leaves"][7], w["leaf_touches"][7], w["bias"][:] = x, n, x
    tokens, w = gru.mean([(10.0, a), (30.0, b)])
    assert tokens == 40 and (w["leaves"][7] == 2).all() and w["leaf_touches"][7] == 4 and (w["bias"] == 4).all()
    assert (w["leaves"][8] == a["leaves"][8]).all()  # no learner touched them


def test_lm_scores_do_not_depend_on_the_split(spark, monkeypatch):
    monkeypatch.setattr(op1, "LEARNER_TOKENS", 60_000)  # several learners, two levels of averages
    monkeypatch.setattr(op1, "FAN_IN", 2)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    two, seven = ({r.doc_id: r.score for r in op1.score(docs.repartition(n, "text")).collect()} for n in (2, 7))
    assert two.keys() == seven.keys() and len(two) == docs.count()
    assert all(two[d] == pytest.approx(seven[d], rel=1e-4) for d in two)


def test_gradients_and_carried_state():
    from tickerflow.llm import gru

    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in small_model().items()}
    n_inputs, n = len(w["embedding"]), len(w["embedding"]) + len(w["leaf_embedding"])
    before, target = (np.where(rng.random((gru.STEPS, 3)) < 0.5, rng.integers(n_inputs, n, (gru.STEPS, 3)), rng.integers(0, n_inputs, (gru.STEPS, 3))) for _ in range(2))
    before[3, 1], before[5, 0], target[4, 2] = 5, n_inputs + 9, n_inputs + 7 * gru.LEAVES + 2
    loss = lambda: gru._gradients(before, target, np.zeros((3, gru.HIDDEN)), w)
    g, sparse, _, _ = loss()
    for k, (rows, x, touches) in sparse.items():
        g[k] = np.zeros_like(w[k])
        g[k][rows] = x
        assert touches.sum() == ((before if k == "leaf_embedding" else target) >= n_inputs).sum()
    for k in [*g] * 2:
        at = tuple(rng.integers(0, s) for s in w[k].shape)
        at = {"embedding": (5, 2), "leaf_embedding": (9, 1), "leaves": (7, at[-1] % 8, 2)}.get(k, at)
        w[k][at] += 1e-5
        up = loss()[3]
        w[k][at] -= 2e-5
        down = loss()[3]
        w[k][at] += 1e-5
        assert g[k][at] == pytest.approx((up - down) / 2e-5 / before.size, rel=1e-3, abs=1e-8)
    assert g["leaves"][7, 0, 2] != 0 and g["leaves"][7, -1, 2] != 0 and g["leaf_embedding"][9, 1] != 0
    w = small_model()
    n_words, end = 300, gru.end_of(w)
    ids = rng.integers(0, n, n_words)
    whole = gru.score(ids, np.array([0, 80, 80 + 7, n_words]), w)
    alone = [gru.score(ids[a:b], np.array([0, b - a]), w)[0] for a, b in ((0, 80), (80, 87), (87, n_words))]
    assert whole == pytest.approx(alone, rel=1e-4)
    table = np.concatenate([w["embedding"], w["leaf_embedding"] @ w["widen"]]) @ w["inputs"] + w["bias"]
    h, total, last = np.zeros((1, gru.HIDDEN), np.float32), 0.0, end  # step by step
    for t in range(80):
        h = gru._cell(table[[last]], np.where(last == end, np.float32(0), h), w)[0]
        total += float(gru.log_probs(h, ids[[t]], w)[0])
        last = ids[t]
    assert whole[0] == pytest.approx(total, rel=1e-4)


# 2


@pytest.mark.parametrize("most", [500, 2])
def test_substrings(docs, rows, monkeypatch, most):
    monkeypatch.setattr(op2, "MAX_SHARD", most)
    first = {}
    for i, t, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = split(t)
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    expected = []
    for i, t, *_ in rows:
        w = split(t)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        expected.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    got = op2.remove_repeats(docs).collect()
    same([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got], expected)
    assert all(sum(x.to - getattr(x, "from") for x in r.removed) == r.n_removed for r in got)


def test_output_layers_take_many_tokens_at_once(monkeypatch):
    """Learning and scoring don't take the softmax of each class or step on its own."""
    from tickerflow.llm import gru

    rng = np.random.default_rng(6)
    w = gru.new_weights(rng.random(44), rng.random((40, gru.PLACES)), rng.random((0, gru.LEAVES)))
    ids = rng.integers(0, 40 * gru.PLACES, gru.LANES * 4 * gru.STEPS).astype(np.int32)
    calls, softmax = [], gru._softmax
    monkeypatch.setattr(gru, "_softmax", lambda x, target: calls.append(len(x)) or softmax(x, target))
    gru.Trainer(w, 0.01).learn(ids)
    assert sum(calls) == 2 * len(ids) and len(calls) <= 2 * len(ids) / gru.ROWS + 8
    calls.clear()
    gru.score(ids, np.arange(0, len(ids) + 1, 64), w)
    assert sum(calls) == 2 * len(ids) and len(calls) <= 2 * len(ids) / gru.ROWS + 8


def test_leaves_are_read_once_a_place():
    """Tokens of a place share its leaves, in blocks of a few places; learning from the blocks gives what the whole gradient gives."""
    from functools import partial

    from tickerflow.llm import gru

    rng = np.random.default_rng(7)
    w = small_model()
    w["leaves"] = np.concatenate([w["leaves"]] * 2)
    w["places"], w["place_bias"] = (np.concatenate([x, x[-1:]]) for x in (w["places"], w["place_bias"]))
    w["leaf_embedding"], w["classes"], w["class_bias"] = np.concatenate([w["leaf_embedding"]] * 2), np.concatenate([w["classes"], w["classes"][:, :1]], axis=1), np.r_[w["class_bias"], w["class_bias"][:1]]
    w["leaf_touches"], w["input_touches"] = np.zeros(len(w["leaves"]), np.float32), np.zeros(len(w["leaf_embedding"]), np.float32)
    n_inputs, n_leaves = len(w["embedding"]), len(w["leaf_embedding"])
    skewed = n_inputs + (n_leaves * rng.random((gru.STEPS, 40)) ** 3).astype(np.int64)
    ids = np.where(rng.random(skewed.shape) < 0.8, skewed, rng.integers(0, n_inputs, skewed.shape))
    cls, place, leaf = gru.targets(ids.ravel(), w)
    blocks = list(gru._leaf_rows(cls, place, leaf, w))
    assert sorted(r for rows, *_ in blocks for r in rows) == np.flatnonzero(ids.ravel() >= n_inputs).tolist()
    places = np.concatenate([at for _, at, *_ in blocks])
    assert len(set(places)) == len(places) > gru.LEAF_PLACES >= max(len(at) for _, at, *_ in blocks)
    for rows, at, n, runs in blocks:
        assert (np.repeat(at, n) == (ids.ravel()[rows] - n_inputs) // gru.LEAVES).all()
        assert all((n[of] == often).all() and own.stop - own.start == often * (of.stop - of.start) for often, own, of in runs)
    before, h = np.roll(ids, 1, axis=0), np.zeros((40, gru.HIDDEN), np.float32)
    whole, blocked = gru.Trainer(w, 0.01), gru.Trainer(w, 0.01)
    _, sparse, _, loss = gru._gradients(before, ids, h, whole.w)
    whole._touch("leaves", np.float32(1), *sparse["leaves"])
    _, rest, _, same_loss = gru._gradients(before, ids, h, blocked.w, partial(blocked._touch, "leaves", np.float32(1)))
    assert "leaves" not in rest and loss == same_loss
    assert (whole.w["leaves"] == blocked.w["leaves"]).all() and (whole.w["leaf_touches"] == blocked.w["leaf_touches"]).all()


def test_substrings_disk(spark, docs):
    """The steps leave neither shuffle files nor tables, but for the windows that go."""
    from pathlib import Path

    base, setting = Path(ensure_checkpoint_dir(spark).removeprefix("file:")), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
        return {x for x in blocks.split() if x.startswith("shuffle_")}

    tables, files, kept = {p.name for p in base.iterdir()}, shuffles(), spark.conf.get(setting)
    got = op2.remove_repeats(docs)
    for _ in range(50):  # Spark deletes in the background
        if shuffles() <= files:
            break
        time.sleep(0.1)
    assert shuffles() <= files
    assert {p.name.rsplit("-", 1)[0] for p in base.iterdir() if any(p.iterdir()) and p.name not in tables} == {"gone-windows"}
    assert spark.conf.get(setting) == kept
    assert got.where("n_removed > 0").count()


@pytest.mark.parametrize("most", [500, 0])
def test_substrings_driver(spark, docs, monkeypatch, most):
    """The driver takes the filter and the cut anchors as bytes, the filter by parts; the filter has the bits of all anchors and no others."""
    from pyspark.sql import DataFrame

    from tickerflow.llm.tables import written

    taken, collect = [], type(docs).collect

    def seen(df):
        taken.append((df.columns, rows := collect(df)))
        return rows

    anchors = [int(x) for x in np.random.default_rng(8).integers(-(1 << 63), 1 << 63, 40_000)]
    monkeypatch.setattr(op2, "TAKEN_WORDS", 1 << 10, raising=False)
    monkeypatch.setattr(op2, "MAX_SHARD", most)
    for kind in {DataFrame, type(docs)}:
        monkeypatch.setattr(kind, "toPandas", lambda df: pytest.fail("rows of numbers at the driver"))
    monkeypatch.setattr(type(docs), "collect", seen)
    for n in (0, 3, 40_000):
        taken.clear()
        got = op2._bloom(written(spark.createDataFrame([(x,) for x in anchors[:n]], "anchor long"), "anchors"))
        expected = np.zeros(len(got), np.uint64)
        for place in op2._positions(np.array(anchors[:n], np.int64).view(np.uint64), 64 * len(got)):
            np.bitwise_or.at(expected, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        assert (got == expected).all() and len(got) == {0: 1, 3: 1, 40_000: 1 << 13}[n]
        parts = [sum(len(r["words"]) for r in rows) for columns, rows in taken if columns == ["piece", "words"]]
        assert max(parts) <= 8 << 10 and sum(parts) == (len(got) * 8 if n else 0)
    taken.clear()
    assert op2.remove_repeats(docs).where("n_removed > 0").count()
    packed = [np.frombuffer(r["anchors"], np.int64) for columns, rows in taken if columns == ["anchors"] for r in rows]
    assert bool(packed) == (most == 0)


def test_substrings_empty(none):
    assert op2.remove_repeats(none).count() == 0


def test_suffix_automaton():
    rng = random.Random(5)
    for _ in range(200):
        texts = [[rng.choice("ab") for _ in range(rng.randrange(1, 14))] for _ in range(5)]
        window, automaton = rng.randrange(1, 6), op2.SuffixAutomaton()
        for k, t in enumerate(texts):
            expected = [next((j for j in range(k) if any(texts[j][x : x + window] == t[i : i + window] for x in range(len(texts[j]) - window + 1))), None) for i in range(len(t) - window + 1)]
            assert automaton.first_ids(t, window) == expected
            automaton.add(t, k)


# 3


def _word_sets(rows):
    words = [split((t or "").translate({c: c + 32 for c in range(65, 91)})) for _, t, *_ in rows]
    return [frozenset(tuple(w[k : k + 4]) for k in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else []) for w in words]


def _classes(rows, percent=85):
    sets = _word_sets(rows)
    parent = {r[0]: r[0] for r in rows if r[0] is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(rows[i][0]), root(rows[j][0])))
                parent[y] = x
    return [(r[0], len(s), None if r[0] is None else root(r[0])) for r, s in zip(rows, sets)]


@pytest.mark.parametrize(("rounds", "hot", "long"), [(2, 8, 64), (1, 4, 3), (0, 2, 2)])
def test_jaccard(docs, rows, monkeypatch, rounds, hot, long):
    monkeypatch.setattr(op3, "HOT_DF", hot)
    monkeypatch.setattr(op3, "LONG", long)
    monkeypatch.setattr(op3, "BLOCK", 5)
    same([tuple(r) for r in op3.jaccard_classes(docs, star_rounds=rounds).collect()], _classes(rows))


def _n_links(rows, percent=85):
    """With how many other rows each row links, pair by pair."""
    sets, n = _word_sets(rows), [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and None not in (rows[i][0], rows[j][0]) and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                n[i] += 1
                n[j] += 1
    return [(*c, k) for c, k in zip(_classes(rows, percent), n)]


@pytest.mark.parametrize(("small", "block"), [(32, 256), (2, 4), (1, 1)])
def test_jaccard_counts_links(docs, rows, none, monkeypatch, small, block):
    monkeypatch.setattr(op3, "SMALL", small)
    monkeypatch.setattr(op3, "BLOCK", block)
    got = op3.jaccard_classes(docs, count_links=True)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    expected = _n_links(rows)
    assert max(n for *_, n in expected) > 7 and len({n for *_, n in expected}) > 3
    same([tuple(r) for r in got.collect()], expected)
    assert op3.jaccard_classes(none, count_links=True).count() == 0


def test_jaccard_links_within_a_chain(spark):
    """Copies that drift word by word: one class, but its ends don't link; two texts under one id."""
    words = _passage(31, 60)
    rows = []
    for k in range(12):
        rows.append((k, " ".join(words), None, None, 0, 0, "", 0, ""))
        words = words[2:] + _passage(900 + k, 2)
    rows += [(3, rows[3][1] + " and more", None, None, 0, 0, "", 0, ""), (40, rows[3][1], None, None, 0, 0, "", 0, "")]
    expected = _n_links(rows)
    assert len({c for _, _, c, _ in expected}) == 1 and max(n for *_, n in expected) < len(rows) - 1
    same([tuple(r) for r in op3.jaccard_classes(spark.createDataFrame(rows, DOCS), count_links=True).collect()], expected)


def test_jaccard_keeps_one(docs, rows, none):
    kept = op3.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    smallest = {c for i, n, c in _classes(rows) if n and c is not None}
    wordless = [i for i, n, _ in _classes(rows) if not n and i is not None]
    assert sorted(i for i in ids if i is not None) == sorted([*smallest, *wordless])
    assert ids.count(None) == 2
    assert op3.one_of_each(none).count() == 0 and op3.jaccard_classes(none).count() == 0


def test_most_frequent(spark):
    from tickerflow.llm.tables import most_frequent

    counts = spark.range(400).selectExpr("id as word", "case when id < 20 then 5000 + id * id * 100 else 1 + id % 40 end as n")
    for limit in (0, 7, 60, 1000):
        got = sorted((r.n for r in most_frequent(counts, limit).collect()), reverse=True)
        every = sorted((r.n for r in counts.collect()), reverse=True)
        assert len(got) <= limit and got == every[: len(got)]
        assert limit < 60 or len(got) > limit - 20 or len(got) == 400


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 2), (9, 8), (2, 1), (7, 7), (20, 10)] + [(30, k) for k in range(31, 60)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {5: 1, 4: 1, 3: 1, 2: 1, 1: 1, 9: 8, 8: 8, 20: 10, 10: 10} | dict.fromkeys(range(30, 60), 30)


# 4


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_toxic_lexicon_keeps_every_term(spark, monkeypatch):
    names = [f"q{k:03d}" for k in range(230)]
    rows = [(" ".join(names), 1)] * 8 + [("plain words", 0)] * 40
    lexicon = op4.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    terms = [(n, 9.0 - k / 100, False) for k, n in enumerate(["moron", "idiot", "maron", "abc", "idiom"])]
    words = ["moron", "meron", "idiot", "idiod", "abc", "abd", "maron", "x"]
    points = np.frombuffer(" ".join(words).encode("utf-32-le"), np.uint32)
    starts = np.cumsum([0] + [len(w) + 1 for w in words])[:-1]
    ends = starts + [len(w) for w in words]
    whole = op4.Automaton(terms).match(points, starts, ends)
    monkeypatch.setattr(op4, "PART_TERMS", 2)
    assert all((a == b).all() for a, b in zip(whole, op4.Automaton(terms).match(points, starts, ends)))
    points = np.frombuffer(" ".join(names).encode("utf-32-le"), np.uint32)
    starts = np.arange(230) * 5
    assert lexicon.match(points, starts, starts + 4)[1].all()


def test_levenshtein_automaton():
    automaton = op4.Automaton([("moron", 5.0, False), ("idiot", 4.0, False), ("abc", 3.0, False), ("lowei", 6.0, True)])
    rng, words = random.Random(1), ["moron", "idiot", "abc", "abd", "loweix", "lowe", "möron"]
    for _ in range(3000):
        w = list(rng.choice(["moron", "idiot", "abc", "loweizz"]))
        for _ in range(rng.randrange(4)):
            w[(i := rng.randrange(len(w))) : i + rng.randrange(2)] = rng.choice(["", "a", "m", "d", "ä"])
            w = w or ["x"]
        words.append("".join(w))
    points = np.frombuffer(" ".join(words).encode("utf-32-le"), np.uint32)
    starts = np.cumsum([0] + [len(w) + 1 for w in words])[:-1]
    term, exact = automaton.match(points, starts, starts + [len(w) for w in words])
    for w, t, e in zip(words, term, exact):
        right = w in ("moron", "idiot", "abc") or w.startswith("lowei")
        assert e == right and (t > 0) == (right or min(_distance(w, "moron"), _distance(w, "idiot")) <= 1), w


def test_toxicity_learns(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(1500):
        words = [f"w{rng.randrange(300)}" for _ in range(40)]
        bad = i % 5 == 0
        if bad:
            words[rng.randrange(40)] = rng.choice(["scumbag", "worthless", "Pathetic!"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    odd = [(2000, "w1 w2 you are a w0rthless w3 w4"), (2001, 'w1 w2 he said "pathetic" w5 w6 w7'), (2002, None), (2003, ""), (None, "w1 scumbag"), (2004, "w1 w2 " * 9000 + "scumbag")]
    labels += [(2000, None), (None, 1), (3, 0)]
    d = spark.createDataFrame(docs + odd, "doc_id long, text string")
    got = op4.toxicity(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == len(docs) + len(odd)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1500]
    assert held and all(r.predicted == (r.doc_id % 5 == 0) for r in held)
    by = {r.doc_id: r for r in got}
    assert by[2000].predicted == 1 and by[2004].predicted == 1 and by[None].predicted == 1 and by[None].held_out
    assert by[2001].predicted == by[2002].predicted == by[2003].predicted == 0
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) for r in got)


def test_toxicity_without_labels(docs, none, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in op4.toxicity(docs, labels).collect()} == {0}
    assert op4.toxicity(none, labels).count() == 0


# 5


def _least_capacity(sizes, shards):
    def fits(c):
        n, now = 1, 0
        for s in sizes:
            if s > c:
                return False
            if now + s > c:
                n, now = n + 1, 0
            now += s
        return n <= shards

    return next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))


@pytest.mark.parametrize(("shards", "finer"), [(24, 4096), (5, 2)])
def test_shards(docs, rows, monkeypatch, shards, finer):
    monkeypatch.setattr(op5, "FINER", finer)
    got = op5.shard(docs, shards).collect()
    assert set(docs.columns) < set(got[0].asDict()) and len(got) == len(rows)
    group = collections.Counter()
    for r in got:
        text = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 8, zlib.crc32(text))
        group[hashlib.sha256(text).hexdigest()] += r.size
    of = collections.defaultdict(set)
    by = collections.defaultdict(list)
    for r in got:
        of[r.text or ""].add(r.shard)
        by[r.shard].append(r)
    assert all(len(s) == 1 for s in of.values())
    assert all(sorted(r.slot for r in x) == list(range(len(x))) and 0 <= s < shards for s, x in by.items())
    assert max(sum(r.size for r in x) for x in by.values()) == _least_capacity([group[k] for k in sorted(group)], shards)


def test_shards_empty(none):
    assert op5.shard(none).count() == 0


# 6


def test_contamination(spark, docs, rows, none):
    bench = [(1, " ".join(_passage(1, 40)[5:20])), (2, "The CAT, sat!"), (3, ""), (4, None), (10, " ".join(_passage(1, 40)[8:19])), (None, " ".join(_passage(7, 90)[60:75])), (1, "again: and again we say the same thing again and again we"), (5, "日本")]
    table = spark.createDataFrame(bench, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = collections.defaultdict(set)
    for i, t in bench:
        w = words(t)
        for k in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)
    expected = []
    for i, t, *_ in rows:
        w, hit, items = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    items |= own
        expected.append((i, len(w), len(hit), ",".join(sorted(str(x) for x in items if x is not None))))
    for most in (1_000_000, 12):
        got = op6.find_contamination(docs, table, max_words=most).collect()
        same([(r.doc_id, r.n_words, sum(x.to - getattr(x, "from") for x in r.hits), ",".join(r["items"])) for r in got], expected)
        # one pass over the documents in a plan, however many blocks the benchmark has
        plan = op6.find_contamination(docs, table, max_words=most)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1
    clean = op6.remove_contaminated(docs, table)
    assert clean.columns == docs.columns
    same([(r.doc_id,) for r in clean.collect()], [(e[0],) for e in expected if not e[2]])
    assert op6.find_contamination(none, table).count() == 0
    assert op6.remove_contaminated(docs, table.limit(0)).count() == len(rows)


# 7


def test_mixing(docs, rows, none):
    got = op7.repetitions(docs).collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for _, t, _, s, *_ in rows:
        size[s] += len(split(t))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    capped = set()
    while True:  # the excess goes to the others, round by round
        level = (sum(size.values()) - sum(3 * size[s] for s in capped)) / sum(w for s, w in weight.items() if s not in capped)
        above = {s for s in size if s not in capped and level * weight[s] > 3 * size[s]}
        if not above:
            break
        capped |= above
    for r in got:
        target = 3 * size[r.source] if r.source in capped else level * weight[r.source]
        assert r.source_size == size[r.source] and r.target == pytest.approx(target) and r.size == len(split(r.text))
        rate = target / size[r.source]
        assert math.floor(rate) <= r.copies <= math.floor(rate) + 1 and r.copies <= 3 and r.taken == r.copies * r.size
    mixed = op7.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    same(mixed.collect(), op7.mix(docs.repartition(5)).collect())
    assert op7.mix(none).count() == 0


def test_mixing_comes_near_targets(spark):
    docs = spark.range(30000).selectExpr("id as doc_id", "concat('s', id % 4) as source", "repeat('w ', cast(id % 37 as int)) as text")
    for r in op7.repetitions(docs).groupBy("source", "target").sum("taken").collect():
        assert r["sum(taken)"] == pytest.approx(r["target"], rel=0.05)


def test_jaccard_sets_of_a_batch_come_in_pieces():
    """Tasks hold the sets of some rows of a batch, not of all; the pieces make up the batch."""
    from types import SimpleNamespace

    import pyarrow as pa

    n = 2 * op3.SLICE_ROWS + 5
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([None if i % 5 == 0 else f"a b c d {i % 9} e" for i in range(n)])], names=["doc_id", "text"])
    order = SimpleNamespace(value=(np.zeros(0, np.int64), np.zeros(0, np.int64)))
    for whole in (False, True):
        out = list(op3._rows([batch], 4, 85, order, whole))
        assert max(map(len, out)) <= op3.SLICE_ROWS and [x for b in out for x in b.column(0).to_pylist()] == list(range(n))
        sets = [x for b in out for x in b.column("tokens" if whole else "prefix").to_pylist()]
        one = [x for b in op3._rows([batch.slice(i, 1) for i in range(n)], 4, 85, order, whole) for x in b.column("tokens" if whole else "prefix").to_pylist()]
        assert sets == one


# 8

PAGE = """<!DOCTYPE html><html><head><title>x</title></head><body class="post has-sidebar"><header><h1>Site</h1></header><nav>menu</nav>
<div class="cookie-notice">We use cookies</div><article><header><h1>Head &amp; line</h1></header><p>One <b>two</b>three<br>four &lt;x&gt; a < b</p><div class="ad">Buy</div>
<form><input>mail</form><ul><li>i<li>j</ul><section class="comments"><article class="comment">bad</article></section><p>end&nbsp;of</p><script>if(a<b){"</p>"}</script>
<!-- <p>no</p> --><p hidden>no</p></article><aside>side</aside><footer>foot</footer></body></html>"""


def test_page_structure():
    assert op8.split_page(PAGE) == ("Head & line One twothree four <x> a < b i j end of", "")
    assert op8.split_page('<div id="content"><p>hello</div><div class="footer">x</div>') == ("hello", "")
    assert op8.split_page("plain <i>te</i>xt &amp") == (None, "plain text &")
    assert op8.split_page("") == (None, "") and op8.split_page("<p>" * 5000 + "x") == (None, "x")
    article = '<article><h2 id="legal-history">Legal</h2><section id="search-methods">s</section><p class="notice">n</p><div class="social-share">x</div><div class="comments">c</div>t</article>'
    assert op8.split_page(article) == ("Legal s n t", "") and op8.split_page('<div class="share-price"><article>a</article></div>') == ("a", "")
    assert op8.split_page("<article></article>a") == ("", "a") and op8.split_page("a <script>b") == (None, "a")


def test_main_text_repeats(spark):
    b = " ".join(f"m{i}" for i in range(12))
    pages = [(1, "http://a/x", f"<p>{b} u1 u2 u3</p>"), (2, "http://A/y", f"<p>v1 v2 v3 v4 {b}</p>"), (3, "http://b/y", f"<div>v1 v2 {b}</div>"), (4, "http://b/z", f"<p>v1 v2 {b}</p>"), (5, None, None), (None, "http://a/q", ""), (1, "http://a/x", f"<p>{b} u1 u2 u3</p>"), (6, "http://a/w", PAGE)]
    table = spark.createDataFrame([(*p, 7) for p in pages], "page_id long, url string, html string, text int")
    got = [(r.page_id, r.url, r.text) for r in op8.main_text(table).collect()]
    both = f"v1 v2 {b}"
    same(got, [(1, "http://a/x", "u1 u2 u3")] * 2 + [(2, "http://A/y", "v1 v2 v3 v4"), (3, "http://b/y", both), (4, "http://b/z", both), (5, None, ""), (None, "http://a/q", ""), (6, "http://a/w", op8.split_page(PAGE)[0])])
    assert op8.main_text(table.limit(0)).count() == 0


def test_main_text_of_articles_passes_the_arrays(spark):
    """Articles are judged by the arrays of their host: repeats are counted, repeated doubtful elements go, copies and the rest stay."""
    words = lambda s, n: " ".join(f"{s}{i}" for i in range(n))
    hint, quote = words("h", 9), words("q", 10)
    page = lambda own, more, name="search-hints": f'<nav>{quote}</nav><article><p>{own}</p><section id="{name}">{more}</section></article>'
    pages = [
        (1, "http://a/1", page(words("a", 12), hint)),
        (2, "http://a/2", page(f"{words('b', 30)} {quote}", hint)),
        (3, "http://a/3", page(f"{words('c', 30)} {quote}", words("x", 9))),  # no one repeats its element
        (4, "http://a/4", page(words("d", 12), f"{hint} more")),  # not the whole element
        (5, "http://a/5", page(words("e", 12), words("y", 9))),
        (6, "http://a/6", page(words("e", 12), words("y", 9)) + "<p>print</p>"),  # the same text
        (7, "http://a/7", page(words("e", 12) + " z", words("y", 9))),  # a copy, but for one token
        (8, "http://b/1", page(words("a", 12), hint)),  # another host
        (9, "http://a/9", f"<p>{words('a', 12)} u</p>"),  # open text is judged by open texts
        (10, "http://a/10", page(words("f", 12), hint, "search-box")),  # boilerplate by its name
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    want = [
        (1, f"{words('a', 12)} {hint}", 21), (2, f"{words('b', 30)} {quote}", 19), (3, f"{words('c', 30)} {quote} {words('x', 9)}", 10), (4, f"{words('d', 12)} {hint} more", 9),
        (5, f"{words('e', 12)} {words('y', 9)}", 21), (6, f"{words('e', 12)} {words('y', 9)}", 21), (7, f"{words('e', 12)} z {words('y', 9)}", 21), (8, f"{words('a', 12)} {hint}", 0), (9, f"{words('a', 12)} u", 0), (10, words("f", 12), 0),
    ]
    for size in (op8.MAX_SHARD, 0):
        same([(r.page_id, r.text, r.n_repeated) for r in op8.main_text(table, max_shard=size).collect()], want)
    fewer = [(r.page_id, r.text) for r in op8.main_text(table.where("page_id < 9")).collect()]
    assert dict(fewer)[1] == words("a", 12) and dict(fewer)[2] == f"{words('b', 30)} {quote}"


def test_repeated_runs():
    rng = random.Random(4)
    for _ in range(50):
        texts = [[rng.choice("ab") for _ in range(rng.randrange(12))] for _ in range(4)]
        pages = [(p := rng.randrange(3), p + rng.randrange(2)) for _ in texts]
        for t, flags in zip(texts, op8.repeated_runs(texts, pages, 3)):
            for i, f in enumerate(flags):
                own = [p for x, p in zip(texts, pages) if any(x[j : j + 3] == t[i : i + 3] for j in range(len(x) - 2))]
                assert f == (min(p[0] for p in own) != max(p[1] for p in own))


# 9


def test_token_counts(docs, rows, none):
    pieces = op9.read_pieces(op9.TOKENIZER)
    model = op9.Unigram(pieces)

    def best(text):
        """Least cost and count of pieces, over all segmentations."""
        memo = {len(text): (0, 0)}
        for i in range(len(text) - 1, -1, -1):
            options = [(memo[i + 1][0] + model.unknown, memo[i + 1][1] + 1)]
            options += [(memo[j][0] + pieces[text[i:j]], memo[j][1] + 1) for j in range(i + 1, min(len(text), i + 30) + 1) if text[i:j] in pieces]
            memo[i] = min(options)
        return memo[0][1]

    memo = {}
    count = lambda w: memo.setdefault(w, None) or memo.update({w: best(b" " + w)}) or memo[w]
    got = [(r.doc_id, r.n_words, r.n_tokens) for r in op9.token_counts(docs).collect()]
    same(got, [(r[0], len(split(r[1])), sum(count(w) for w in split(r[1]))) for r in rows])
    assert op9.token_counts(none).count() == 0


# 10


def test_quality_counts(docs, rows, none):
    got = op10.features(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    expected = []
    for i, t, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        c = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        again = {k + j for k in range(len(w) - 7) if c[tuple(w[k : k + 8])] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        expected.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), len(w) < 20 or 100 * len(again) > 30 * len(w)))
    same(got, expected)
    assert op10.features(none).count() == 0


def test_binomial(spark):
    from pyspark.sql import functions as F

    table = spark.createDataFrame([(k, n) for n in (1, 7, 300, 5000) for k in (0, 1, 3, 20) if k <= n], "k long, n long")
    for r in table.withColumn("p", op10.binomial_cdf(F.col("k"), F.col("n"), 0.01)).collect():
        exact = sum(math.exp(math.lgamma(r.n + 1) - math.lgamma(j + 1) - math.lgamma(r.n - j + 1) + j * math.log(0.01) + (r.n - j) * math.log(0.99)) for j in range(r.k + 1))
        assert r.p == pytest.approx(1.0 if r.k > 0.01 * r.n else exact, rel=1e-9)


def test_quality_cutoffs(spark):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(4000):
        words = [f"word{rng.randrange(9999)}" for _ in range(30)]
        bad = i % 4 == 0
        lang = "en" if i % 2 else None if i < 200 else "de"
        if bad:
            words = [w + "###" for w in words]
        if lang == "de" and not bad and i % 8 == 2:
            words = [w + "###" for w in words]  # good documents of this stratum have symbols too
        docs.append((i, " ".join(words), lang, 1))
        labels.append((i, int(not bad)))
    bad_en = [(5001, " ".join(f"w{k}$$$" for k in range(40)), "en", 1), (5002, " ".join(f"word{k}" for k in range(40)), "en", 1), (5003, " ".join(f"w{k}$$$" for k in range(40)), "xx", 1)]
    docs, labels = [(i, t, "en" if i % 4 == 0 and i % 8 else lang, x) for i, t, lang, x in docs], labels + [(5001, None), (None, 1)]
    d = spark.createDataFrame(docs + bad_en, "doc_id long, text string, lang string, kept int")
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    limits = {r.lang: r.cut_symbols for r in op10.cutoffs(op10.written(op10.features(d).drop("text"), "t"), table).collect()}
    assert limits.get("en") is not None and limits.get("de") is None and limits.get(None) is None
    kept = op10.keep_good(d, table)
    assert kept.columns == d.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 5001 not in ids and {5002, 5003} <= ids
    good = {i for i, t, lang, _ in docs if i % 4}
    assert len(good - ids) <= 0.05 * len(good)
    assert op10.keep_good(d.limit(0), table).count() == 0 and op10.keep_good(d, table.limit(0)).count() == len(docs) + 3
