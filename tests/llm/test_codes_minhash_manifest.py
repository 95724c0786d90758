"""Operators 11 to 13 against brute force, on odd rows and on hot groups."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from tickerflow.llm import op11_codes as op11
from tickerflow.llm import op12_minhash as op12
from tickerflow.llm import op13_manifest as op13
from tickerflow.llm.tables import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, block string, n int, level string, root string, id string"
VECTORS = "vec_id long, embedding array<float>, label int, id string, x string, code string, error string, ids int"


def same(got, expected):
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, expected))


# 11


def _coded(rows, parts=8, entries=16, rounds=6):
    """(vec_id, label, code, error) and books by plain Lloyd rounds."""
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    fits = sorted((k for k in kept if k[0] is not None and len(k[1]) and len(k[1]) % parts == 0), key=lambda k: k[:2])
    dim = len(fits[0][1])
    w = dim // parts
    cut = lambda v: [v[p * w : (p + 1) * w] for p in range(parts)]
    books = [[cut(k[1])[p] for k in fits if len(k[1]) == dim][:entries] for p in range(parts)]
    own = [k for k in kept if len(k[1]) == dim]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min((square(v, e), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            by = collections.defaultdict(list)
            for k in own:
                by[near(cut(k[1])[p], p)[1]].append(cut(k[1])[p])
            books[p] = [[sum(c) // len(by[e]) for c in zip(*by[e])] if by[e] else old for e, old in enumerate(books[p])]
    out = []
    for i, v, label in kept:
        found = [near(c, p) for p, c in enumerate(cut(v))] if len(v) == dim else None
        out.append((i, label, found and "".join(f"{e:02x}" for _, e in found), found and sum(d for d, _ in found)))
    return out, books


def _vectors():
    rng = random.Random(5)
    centre = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in centre[i % 6]], [1, 2, None][i % 3]) for i in range(40, 240)]
    rows += [(1000 + i, centre[0], 7) for i in range(90)] + [rows[3], rows[3]]  # equal vectors, repeated rows
    rows += [(5, None, 1), (6, [1.0] * 15 + [None], 1), (7, [float("nan")] * 16, 1), (8, [float("inf")] + [0.0] * 15, 1), (9, [-float("inf")] * 16, None)]
    rows += [(2, [], 1), (3, [1.0, 2.0], 1), (4, [0.5] * 24 + [1.0], 3), (300, [0.5] * 24, 3), (None, centre[1], None), (None, centre[2], 4)]
    return rows + [(400, [0.0] * 16, 0), (401, [-1e-9] * 16, 0)]


@pytest.mark.parametrize("tasks", [1, 5])
def test_codes_like_plain_rounds(spark, monkeypatch, tasks):
    monkeypatch.setattr(op11, "CHUNK_VALUES", 16 * 70)
    rows = _vectors()
    df = spark.createDataFrame([(*r, "a", "b", "c", "d", 0) for r in rows], VECTORS).repartition(tasks)
    coded, books = op11.compress(df)
    expected, want = _coded(rows)
    assert books.tolist() == want
    same(coded.select("vec_id", "label", "code", "error").collect(), expected)
    total = {}
    for _, label, _, e in expected:
        total[label] = e if total.get(label) is None else total[label] + (e or 0)
    got = op11.with_label_errors(coded).collect()
    assert len(got) == len(expected) and all(r.label_error == total[r.label] for r in got)


def test_codes_of_few_or_no_vectors(spark):
    none = spark.createDataFrame([], VECTORS)
    coded, books = op11.compress(none)
    assert coded.count() == 0 and books is None
    few = [(9, [0.25] * 8, 1), (3, [0.5] * 8, None)]
    coded, books = op11.compress(spark.createDataFrame([(*r, "a", "b", "c", "d", 0) for r in few], VECTORS))
    same(coded.collect(), _coded(few)[0])
    assert books.shape == (8, 2, 1)


def test_tree_covers_its_points_and_walk_is_exact(monkeypatch):
    rng = np.random.default_rng(1)
    for n, d, spread, leaf in ((1, 3, 5, 4), (50, 1, 2, 4), (700, 3, 40, 8), (700, 8, 3, 8), (400, 2, 1, 4), (300, 4, 10**7, 16)):
        monkeypatch.setattr(op11, "LEAF", leaf)
        x = rng.integers(-spread, spread + 1, (n, d))
        tree = op11.build_tree(x)
        assert sorted(tree["order"].tolist()) == list(range(n)) and (tree["points"] == x[tree["order"]]).all()
        for k in range(len(tree["low"])):
            own = tree["points"][tree["low"][k] : tree["high"][k]].astype(np.int64)
            assert (own.sum(axis=0) == tree["sums"][k]).all() and ((own - tree["centre"][k]) ** 2).sum(axis=1).max() == tree["radius"][k]
        book = rng.integers(-spread, spread + 1, (16, d))
        book[7] = book[2]  # equal entries: the lower index wins
        entry, owned = np.full(n, -1), 0
        for e, low, high, cached in op11.walk(tree, book):
            assert (entry[low:high] == -1).all()
            entry[low:high] = e
            owned += high - low if cached is not None else 0
            assert cached is None or (cached == tree["points"][low:high].sum(axis=0)).all()
        distance = ((tree["points"].astype(np.int64)[:, None] - book[None]) ** 2).sum(axis=2)
        assert (entry == distance.argmin(axis=1)).all()
    assert owned  # balls are owned as a whole


# 12


def _sets(text, k=2):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def _classes(rows, percent=80):
    """component of each row by all pairs; rows of one id are one document with several sets."""
    own = [(i, _sets(t)) for i, t in rows]
    label = {i: i for i, _ in own if i is not None}
    links = [(a, b) for x, (a, s) in enumerate(own) for b, t in own[x + 1 :] if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t)]
    while True:
        old = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if old == label:
            return [(i, len(s), label.get(i) if s else i, i is None or i == (label[i] if s else i)) for i, s in own]


def _texts():
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(3000)}"
    shared = [word() for _ in range(60)]
    rows = []
    for _ in range(60):
        rows.append([word() for _ in range(rng.randrange(1, 90))] + shared[: rng.randrange(0, 60)])
    for size in (4, 5, 6, 9, 20, 60, 250):  # groups whose members lie around the threshold
        base = [word() for _ in range(size)]
        for _ in range(12):
            own = list(base)
            for _ in range(rng.randrange(0, max(2, size // 9))):
                own[rng.randrange(size)] = word()
            rows.append(own)
    texts = [" ".join(r) for r in rows] + [" ".join(rows[0])] * 4 + ["The  Cat\tsat", "the cat sat", "one", "ONE", "one two", "", None, " \n", "é ü 日本 \x0b ß", " ".join(word() for _ in range(9000))]
    texts += [texts[-1] + " more"]
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[5]), (None, None)]


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "a", 0, "x", "y", 1, "z", "r", "i") for i, t in rows], DOCS)


def test_near_duplicates_like_all_pairs(spark):
    rows = _texts()
    got = op12.near_duplicates(_frame(spark, rows).repartition(3)).collect()
    same(got, _classes(rows))


def test_near_duplicates_of_a_hot_group(spark, monkeypatch):
    """Copies of one text around the threshold, under keys that are long: blocks find every class."""
    monkeypatch.setattr(op12, "LONG", 4)
    monkeypatch.setattr(op12, "BLOCK", 16)
    monkeypatch.setattr(op12, "STAR_ROUNDS", 1)
    rng = random.Random(2)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(110):
        own = list(base)
        for _ in range(rng.randrange(3, 9)):
            own[rng.randrange(120)] = f"e{rng.randrange(9999)}"
        rows.append((i, " ".join(own)))
    expected = _classes(rows)
    assert len({r[2] for r in expected}) > 3
    same(op12.near_duplicates(_frame(spark, rows), star_rounds=1).collect(), expected)
    same(op12.near_duplicates(_frame(spark, rows), star_rounds=0).collect(), expected)


def test_near_duplicates_of_nothing(spark):
    assert op12.near_duplicates(_frame(spark, [])).count() == 0
    same(op12.near_duplicates(_frame(spark, [(1, None), (2, ""), (None, "a b")])).collect(), [(1, 0, 1, True), (2, 0, 2, True), (None, 1, None, True)])


def test_registers_are_compressed_least_hashes():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 1 << 62, n)) for n in (0, 1, 7, 5000)]
    sketch = op12.registers(sets)
    for own, row in zip(sets, sketch):
        least = {}
        for h in op12.mix(own.astype(np.uint64)).tolist():
            least[h >> 56] = min(least.get(h >> 56, 1 << 53), h & ((1 << 53) - 1))
        for k in range(op12.BUCKETS):
            bits = f"{least[k]:053b}" if k in least else ""
            zeros = len(bits) - len(bits.lstrip("0"))
            expected = (zeros << 10 | int(bits[zeros + 1 : zeros + 11].ljust(10, "0") or "0", 2)) if k in least else op12.EMPTY
            assert row[k] == expected
    full = op12.filled_up(sketch)
    assert (full[0] == op12.EMPTY).all() and (full[1:] != op12.EMPTY).all() and len(set(full[1])) == 1
    assert (full[2][sketch[2] != op12.EMPTY] == sketch[2][sketch[2] != op12.EMPTY]).all()


def test_estimate_and_collision_correction():
    rng = np.random.default_rng(3)
    estimates, chances = [], []
    for _ in range(200):
        pool = rng.integers(0, 1 << 62, 2200)
        x, y = op12.registers([pool[:2000], pool[200:]])  # similarity 1800 / 2200
        filled = ((x != op12.EMPTY) | (y != op12.EMPTY)).sum()
        estimates.append(((x == y) & (x != op12.EMPTY)).sum() / filled)
        a, b = op12.registers([rng.integers(0, 1 << 62, 3000), rng.integers(0, 1 << 62, 3000)])
        chances.append((a == b).mean())
    assert np.mean(estimates) == pytest.approx(1800 / 2200, abs=0.01)
    assert np.mean(chances) == pytest.approx(float(op12.collisions(np.float64(3000), np.float64(3000))), abs=2e-4)


def test_pairs_at_the_threshold_share_a_band_and_pass_the_estimate():
    rng = np.random.default_rng(4)
    for n in (4, 9, 45, 90, 450, 3000):
        k = n // 9  # n common ones of n + 2k: similarity 9/11 and more
        for _ in range(60):
            pool = np.unique(rng.integers(0, 1 << 62, n + 2 * k + 8))[: n + 2 * k]
            rng.shuffle(pool)
            pair = [pool[: n + k], np.concatenate([pool[:n], pool[n + k :]])]
            sketch = op12.registers(pair)
            keys = op12.band_keys(sketch)
            assert (keys[0] == keys[1]).any()
            equal, filled = ((sketch[0] == sketch[1]) & (sketch[0] != op12.EMPTY)).sum(), (sketch != op12.EMPTY).any(axis=0).sum()
            assert op12.possible(equal, filled, np.int64(n + k), np.int64(n + k), 80)


# 13


def _h(*values):
    return hashlib.sha256("".join(values).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _ways(leaves):
    """Root of a list of hashes and for each the siblings (left, right) level by level."""
    ways, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for w, i in zip(ways, at):
            run = i // 16 * 16
            w.append((level[run:i], level[i + 1 : run + 16]))
        at = [i // 16 for i in at]
        level = [_h(*level[i : i + 16]) for i in range(0, len(level), 16)]
    return level[0], ways


def _manifest(rows):
    by = collections.defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = lambda t: _h(*map(_field, (doc_id, source, lang, n_chars, t)))
        bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        lowered = text and text.translate({c: c + 32 for c in range(65, 91)})
        by[source].append((doc_id, leaf(text), leaf(lowered if bad else text)))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    subs = [_ways([r[1] for r in by[s]]) for s in sources]
    root, tops = _ways([r for r, _ in subs])
    out = []
    for s, (sub, ways), top in zip(sources, subs, tops):
        for (doc_id, leaf, folded), way in zip(by[s], ways):
            for left, right in way + top:
                folded = _h(*left, folded, *right)
            out.append((doc_id, leaf, sub, root, _h(*[h for left, right in way + top for h in left + right]), folded, folded == root))
    return out


def _documents():
    rng = random.Random(8)
    rows = [(i, rng.choice(["Some Text", "no capitals", "", None, "É ß 日本 A"]) , rng.choice(["en", None, ""]), "hot" if i % 3 else f"s{i % 57}", rng.choice([None, 3])) for i in range(800)]
    rows += [(900 + i, "T", "en", None, 1) for i in range(17)] + [(-5, "Neg", "en", "", 0), (2**60 + 1, "Big", "en", "hot", 1), (2**60 + 3, "Big", "en", "hot", 1), (None, "A", None, "hot", None), (None, "B", None, "hot", None)]
    return rows + [rows[1], rows[1], (1, "another Text", "en", "hot", 0), (7000, "Long " * 20000, "en", "Ü", 100000)]


def _table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, "z", "r", "i") for r in rows], DOCS)


def test_manifest_like_plain_trees(spark):
    rows = _documents()
    m = op13.manifest(_table(spark, rows).repartition(4))
    same(op13.proofs(m, m.leaves).collect(), _manifest(rows))


def test_proofs_of_some_leaves_and_several_blocks(spark, monkeypatch):
    """Blocks of one level: runs reach over blocks, and leaves that aren't asked for are fetched."""
    monkeypatch.setattr(op13, "HIGH", 1)
    rows = _documents()
    m = op13.manifest(_table(spark, rows), rise=1)
    expected = _manifest(rows)
    same(op13.proofs(m, m.leaves).collect(), expected)
    some = m.leaves.where("doc_id % 7 = 0")
    got = op13.proofs(m, some).collect()
    same(got, [r for r in expected if r[0] is not None and r[0] % 7 == 0])
    need = op13.fetched(some, m.leaves, m.nodes, Scratch(spark)).where("level = 0").count()
    assert need > 0


def test_missing_coordinates_are_minimal():
    rng = random.Random(1)
    for n in (1, 2, 16, 17, 300, 5000):
        for k in (1, 5, n):
            own = np.array(sorted(rng.sample(range(n), min(k, n))))
            hashes = [_h(str(i)).encode() for i in range(n)]
            tree, level = {(0, i): h for i, h in enumerate(hashes)}, 0
            for count in op13.heights(n)[1:]:
                for i in range(count):
                    tree[level + 1, i] = op13.sha(b"".join(tree[level, j] for j in range(16 * i, min(16 * i + 16, op13.heights(n)[level]))))
                level += 1
            need = op13.missing(own, n)
            runs = op13.runs_to_root(own, [hashes[i] for i in own], {c: tree[c] for c in need}, n)
            for i in own:
                assert op13.fold(hashes[i], op13.way(runs, int(i))) == tree[level, 0]
            known = {(0, int(i)) for i in own}
            for lv in range(level):
                known |= {(lv + 1, i // 16) for j, i in known if j == lv}
            assert not known & set(need) and len(need) == len(set(need))
            if need:
                with pytest.raises(KeyError):
                    op13.runs_to_root(own, [hashes[i] for i in own], {c: tree[c] for c in need[1:]}, n)


def test_manifest_of_few_or_no_rows(spark):
    m = op13.manifest(_table(spark, []))
    assert m.root is None and op13.proofs(m, m.leaves).count() == 0
    one = [(3, "Only One", "en", None, 1)]
    m = op13.manifest(_table(spark, one))
    same(op13.proofs(m, m.leaves).collect(), _manifest(one))
