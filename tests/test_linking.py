import itertools
import random

from pyspark.sql import functions as F

from tickerflow.operators import linking as L
from tickerflow.operators import relations as R
from tickerflow.operators import tickermap as M


def _names(spark, pairs):
    return spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(pairs)], "ord long, name string, ticker string")


def test_token_sort_ratio_values():
    assert L.token_sort_ratio_py("FPT Tập đoàn", "Tập đoàn FPT") == 100.0
    assert L.token_sort_ratio_py("abcd", "abce") == 75.0


def test_update_map_keeps_position(spark):
    base = _names(spark, [("A", "1"), ("B", "2")])
    upd = _names(spark, [("A", "3"), ("C", "4")])
    got = [(r["name"], r["ticker"]) for r in M.update_map(base, upd).orderBy("ord").collect()]
    assert got == [("A", "3"), ("B", "2"), ("C", "4")]


def test_first_name_per_ticker(spark):
    m = _names(spark, [("a", "X"), ("b", "X"), ("c", "Y")])
    kept = sorted(r["name"] for r in M.first_name_per_ticker(m).filter("kept").collect())
    assert kept == ["a", "c"]


def test_normalized_keys_later_wins(spark):
    m = _names(spark, [("FPT", "1"), ("fpt ", "2")])
    assert [tuple(r) for r in M.normalized_keys(m).collect()] == [("fpt", "2")]


def _scan(spark, text, keys, target="Z"):
    arts = spark.createDataFrame([(1, target, "", text)], "arrival long, ticker string, title string, content string")
    k = spark.createDataFrame(keys, "key string, ticker string")
    return L.dictionary_scan(arts, k).first()["related"]


def test_scan_containment_and_boundaries(spark):
    assert _scan(spark, "victory", [("vic", "VIC")]) == ["VIC"]
    assert _scan(spark, "axb x", [("x", "X")]) == ["X"]
    assert _scan(spark, "axb", [("x", "X")]) == []
    assert _scan(spark, "vic", [("vic", "Z")]) == []  # the article's own ticker is excluded


def test_spans_merge(spark):
    toks = spark.createDataFrame([(1, 0, "A", "B-ORG"), (1, 1, "B", "B-ORG"), (1, 2, "c", "O"), (1, 3, "D", "I-PER")],
                                 "article_id long, pos int, word string, ner_tag string")
    got = sorted((r["start"], r["entity"]) for r in L.spans(toks).collect())
    assert got == [(0, "A B"), (3, "D")]


def test_valid_entity(spark):
    df = spark.createDataFrame([("ab",), ("12/2024",), ("Việt Nam",), ("Đầu tư X",), ("Vinamilk",)], "e string")
    assert [r["e"] for r in df.filter(L.valid_entity(F.col("e"))).collect()] == ["Vinamilk"]


def _resolve(spark, entity, target, names, aliases=()):
    pairs = spark.createDataFrame([(entity, target)], "entity string, target string")
    al = spark.createDataFrame(list(aliases) or [("zzz", "ZZZ")], "alias string, ticker string")
    return sorted((r["step"], r["ticker"]) for r in L.resolve(pairs, _names(spark, names), al).collect())


def test_cascade_rules(spark):
    assert _resolve(spark, "agribank", "BID", [("Agribank Bank", "AGB")], [("agribank", None)]) == []
    assert _resolve(spark, "Vinamilk", "VNM", [("Vinamilk", "VNM"), ("vinamilk", "XXX")]) == []
    long_names = [("Tập đoàn Vingroup Việt Nam", "VIC"), ("Tập đoàn Vingroup Việt", "VHM")]
    assert _resolve(spark, "Tập đoàn Vingroup Việt Nam Mới", "VIC", long_names) == [("substring", "VHM")]
    assert _resolve(spark, "Vingroupp", "BID", [("Tập đoàn Vingroup Việt Nam", "VIC")]) == []
    both = _resolve(spark, "FPT", "BID", [("FTP", "HPG"), ("Công ty FPT Telecom", "FPT")])
    assert ("direct", "FPT") in both


def _brute_best(entity, names, threshold=90):
    best = None
    for i, (n, t) in enumerate(names):
        s = L.token_sort_ratio_py(entity, n)
        if best is None or s > best[0]:
            best = (s, t)
    return best[1] if best and best[0] >= threshold else None


def test_fuzzy_matches_brute_force(spark):
    random.seed(7)
    alpha = "abcdeé "
    names = ["".join(random.choice(alpha) for _ in range(random.randint(5, 14))) for _ in range(60)]
    names = [(n, f"T{i % 9}") for i, n in enumerate(names)]
    ents = [n[0][:-1] + "x" for n in names[:20]] + [n[0] for n in names[20:30]] + ["zzzz zz"]
    e = spark.createDataFrame([(x,) for x in ents], "entity string")
    got = {r["entity"]: r["fuzzy_ticker"] for r in L.fuzzy_best(e, _names(spark, names)).collect()}
    for x in set(ents):
        assert got.get(x) == _brute_best(x, names), x


def test_relations_document(spark):
    linked = spark.createDataFrame([("BID", ["CTG", "VCB"]), ("BID", ["CTG"]), ("FPT", [])],
                                   "target string, related array<string>")
    targets = spark.createDataFrame([("BID",), ("FPT",), ("VNM",)], "target string")
    doc = {r["target"]: r for r in R.relations_document(R.related_counts(linked), targets).collect()}
    assert doc["BID"]["top_related"] == ["CTG", "VCB"] and doc["BID"]["stats"] == {"CTG": 2, "VCB": 1}
    assert doc["VNM"]["top_related"] == [] and doc["VNM"]["stats"] == {}


def test_contained_names_equal_all_pairs(spark):
    """The gram joins against every pair, on random names that often hold each other."""
    import random

    rng = random.Random(3)
    parts = ["Tap doan ", "Viet Nam ", "Ngan hang ", "Vin", "group", "Bank ", "Co phan "]
    name = lambda n: "".join(rng.choice(parts) for _ in range(n)).strip()
    names = [(k, name(rng.randint(2, 5)), f"T{k % 7}") for k in range(150)]
    pairs = list({(name(rng.randint(1, 6)), f"T{rng.randint(0, 7)}") for _ in range(200)})
    want = {}
    for e, t in pairs:
        for k, n, x in names:
            a, b = e.lower(), n.lower()
            if len(e) >= 10 and len(n) >= 15 and x != t and (a in b or b in a):
                want.setdefault((e, t), x)
    rest = spark.createDataFrame(pairs, "entity string, target string").withColumn("_el", F.lower("entity"))
    got = L.contained_names(rest, spark.createDataFrame(names, "ord long, name string, ticker string"))
    assert {(r["entity"], r["target"]): r["ticker"] for r in got.collect()} == want and len(want) > 20
    assert "NestedLoop" not in got._jdf.queryExecution().toString()


def test_scan_holds_pieces_of_a_batch():
    """A batch of any size is scanned in pieces; nulls have no keys but the empty one."""
    import pyarrow as pa

    n = 3 * L.SCAN_ROWS + 1
    texts = [None if i % 7 == 0 else f"Alpha {i} BETA" for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(["A" if i % 2 else None for i in range(n)]), pa.array(texts)], names=["doc", "target", "text"])
    out = list(L.scan_batches([batch, batch.slice(0, 0)], L.scan_partition([("alpha", "A"), ("beta", "B"), ("alpha 1", None)])))
    assert max(map(len, out)) <= L.SCAN_ROWS
    got = [r for b in out for r in b.column("related").to_pylist()]
    assert got == [[] if i % 7 == 0 else ["B"] if i % 2 else ["A", "B"] for i in range(n)]
