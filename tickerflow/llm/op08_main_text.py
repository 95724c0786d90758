"""Main text of web pages, by structure and by a suffix array over the pages of a host.

The mark-up gives each piece of text a role: inside an article (``article``, ``main`` or an element
whose role, id or class says so), boilerplate (menus, headers, footers, sidebars, notices,
adverts, forms, comments, scripts, hidden elements), or open. The candidate of a page is the text of its article or,
without one, its open text. The candidates of all pages of a host go through suffix arrays, which tell for each run of
``RUN`` tokens whether distinct pages of the host hold it. What is then done with a repeated run rests on its role:

* In open text it goes if another page has it in its open text: there, nothing but repetition tells menus from text.
* In a doubtful element of an article (some parts of its name are boilerplate words, others aren't: "search-hints")
  it goes with the element, if the runs cover all of it and less than half of the article around it. An article that is
  mostly repeated is a copy, and tells nothing about its elements.
* Elsewhere in an article it stays and is counted (``n_repeated``): pages of one host often quote or copy whole
  paragraphs, and these belong to the text.

The candidates of a host are not gathered in one task. Each run of ``RUN`` tokens has an anchor (the least
hash among the short runs in it), equal runs have equal anchors, and a suffix array is built for the distinct
stretches of each host and anchor. Anchors of one page only can't match: those of two or more go into a Bloom filter of
bounded size. Anchors of very many different stretches are cut further, into their runs.
"""

from __future__ import annotations

import hashlib
import html
import re
from functools import lru_cache, partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import bounded_broadcast
from ..session import ship_package
from .op02_substrings import _anchors, _batch, _bloom, _passing, _windows
from .tables import Scratch, written
from .words import SPACE_SPLIT, blocks, slices

RUN, ANCHOR = 8, 3
#: Stretches of a host and anchor beyond which they are cut into runs.
MAX_SHARD = 500
#: Keys packed at a time.
PACK = 200_000
#: Bits of a key of a host and anchor, and those of them that are kept inside a bucket.
KEY_BITS, LOW_BITS = 40, 28
#: Kinds of a page's candidate text.
ARTICLE_TEXT, DOUBTFUL_TEXT, OPEN_TEXT = 0, 1, 2

# Names of HTML elements.
RAW = "script style noscript template svg math textarea select iframe object title audio video canvas button".split()
BOILERPLATE = "head nav footer aside form menu dialog".split()
ARTICLE = "article main".split()
CONTAINERS = "html body div section header hgroup ul ol li dl dt dd table tbody thead tfoot tr td th blockquote figure figcaption details summary fieldset center address pre h1 h2 h3 h4 h5 h6 p".split()
BREAKS = "br hr option legend caption".split()

# Words of id, class and role that tell a role. A name is bad if all its parts (between hyphens) are bad or neutral words and one
# is bad: "social-share" and "comment-list" are, "share-price" and "legal-history" aren't.
_BAD = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promos promotion promotions cookie cookies consent gdpr notice notices alert popup modal overlay paywall newsletter subscribe subscription signup login search"
    " nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar aside footer header masthead topbar toolbar contentinfo complementary comment comments commentlist disqus replies respond reactions discussion"
    " related recommended recommendations widget widgets share sharing social copyright disclaimer legal hidden side-bar skip-link".split()
)
_NEUTRAL = set("box block list item items link links bar area section wrapper wrap container inner outer content body group row col panel unit slot top bottom left right main site page post form button buttons icon icons text title new old primary secondary global mobile desktop fixed sticky".split())
_GOOD = re.compile(r"(?<![a-z])(?:article|article-?body|articlebody|post-?(?:body|content|text)|entry-?(?:body|content|text)?|story(?:-?body)?|main|main-?content|page-?content|content)(?![a-z])")
#: Never dropped for their names.
_TEXTUAL = set("h1 h2 h3 h4 h5 h6 p pre blockquote".split())
#: The start of a tag, comment or declaration; a tag without quotes as a whole.
_OPEN = re.compile(r"""<(?:(/?)([a-zA-Z][^\s/>"'<]*)([^>"'<]*)>|(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))""")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(id|class|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_ELEMENTS = {n: "raw" for n in RAW} | {n: "bad" for n in BOILERPLATE} | {n: "good" for n in ARTICLE} | {n: "" for n in CONTAINERS} | {n: "break" for n in BREAKS}


def _next_tag(page: str, at: int, last: int) -> tuple[int, int, bool, str, str, bool] | None:
    """(start, end, is an end tag, name, attributes, closed) of the next tag; comments and declarations have no name.

    ``last`` is the page's last ``>``. A quoted value may hold ``>``; a quote that isn't closed before ``last`` is an
    ordinary character. A tag or declaration that the page's end cuts off takes the rest. Each character is passed once.
    """
    m = _OPEN.search(page, at)
    if m is None:
        return None
    if m[2]:
        attributes = m[3]
        closed = attributes.endswith("/")
        return m.start(), m.end(), bool(m[1]), m[2].lower(), attributes[:-1] if closed else attributes, closed
    if m[4] or m[5]:
        mark = "-->" if m[4] else ">"
        end = page.find(mark, m.end())
        return m.start(), len(page) if end < 0 else end + len(mark), False, "", "", False
    i = m.end()
    while (stop := _STOP.search(page, i)) and stop[0] != ">":
        close = page.find(stop[0], stop.end())
        i = close + 1 if 0 <= close < last else stop.end()
    if stop is None:
        return m.start(), len(page), False, "", "", False
    attributes = page[m.end() : stop.start()]
    closed = attributes.endswith("/")
    return m.start(), stop.end(), bool(m[6]), m[7].lower(), attributes[:-1] if closed else attributes, closed


def _is_bad(said: str, inside: bool) -> bool:
    for token in said.split():
        parts = [token] if token in _BAD else token.split("-")
        own = [p for p in parts if p in _BAD and not (inside and p == "header")]
        if own and all(p in _BAD or p in _NEUTRAL or not p.strip("0123456789") for p in parts):
            return True
    return False


@lru_cache(1 << 14)
def _role(name: str, attributes: str, inside: bool) -> str:
    """bad, good, doubt or empty, of an element."""
    kind = _ELEMENTS[name]
    if kind == "bad":
        return "bad"
    words = []
    for key, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return "bad"
        if key in ("id", "class", "role", "itemprop"):
            words.append(value)
    said = re.sub(r"(?<![a-z])(?:has|with|without|no)-[a-z-]+", "", " ".join(words).replace("_", "-"))
    if name == "header":
        return "" if inside else "bad"
    if name in ("html", "body"):
        return ""
    bad = name not in _TEXTUAL and _is_bad(said, inside)
    if kind != "good" and _GOOD.search(said) and not bad:
        return "good"
    return "bad" if bad else kind or ("doubt" if inside and name not in _TEXTUAL and any(p in _BAD for p in re.split(r"[\s-]+", said)) else "")


def split_page(page: str) -> tuple[str | None, str]:
    """Text of the articles of a page (None without an article) and its open text; white space as single spaces."""
    return read_page(page)[:2]


def read_page(page: str) -> tuple[str | None, str, list[tuple[int, int]]]:
    """The two texts of ``split_page`` and the doubtful elements of the articles, as ranges of tokens [from, to)."""
    article, other, found = [], [], False
    stack: list[tuple[str, str]] = []
    bad = good = doubt = 0
    pieces: list[list[int]] = []  # the doubtful elements, as ranges of ``article``
    at, end, last_tag = 0, len(page), page.rfind(">")

    def put(piece: str) -> None:
        if not bad and piece:
            (article if good else other).append(piece)

    def leave() -> str:
        nonlocal bad, good, doubt
        name, role = stack.pop()
        bad -= role == "bad"
        good -= role == "good"
        doubt -= role == "doubt"
        if role == "doubt" and not doubt and not bad and pieces and len(pieces[-1]) == 1:
            pieces[-1].append(len(article))
        return name

    while at < end:
        tag = _next_tag(page, at, last_tag)
        if tag is None:
            put(html.unescape(page[at:]))
            break
        start, after, ends, name, attributes, closed = tag
        if start > at:
            put(html.unescape(page[at:start]))
        at = after
        kind = _ELEMENTS.get(name)
        if kind is None:
            continue
        put(" ")
        if kind == "break":
            continue
        if kind == "raw":
            if not ends and not closed:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = close.end() if close else end if name in ("script", "style", "textarea", "title") else at
            continue
        if ends:
            if any(n == name for n, _ in stack):
                while leave() != name:
                    pass
        elif not closed:
            if name in ("p", "li", "td", "th", "tr", "dt", "dd") and stack and stack[-1][0] == name:  # the end tag is left out
                leave()
            role = _role(name, attributes, good > 0)
            if role == "doubt" and not doubt and not bad:
                pieces.append([len(article)])
            stack.append((name, role))
            bad += role == "bad"
            good += role == "good"
            doubt += role == "doubt"
            found |= role == "good" and not bad
    spans = [tuple(len("".join(article[:k]).split()) for k in (*p, len(article))[:2]) for p in pieces]
    return " ".join("".join(article).split()) if found else None, " ".join("".join(other).split()), [x for x in spans if x[0] < x[1]]


def _key(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode(errors="replace"), digest_size=8).digest(), "little", signed=True)


_PARSED = {"host": pa.string(), "stream": pa.int64(), "kind": pa.int32(), "candidate": pa.string(), "doubtful": pa.list_(pa.int32())}


def _parse(batches):
    """Pages with their candidates; ``stream`` names the host and the candidate, ``doubtful`` lists both ends of each element."""
    for part in slices(batches):
        rows = []
        for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
            article, other, doubtful = read_page(page or "")
            kind = OPEN_TEXT if article is None else DOUBTFUL_TEXT if doubtful else ARTICLE_TEXT
            text = other if article is None else article
            rows.append((host, _key(host, text), kind, text, [x for d in doubtful for x in d] if kind == DOUBTFUL_TEXT else None))
        yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), *_batch(rows, _PARSED).columns], names=["page_id", "url", *_PARSED])


def _keyed(batch, run: int, anchor: int):
    """(block, key of host and anchor, first run, last run, document) of the stretches of parsed pages."""
    hosts = np.array([_key(h) for h in batch.column("host").to_pylist()], np.int64).view(np.uint64)
    for b in blocks(batch.column("candidate"), SPACE_SPLIT):
        key, first, last, doc = _anchors(b, run, anchor)
        yield b, key ^ hosts[doc + b.first], first, last, doc


def _packed(keys: list[np.ndarray]) -> pa.RecordBatch:
    """(bucket, low): the keys, sorted, by their high bits."""
    key = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    bucket = (key >> np.uint64(LOW_BITS)).astype(np.int32)
    new = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(key) else np.zeros(0, np.int64)
    low = pa.array((key & np.uint64((1 << LOW_BITS) - 1)).astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(bucket[new]), pa.ListArray.from_arrays(pa.array(np.r_[new, len(key)].astype(np.int32)), low)], names=["bucket", "low"])


def _emit_keys(batches, run: int, anchor: int):
    """The keys of each page, once each."""
    held, n = [], 0
    for batch in _parse(batches):
        for _, key, _, _, doc in _keyed(batch, run, anchor):
            key = key >> np.uint64(64 - KEY_BITS)
            order = np.lexsort((key, doc))
            key, doc = key[order], doc[order]
            held.append(key[np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]] if len(key) else key)
            n += len(held[-1])
            if n >= PACK:
                yield _packed(held)
                held, n = [], 0
    yield _packed(held)


def _key_filter(pages: DataFrame, run: int, anchor: int) -> np.ndarray:
    """Bloom filter of the keys that two pages or more have. Keys that share their high bits go through the shuffle as one row."""
    packed = pages.mapInArrow(partial(_emit_keys, run=run, anchor=anchor), "bucket int, low array<int>").repartition("bucket")
    counts = packed.select("bucket", F.explode("low").alias("low")).groupBy("bucket", "low").agg(F.count("low").alias("n")).where("n > 1")
    return _bloom(written(counts.select((F.shiftleft(F.col("bucket").cast("long"), LOW_BITS) + F.col("low")).alias("anchor")), "page-anchors"))


_STRETCH = {"anchor": pa.int64(), "words": pa.binary(), "stream": pa.int64(), "kind": pa.int32(), "at": pa.int32()}


def _stretches(batches, shared_filter: Broadcast, run: int, anchor: int):
    """Of each candidate the stretches of runs with one anchor (of the host) that pass the filter, with their places."""
    bits = shared_filter.value
    for batch in _parse(batches):
        stream, kind, out = batch.column("stream").to_pylist(), batch.column("kind").to_pylist(), []
        for b, key, first, last, doc in _keyed(batch, run, anchor):
            keep = _passing(key >> np.uint64(64 - KEY_BITS), bits)
            raw, key, first, last, doc = b.data.tobytes(), key[keep].view(np.int64), first[keep], last[keep], doc[keep]
            for k, x, y, i, d in zip(key.tolist(), b.starts[first].tolist(), b.ends[last + run - 1].tolist(), (first - b.bounds[doc]).tolist(), (doc + b.first).tolist()):
                out.append((k, b" ".join(raw[x:y].split()), stream[d], kind[d], i))
        yield _batch(out, _STRETCH)


def _cut_runs(batches, run: int):
    """The references as their single runs, each with its place."""
    for batch in batches:
        names = ("anchor", "words", "lo", "hi", "open_lo", "open_hi")
        rows = zip(*(batch.column(n).to_pylist() for n in names))
        kinds = {"anchor": pa.int64(), "words": pa.binary(), "one": pa.binary(), "i": pa.int32()} | {n: pa.int64() for n in names[2:]}
        yield _batch([(k, words, w, i, *ends) for k, words, *ends in rows for i, w in enumerate(_windows(words, run))], kinds)


def repeated_runs(texts: list[list], pages: list[tuple], run: int) -> list[list[bool]]:
    """For each run of ``run`` tokens of each text: whether two distinct pages hold it.

    The suffix array of all texts puts the suffixes that share their first tokens side by side. pages: for
    each text the least and the greatest page that has it.
    """
    suffixes = sorted((tuple(t[i : i + run]), k, i) for k, t in enumerate(texts) for i in range(len(t) - run + 1))
    out = [[False] * max(0, len(t) - run + 1) for t in texts]
    for _, own in groupby(suffixes, lambda s: s[0]):
        own = list(own)
        if min(pages[k][0] for _, k, _ in own) != max(pages[k][1] for _, k, _ in own):
            for _, k, i in own:
                out[k][i] = True
    return out


def _emit_repeated(batches, run: int):
    """(anchor, words, runs that distinct pages hold, runs that distinct open texts hold); rows sorted by anchor."""
    names = ("anchor", "words", "lo", "hi", "open_lo", "open_hi")
    rows = (r for batch in batches for r in zip(*(batch.column(n).to_pylist() for n in names)))
    kinds = {"anchor": pa.int64(), "words": pa.binary(), "repeated": pa.list_(pa.int32()), "open_repeated": pa.list_(pa.int32())}
    out = []
    for key, own in groupby(rows, lambda r: r[0]):
        own = list(own)
        if len(own) == 1 and own[0][2] == own[0][3]:  # one page's
            continue
        places = []
        for low, high in ((2, 3), (4, 5)):
            held = [r for r in own if r[low] is not None]
            if len(held) == 1:
                r = held[0]
                places.append([list(range(r[1].count(b" ") + 2 - run)) if x is r and r[low] != r[high] else [] for x in own])
                continue
            flags = repeated_runs([r[1].split(b" ") for r in held], [(r[low], r[high]) for r in held], run)
            of = {r[1]: [i for i, x in enumerate(f) if x] for r, f in zip(held, flags)}
            places.append([of.get(r[1], []) for r in own])
        out += [(key, r[1], x, y) for r, x, y in zip(own, *places) if x or y]
        if len(out) > 20_000:
            yield _batch(out, kinds)
            out = []
    yield _batch(out, kinds)


def _verdict(batches, run: int):
    """Texts and numbers of repeated tokens of the pages, by the roles of their repeated runs."""
    for batch in batches:
        texts = batch.column("candidate").to_pylist()
        for d, (text, kind, doubtful, starts) in enumerate(zip(texts, *(batch.column(n).to_pylist() for n in ("kind", "doubtful", "starts")))):
            if not starts or kind == ARTICLE_TEXT:
                continue
            words = text.split(" ")
            gone = np.zeros(len(words), bool)
            for s in starts:
                gone[s : s + run] = True
            if kind == DOUBTFUL_TEXT:
                pieces = [(x, y) for x, y in zip(doubtful[::2], doubtful[1::2])]
                sure = np.ones(len(words), bool)
                for x, y in pieces:
                    sure[x:y] = False
                copied = 2 * (gone & sure).sum() >= sure.sum()
                whole = [] if copied else [(x, y) for x, y in pieces if gone[x:y].all()]
                gone[:] = False
                for x, y in whole:
                    gone[x:y] = True
            texts[d] = " ".join(w for w, g in zip(words, gone.tolist()) if not g)
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), batch.column("n_repeated")], names=["page_id", "url", "text", "n_repeated"])


def main_text(pages: DataFrame, run: int = RUN, anchor: int = ANCHOR, max_shard: int = MAX_SHARD) -> DataFrame:
    """(page_id, url, text, n_repeated), one row for each row of ``pages`` (page_id, url, html).

    White space runs are one space, blocks are joined by one space, character references are decoded. Null or
    empty html, and pages without text, give the empty text. Every page goes through the suffix arrays of its host;
    ``n_repeated`` (long) counts the tokens of its candidate in runs that another page of the host repeats. Pages without a
    marked article lose the runs that the open text of another page repeats (and count only these), articles lose repeated
    doubtful elements and nothing else. Pages of a host with the same candidate count as
    one page, so repeated rows don't empty each other. The host is what stands between ``//`` and the next
    ``/``, ``?`` or ``#`` of the url, lower-cased; a null url is a host of its own. Other columns aren't read.
    """
    spark = pages.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"//([^/?#]*)", 1))
    rows = pages.select("page_id", "url", host.alias("host"), "html")
    size = {"run": run, "anchor": anchor}
    passing = spark.sparkContext.broadcast(_key_filter(rows, **size))
    kinds = "anchor long, words binary, stream long, kind int, at int"
    found = scratch(rows.mapInArrow(partial(_stretches, shared_filter=passing, **size), kinds), "stretches", compression="zstd")
    many = found.groupBy("anchor").agg(F.count("at").alias("n"), F.min(F.xxhash64("words")).alias("x"), F.max(F.xxhash64("words")).alias("y"))
    many = bounded_broadcast(scratch(many.where((F.col("n") > max_shard) & (F.col("x") != F.col("y"))).select("anchor"), "cut-anchors"))
    open_stream = F.when(F.col("kind") == OPEN_TEXT, F.col("stream"))
    ends = [F.min("stream").alias("lo"), F.max("stream").alias("hi"), F.min(open_stream).alias("open_lo"), F.max(open_stream).alias("open_hi")]
    refs = lambda d: d.select("anchor", "words", "stream", "kind").repartition("anchor").groupBy("anchor", "words").agg(*ends)
    whole = refs(found.join(many, "anchor", "left_anti")).sortWithinPartitions("anchor", "words")
    repeated = whole.mapInArrow(partial(_emit_repeated, run=run), "anchor long, words binary, repeated array<int>, open_repeated array<int>")
    heavy = found.join(many, "anchor", "left_semi").groupBy("anchor", "words").agg(*ends)
    runs = scratch(heavy.mapInArrow(partial(_cut_runs, run=run), "anchor long, words binary, one binary, i int, lo long, hi long, open_lo long, open_hi long"), "single-runs")
    sums = runs.groupBy("anchor", "one").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("open_lo").alias("open_lo"), F.max("open_hi").alias("open_hi")).where("lo <> hi")
    places = lambda at: F.collect_list(F.when(at, F.col("i")))
    single = runs.select("anchor", "words", "one", "i").join(sums, ["anchor", "one"]).groupBy("anchor", "words").agg(places(F.col("lo") != F.col("hi")).alias("repeated"), places(F.col("open_lo") != F.col("open_hi")).alias("open_repeated"))
    piece = F.unhex(F.md5(F.concat(F.col("anchor").cast("string").cast("binary"), "words"))).alias("piece")
    members = found.select(piece, "stream", "kind", "at").join(repeated.unionByName(single).select(piece, "repeated", "open_repeated"), "piece")
    own = F.when(F.col("kind") == OPEN_TEXT, F.col("open_repeated")).otherwise(F.col("repeated"))
    members = members.select("stream", "kind", F.transform(own, lambda i: F.col("at") + i).alias("starts")).where(F.size("starts") > 0)
    members = members.groupBy("stream", "kind").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("starts")))).alias("starts"))  # one candidate's runs; copies of it add none
    covered = F.expr(f"aggregate(zip_with(slice(starts, 1, size(starts) - 1), slice(starts, 2, size(starts) - 1), (x, y) -> least({run}, y - x)), {run}, (x, y) -> x + y)")
    flags = written(members.select("stream", "kind", covered.cast("long").alias("n_repeated"), F.when(F.col("kind") != ARTICLE_TEXT, F.col("starts")).alias("starts")), "repeated-runs")
    scratch.clear()
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string"
    parsed = rows.mapInArrow(_parse, f"{schema}, host string, stream long, kind int, candidate string, doubtful array<int>")
    judged = parsed.join(bounded_broadcast(flags), ["stream", "kind"], "left").withColumn("n_repeated", F.coalesce("n_repeated", F.lit(0).cast("long")))
    return judged.mapInArrow(partial(_verdict, run=run), f"{schema}, text string, n_repeated long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page of the table."""
    texts = main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")
