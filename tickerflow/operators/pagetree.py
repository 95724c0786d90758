"""Element trees of stored pages, as interval numbers, and selectors as conditions on intervals.

A linear pass over a page numbers its start tags and text nodes in page order. An element is the
interval (open, close] of the numbers inside it, so that "inside" is a comparison of numbers: selectors, the
removal of sub-trees and the text of an element are filters over two arrays of the page's row, and run in
Spark without further Python. One page stays one row; nothing is shuffled.

The tree is that of a tolerant parser without implied end tags: an end tag closes everything up to its
start tag, one without a start tag is ignored, and what is left open ends with its parent.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements without content; elements whose text isn't shown; elements whose content isn't markup.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HIDDEN = {"script", "style", "template", "rt", "rp"}
RAW = {"script", "style"}

_START = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)|))?""")
_END = re.compile(r"[\s/]*>")
_SPACES = " \n\t\f\r"

_ELEMENT = pa.struct([("open", pa.int32()), ("close", pa.int32()), ("parent", pa.int32()), ("tag", pa.string()),
                      ("classes", pa.list_(pa.string())), ("attrs", pa.map_(pa.string(), pa.string()))])
_TEXT = pa.struct([("pos", pa.int32()), ("text", pa.string())])
ELEMENTS = "array<struct<open: int, close: int, parent: int, tag: string, classes: array<string>, attrs: map<string, string>>>"
TEXTS = "array<struct<pos: int, text: string>>"


def _tags(html: str) -> Iterator[tuple[str, str, dict[str, str], bool]]:
    """(kind, name or text, attributes, closed) of a page: kinds text, start, end and comment (which parts two
    texts). Every character is looked at a bounded number of times; a tag that the page's end cuts off is dropped."""
    at, n = 0, len(html)
    while at < n:
        low = html.find("<", at)
        if low < 0:
            yield "text", html[at:], {}, False
            return
        if low > at:
            yield "text", html[at:low], {}, False
        if html.startswith("<!--", low):
            end = html.find("-->", low + 4)
            at = n if end < 0 else end + 3
            yield "comment", "", {}, False
        elif html.startswith(("<!", "<?"), low):
            end = html.find(">", low)
            at = n if end < 0 else end + 1
            yield "comment", "", {}, False
        elif start := _START.match(html, low):
            at, attrs = start.end(), {}
            while not (end := _END.match(html, at)):
                found = _ATTRIBUTE.match(html, at)
                if found:
                    attrs[found[1].lower()] = unescape(found[2] or found[3] or found[4] or "")
                    at = found.end()
                elif at < n:
                    at += 1
                else:
                    return
            name, at = start[2].lower(), end.end()
            yield ("end" if start[1] else "start"), name, attrs, "/" in end[0]
            if name in RAW and not start[1]:
                end = re.compile(f"</{name}", re.I).search(html, at)
                at = end.start() if end else n
        else:
            yield "text", "<", {}, False
            at = low + 1


def tree(html: str | None) -> tuple[list[dict], list[dict]]:
    """The elements and text nodes of a page, both in page order. Blank text nodes keep one newline or one space."""
    elements, texts, stack, held = [], [], [], []
    count = 0

    def flush():
        nonlocal count
        text = "".join(held)
        held.clear()
        if not text or any(e["tag"] in HIDDEN for e in stack):
            return
        if not text.strip(_SPACES) and not any(e["tag"] in ("pre", "textarea") for e in stack):
            text = "\n" if "\n" in text else " "
        count += 1
        texts.append({"pos": count, "text": text})

    def close(e):
        e["close"] = count

    for kind, name, attrs, closed in _tags(html or ""):
        if kind == "text":
            held.append(unescape(name))
            continue
        flush()
        if kind == "start":
            count += 1
            e = {"open": count, "close": count, "parent": stack[-1]["open"] if stack else 0, "tag": name, "classes": attrs.get("class", "").split(), "attrs": list(attrs.items())}
            elements.append(e)
            if not closed and name not in VOID:
                stack.append(e)
        elif kind == "end" and any(e["tag"] == name for e in stack):
            while stack[-1]["tag"] != name:
                close(stack.pop())
            close(stack.pop())
    flush()
    while stack:
        close(stack.pop())
    return elements, texts


def with_tree(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``elements`` and ``texts`` in place of ``html``. A null page has no elements."""
    from ..session import ship_package

    ship_package(pages.sparkSession)
    rest = [c for c in pages.columns if c not in (html, "elements", "texts")]
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in rest) + f"{', ' if rest else ''}elements {ELEMENTS}, texts {TEXTS}"

    def build(batches):
        for batch in batches:
            for low in range(0, len(batch), 64):  # bounds the Python objects held at once
                part = batch.slice(low, 64)
                trees = [tree(x) for x in part.column(html).to_pylist()]
                own = [pa.array([t[0] for t in trees], pa.list_(_ELEMENT)), pa.array([t[1] for t in trees], pa.list_(_TEXT))]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in rest] + own, names=[*rest, "elements", "texts"])

    return pages.select(*rest, html).mapInArrow(build, schema)


# ---------------------------------------------------------------- selectors

_PART = re.compile(r"([.#]?)([\w-]+)|\[([\w-]+)(?:='([^']*)')?\]")


def _matches(e: Column, compound: str) -> Column:
    """``tag.class#id[attribute][attribute='value']``."""
    out = F.lit(True)
    for found in _PART.finditer(compound):
        kind, name, attribute, value = found.groups()
        if attribute:
            out = out & (e["attrs"][attribute].isNotNull() if value is None else F.coalesce(e["attrs"][attribute] == value, F.lit(False)))
        elif kind == ".":
            out = out & F.array_contains(e["classes"], name)
        elif kind == "#":
            out = out & F.coalesce(e["attrs"]["id"] == name, F.lit(False))
        else:
            out = out & (e["tag"] == name)
    return out


def inside(x: Column, a: Column) -> Column:
    """Whether the element or text node at number ``x`` is inside the element ``a``."""
    return (x > a["open"]) & (x <= a["close"])


def select(elements: Column, selector: str) -> Column:
    """The elements that a selector names, in page order: compounds, descendants (by spaces), lists (by commas)."""

    def named(e: Column) -> Column:
        out = F.lit(False)
        for path in selector.split(","):
            *above, last = path.split()
            own = _matches(e, last)
            if above:
                own = own & F.exists(select(elements, " ".join(above)), lambda a: inside(e["open"], a))
            out = out | own
        return out

    return F.filter(elements, named)


def select_in(elements: Column, selector: str, a: Column) -> Column:
    """Those inside the element ``a``."""
    return F.filter(select(elements, selector), lambda e: inside(e["open"], a))


def first(found: Column) -> Column:
    return F.get(found, F.lit(0))


def text(texts: Column, a: Column, separator: str = "", removed: Column | None = None) -> Column:
    """The text nodes inside ``a``, but for those inside one of the elements ``removed``, joined. NULL without ``a``."""

    def own(t: Column) -> Column:
        out = inside(t["pos"], a)
        return out if removed is None else out & ~F.exists(removed, lambda r: inside(t["pos"], r))

    return F.when(a.isNotNull(), F.array_join(F.transform(F.filter(texts, own), lambda t: t["text"]), separator))
