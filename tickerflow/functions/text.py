"""Scalar text functions (F1-F3, F13, F15, F16) as built-in Column expressions.

Whitespace is spelled out as one explicit class so Java regex (Spark) and RE2
(the DuckDB oracle) agree; it is the set Python's ``str.strip()`` / ``\\s`` use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode whitespace set of Python's str.isspace().
WS = ("[\\t\\n\\x{000B}\\f\\r \\x{001C}-\\x{001F}\\x{0085}\\x{00A0}\\x{1680}"
      "\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")
# The same set as literal characters, for btrim / translate (no regex engine).
WS_CODES = [0x9, 0xA, 0xB, 0xC, 0xD, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
            *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WS_CHARS = "".join(chr(c) for c in WS_CODES)
STRIP_RE = f"^{WS}+|{WS}+$"
WS_RUN_RE = f"{WS}+"
CONTROL_RUN_RE = "[\\n\\r\\t]+"
TITLE_WORDS = 15
JSON_BLOCK_RE = "(?s)\\{.*\\}"


def ustrip(c: Column) -> Column:
    """Python ``str.strip()`` (F1); Spark ``trim`` removes spaces only. ``btrim`` with
    the literal whitespace set touches only the two ends of the text."""
    return F.btrim(c, F.lit(WS_CHARS))


def collapse_ws(c: Column) -> Column:
    """``[\\n\\r\\t]+`` → space, then any whitespace run → one space, then strip (F2).

    The first step is subsumed by the second (its characters are whitespace and
    its replacement is one space), so: map every whitespace character to a space
    with ``translate``, squeeze space runs, trim spaces. No Unicode class is
    tested per character, which keeps this a linear pass over whole texts.
    """
    spaced = F.translate(c, WS_CHARS, " " * len(WS_CHARS))
    return F.btrim(F.regexp_replace(spaced, " {2,}", " "), F.lit(" "))


def first_words(c: Column, n: int = TITLE_WORDS) -> Column:
    """First ``n`` whitespace-separated words joined by one space."""
    words = F.split(ustrip(c), WS_RUN_RE)
    return F.array_join(F.slice(words, 1, n), " ")


def title_fallback(title: Column, content: Column, n: int = TITLE_WORDS) -> Column:
    """Empty title and non-empty content → first ``n`` words + '...' (F3)."""
    return F.when((title == "") & (content != ""), F.concat(first_words(content, n), F.lit("..."))).otherwise(title)


def article_text(title: Column, content: Column) -> Column:
    """``title + '. ' + content`` (F13); NULL parts count as empty."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(". "), F.coalesce(content, F.lit("")))


def join_tickers(arr: Column) -> Column:
    """Comma-joined ticker list."""
    return F.array_join(arr, ",")


def json_block(c: Column) -> Column:
    """Greedy first ``{`` ... last ``}`` across lines (F16); NULL when there is none."""
    m = F.regexp_extract(c, JSON_BLOCK_RE, 0)
    return F.when(m != "", m)


def json_block_or_text(c: Column) -> Column:
    """The variant that falls back to the whole text when no braces are found."""
    return F.coalesce(json_block(c), c)
