"""Date extraction and parsing (F4-F10) with try_* built-ins (ANSI mode stays on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ustrip

# Patterns and formats of the reference's date handling.
URL_DATE_RE = "(20[1-2]\\d)(\\d{2})(\\d{2})"
COMMON_DATE_RE = "(\\d{1,2}[-/]\\d{1,2}[-/]\\d{4})"
VNEXPRESS_FORMATS = ["d/M/yyyy, H:m", "d/M/yyyy H:m", "d/M/yyyy", "d/M/yyyy, H:m:s", "d/M/yyyy H:m:s"]
TWO_DIGIT_RE = "^(\\d{1,2})/(\\d{1,2})/(\\d{2})$"


def url_date(url: Column) -> Column:
    """``extract_date_from_url`` (F4): the first ``20[1-2]d dd dd`` run; month 1-12 and
    day 1-31 give ``yyyy-mm-dd`` text, anything else NULL (no second attempt)."""
    y = F.regexp_extract(url, URL_DATE_RE, 1)
    m = F.regexp_extract(url, URL_DATE_RE, 2)
    d = F.regexp_extract(url, URL_DATE_RE, 3)
    ok = (y != "") & m.try_cast("int").between(1, 12) & d.try_cast("int").between(1, 31)
    return F.when(ok, F.concat_ws("-", y, m, d))


def parse_common(s: Column) -> Column:
    """``parse_date_common`` (F5): first ``d-m-yyyy`` / ``d/m/yyyy``, day first."""
    m = F.regexp_extract(s, COMMON_DATE_RE, 1)
    return F.try_to_date(F.when(m != "", F.regexp_replace(m, "-", "/")), "d/M/yyyy")


def parse_vnexpress(s: Column) -> Column:
    """``parse_vnexpress_date`` (F6): NBSP → space, drop the text up to the first comma,
    cut at '(', then try five day-first formats in order (timestamp)."""
    t = ustrip(F.regexp_replace(s, "\u00a0", " "))
    t = F.when(F.instr(t, ",") > 0, ustrip(F.regexp_replace(t, "^[^,]*,", ""))).otherwise(t)
    t = F.when(F.instr(t, "(") > 0, ustrip(F.substring_index(t, "(", 1))).otherwise(t)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in VNEXPRESS_FORMATS])


def parse_iso_local(s: Column) -> Column:
    """ISO timestamp → its local calendar date (F7); an offset does not move the day."""
    return F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd")


def parse_two_digit_year(s: Column) -> Column:
    """First token as ``%d/%m/%y`` (F8); 00-68 → 20xx, 69-99 → 19xx like strptime."""
    tok = F.split(F.trim(s), "\\s+").getItem(0)
    d = F.regexp_extract(tok, TWO_DIGIT_RE, 1)
    m = F.regexp_extract(tok, TWO_DIGIT_RE, 2)
    yy = F.regexp_extract(tok, TWO_DIGIT_RE, 3)
    yi = yy.try_cast("int")
    year = F.when(yi < 69, yi + 2000).otherwise(yi + 1900)
    return F.try_to_date(F.when(d != "", F.concat_ws("-", year.cast("string"), m, d)), "yyyy-M-d")


def parse_day(s: Column) -> Column:
    """``to_datetime(errors='coerce')`` on ``yyyy-mm-dd`` text."""
    return F.try_to_date(s, "yyyy-MM-dd")
