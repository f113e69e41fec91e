"""Column functions over text: whitespace, multi-values, years, slugs, URLs, numbers."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space of ECMAScript's \s other than the blank. Java's \s is ASCII only.
OTHER_SPACE = "\t\n\x0b\f\r\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"

# Bounds of a plausible ruling year, and the longest slug.
FIRST_YEAR, LAST_YEAR = 1900, 2100
MAX_SLUG = 80

# How a ruling carries its year, and how a servlet container writes a session id into a path.
RULING_YEAR = r"-\s*(\d{4})(?!\d)"
SESSION_TO_DROP = "(?i);jsessionid=[^?/;]*"
SESSION_TO_MASK = r"(?i);jsessionid=[^?#/\s]*"


def _runs(other: str) -> str:
    """Runs of white space that change: of two and more, and single ones that are no blank.

    A printable ASCII character is told from them by one range. Asking for each white space there took most of the time.
    """
    return f" (?=[^!-~])[ {other}]+|[^ -~](?<=[{other}])[ {other}]*"


def normalize_ws(text: Column) -> Column:
    """Collapse every run of white space to one blank and trim the ends.

    A lone blank stays as it is, so the pattern matches only runs that change: replacing
    each blank by itself took most of the time.
    """
    return F.trim(F.regexp_replace(text, _runs(OTHER_SPACE), " "))


def split_multivalue(cell: Column) -> Column:
    """Values of a multi-valued cell: one per line, normalised, blank ones dropped.

    Runs are collapsed in the whole cell at once, but for the line breaks, which the split needs.
    """
    collapsed = F.regexp_replace(cell, _runs(OTHER_SPACE.replace("\n", "")), " ")
    return F.filter(F.transform(F.split(collapsed, "\n"), lambda v: F.trim(v)), lambda v: v != "")


def ruling_year(ruling: Column) -> Column:
    """First four-digit group after a dash that is a plausible year, else NULL."""
    years = F.transform(
        F.regexp_extract_all(ruling, F.lit(RULING_YEAR), F.lit(1)), lambda y: y.cast("int")
    )
    return F.get(F.filter(years, lambda y: y.between(FIRST_YEAR, LAST_YEAR)), F.lit(0))


@cache
def _accent_table() -> tuple[str, str]:
    """Arguments of ``translate`` that take letters to their unaccented ASCII base.

    Built from Unicode's canonical decompositions, so the accent step stays in the JVM.
    Marks have no counterpart and are therefore deleted. A character that decomposes to
    nothing ASCII is left out: the slug turns it into a dash in any case.
    """
    base, marks = {}, [chr(c) for c in range(0x0300, 0x0370)]
    for code in range(0x80, 0x10000):
        char = chr(code)
        bare = "".join(c for c in unicodedata.normalize("NFD", char) if not "\u0300" <= c <= "\u036f")
        if len(bare) == 1 and bare != char and bare.isascii() and bare.isalnum():
            base[char] = bare
    return "".join(base) + "".join(marks), "".join(base.values())


def slug(text: Column, max_length: int = MAX_SLUG) -> Column:
    """File-name-safe form: no accents, lower case, dashes for everything else."""
    bare = F.lower(F.translate(text, *_accent_table()))
    dashed = F.regexp_replace(F.regexp_replace(bare, "[^a-z0-9]+", "-"), "^-+", "")
    return F.regexp_replace(F.substring(dashed, 1, max_length), "-+$", "")


def strip_session_url(url: Column) -> Column:
    """Drop the session id that a servlet container writes into a path."""
    return F.regexp_replace(url, SESSION_TO_DROP, "")


def redact_url(url: Column) -> Column:
    """Mask the session id in a URL, keeping the fact that there was one."""
    return F.regexp_replace(url, SESSION_TO_MASK, ";jsessionid=REDACTED")


def redact_cookies(headers: Column) -> Column:
    """Mask the cookie entries of a ``map<string,string>`` of headers."""
    return F.transform_values(
        headers,
        lambda k, v: F.when(F.lower(k).isin("cookie", "set-cookie"), F.lit("[REDACTED]")).otherwise(v),
    )


def thousands(number: Column) -> Column:
    """``1749`` → ``1.749``."""
    return F.translate(F.format_number(number, 0), ",", ".")


def is_blank(value: Column) -> Column:
    """True for text that is empty once trimmed. NULL counts as blank."""
    return F.coalesce(normalize_ws(value) == "", F.lit(True))


def is_blank_list(values: Column) -> Column:
    """True for an empty or missing list."""
    return F.coalesce(F.size(values) <= 0, F.lit(True))
