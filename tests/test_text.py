import pytest
from pyspark.sql import functions as F

from gleanery.functions import identity, outcome, paging, text


def test_normalize_ws(values):
    given = ["  a  b\t\nc ", "﻿x　", "", "a b", "a  b", " \n ", None, "a\x0bb", "a b"]
    assert values(text.normalize_ws, given) == ["a b c", "x", "", "a b", "a b", "", None, "a b", "a b"]


def test_split_multivalue(values):
    got = values(text.split_multivalue, ["One\n  Two  Three \n\n", "One Two", "", "\n \n"])
    assert got == [["One", "Two Three"], ["One Two"], [], []]


@pytest.mark.parametrize(
    "ruling,year",
    [
        ("264-2012-ABC/XY", 2012), ("007-2016-ABC/XY-S", 2016), ("019-2014/XY-S1", 2014), ("075-2013 -ABC", 2013),
        ("1- 2015", 2015), ("12-0345-X", None), ("001-20145-ABC", None), ("", None), ("no year", None),
        ("5-1899-2001", 2001), ("3-2100-X", 2100), ("3-2101-X", None),
    ],
)
def test_ruling_year(values, ruling, year):
    assert values(text.ruling_year, [ruling]) == [year]


def test_slug(values):
    given = ["264-2012-ABC/XY", "Resolución N° 12 — Añá", "///---", "ÀÉÎõü Ŝ ǆ K", "été", "İx", "漢字"]
    assert values(text.slug, given) == ["264-2012-abc-xy", "resolucion-n-12-ana", "", "aeiou-s-k", "ete", "ix", ""]
    cut = values(lambda c: text.slug(c, 51), ["a" * 50 + " b"])
    assert cut == ["a" * 50]


def test_urls(values):
    urls = ["/a/b;JSESSIONID=9X?q=1", "/a;jsessionid=1/b", "/plain?x=;y"]
    assert values(text.strip_session_url, urls) == ["/a/b?q=1", "/a/b", "/plain?x=;y"]
    assert values(text.redact_url, ["/a;jsessionid=1#f", "/a;jsessionid=2 /b;jsessionid=3"]) == [
        "/a;jsessionid=REDACTED#f", "/a;jsessionid=REDACTED /b;jsessionid=REDACTED",
    ]


def test_thousands(values):
    assert values(text.thousands, [0, 999, 1749, 232553502], "bigint") == ["0", "999", "1.749", "232.553.502"]


def test_paging(values):
    assert values(lambda c: paging.page_of_index(c, 10), [0, 9, 10, 1752], "bigint") == [1, 1, 2, 176]
    assert values(lambda c: paging.page_count(c, 10), [0, 1, 10, 1753], "bigint") == [1, 1, 1, 176]
    assert values(lambda c: paging.expected_rows(F.lit(1753).cast("bigint"), c, 10), [0, 1750], "bigint") == [10, 3]


def test_identity_keeps_fields_apart(spark):
    rows = [("a", ["x"], "", None), ("a", [], "x", None), ("a", ["x"], "", "u"), ("a", ["x"], "", ""), ("a", ["x", "y"], "", None), ("a", ["x|y"], "", None)]
    df = spark.createDataFrame(rows, "e string, p array<string>, u string, d string")
    cols = [F.col("e"), F.col("p"), F.col("u"), F.lit("s"), F.lit("r"), F.col("d")]
    ids = [r[0] for r in df.select(identity.typed_id(*cols)).collect()]
    assert all(len(i) == 24 for i in ids)
    assert len(set(ids[:3])) == 3 and ids[0] == ids[3]
    assert ids[4] == ids[5]  # the parties are joined by a bar
    import hashlib

    assert ids[0] == hashlib.sha1("\0".join(["a", "x", "", "s", "r", ""]).encode()).hexdigest()[:24]


def test_retry_after(values):
    now = F.expr("timestamp_ntz'2024-05-01 10:00:00'")
    given = ["120", " 0 ", "", None, "soon", "Wed, 01 May 2024 10:01:00 GMT", "Wed, 01 May 2024 09:00:00 GMT", "-5", "1.5"]
    assert values(lambda c: outcome.retry_after_ms(c, now), given) == [120000, 0, None, None, None, 60000, 0, None, None]


def test_retry_after_dates_and_long_numbers(values):
    now = F.expr("timestamp_ntz'2024-05-01 10:00:00'")
    given = ["Wed, 1 May 2024 10:01:00 GMT", "Wednesday, 01-May-24 10:02:00 GMT", "Wed May  1 10:03:00 2024", "Wed May 01 10:03:00 2024", "Friday, 01-May-99 10:00:00 GMT", "9999999999999999", "9" * 40, "Wed, 41 May 2024 10:01:00 GMT"]
    assert values(lambda c: outcome.retry_after_ms(c, now), given) == [60000, 120000, 180000, 180000, 0, (1 << 63) - 1, (1 << 63) - 1, None]


def test_status_class(spark):
    rows = [(200, None), (204, None), (301, None), (404, None), (403, None), (429, None), (500, None), (None, "ENOTFOUND"), (None, "ETIMEDOUT"), (None, "EPROTO"), (None, None)]
    df = spark.createDataFrame(rows, "s int, c string").withColumn("k", outcome.status_class(F.col("s"), F.col("c")))
    got = [tuple(r) for r in df.select("k", outcome.is_retryable(F.col("k"), F.col("c")), outcome.degrades_server(F.col("k"))).collect()]
    assert got == [
        ("ok", False, False), ("ok", False, False), ("unexpected-status", False, False), ("unexpected-status", False, False),
        ("access-denied", False, True), ("throttled", True, True), ("server-unavailable", True, True),
        ("host-unreachable", True, True), ("network", True, True), ("network", False, True), ("network", False, True),
    ]


def test_file_problem(values):
    given = [b"%PDF-1.7" + b"x" * 1100, b"<html>" + b"x" * 2000, b"%PDF", b"%PDF-", b""]
    check = lambda c: outcome.file_problem(c, F.octet_length(c))
    assert values(check, given, "binary") == [None, "magic", "magic", "tamano", "magic"]


def test_runs_of_white_space_as_one_pattern_per_space_finds_them(values):
    """Every mixture of blanks, other spaces and letters, against the pattern that asks for each white space at each place."""
    import itertools
    import re

    given = ["".join(c) for n in range(1, 6) for c in itertools.product(" \t \nx", repeat=n)] + ["a\U0001f600 b", "  \U0001f600", "\x7f \x1f  \x85", "~ !  ~"]
    old = f" *[{text.OTHER_SPACE}][ {text.OTHER_SPACE}]*|  +"
    assert values(text.normalize_ws, given) == [re.sub(old, " ", g).strip(" ") for g in given]
    parts = [[v for v in (re.sub(old, " ", line).strip(" ") for line in g.split("\n")) if v] for g in given]
    assert values(text.split_multivalue, given) == parts
