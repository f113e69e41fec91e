import re
from itertools import pairwise

import numpy as np
from gleanery.llm import common as C


def plain_words(t):
    return [w for w in re.findall(r"[^\W_]+", t.lower())]


def test_equal_words_and_shingles_have_equal_hashes_wherever_they_lie():
    texts = ["The cat sat on the mat", "on the mat the CAT sat", "", "cat", "été ÉTÉ", "a b c d e f g"]
    h, n = C.words(texts)
    assert n.tolist() == [6, 6, 0, 1, 2, 7]
    plain = [w for t in texts for w in plain_words(t)]
    assert len({(a, b) for a, b in zip(plain, h.tolist(), strict=True)}) == len(set(plain)) == len(set(h.tolist()))
    s, m = C.shingles(texts)
    assert m.tolist() == [2, 2, 0, 1, 1, 3]
    w = [plain_words(t) for t in texts]
    want = [tuple(x[i : i + 5]) for x in w if x for i in range(max(1, len(x) - 4))]
    assert len(set(zip(want, s.tolist(), strict=True))) == len(set(want)) == len(set(s.tolist()))


def test_hashes_do_not_depend_on_the_block():
    texts = ["alpha beta gamma delta eps zeta"] * 3 + ["q " * 900_000 + "alpha beta gamma delta eps zeta"]
    s, n = C.shingles(texts)
    assert s[0] == s[-2] and s[1] == s[-1] and n[-1] == 900_002


def test_helpers():
    assert C.ramp(np.array([2, 0, 3])).tolist() == [0, 1, 0, 1, 2]
    assert C.group_sums(np.array([1.0, 2, 3]), np.array([1, 0, 2])).tolist() == [1, 0, 5]


def test_next_row_over_ranges(spark):
    from gleanery.llm.neighbours import with_next

    rows = [(int(x),) for x in np.random.default_rng(1).permutation(500)]
    df = spark.createDataFrame(rows, "i long").repartition(7)
    got = {r.i: r.next.i if r.next else None for r in with_next(df, ["i"]).collect()}
    assert got == dict(pairwise(range(500))) | {499: None}
    assert {r.i: r.next.i for r in with_next(df, ["i"], wrap=True).collect()}[499] == 0
    assert with_next(df.limit(0), ["i"], wrap=True).count() == 0
    assert [r.next.i for r in with_next(df.filter("i = 3"), ["i"], wrap=True).collect()] == [3]
