import random
import re

import numpy as np

from gleanery.llm import ngramjoin as N

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, similar=80):
    """n_shingles, component and links of every row, by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            c = len(sets[a] & sets[b])
            if c and 100 * c >= similar * (len(sets[a]) + len(sets[b]) - c):
                links[a], links[b] = links[a] + 1, links[b] + 1
                root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)), n) for i, ((d, _), s, n) in enumerate(zip(rows, sets, links, strict=True))), key=str)


def got(docs):
    return sorted((tuple(r) for r in N.linked(docs).collect()), key=str)


def family(rng, n, words, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_awkward_rows(spark, awkward, nothing):
    assert got(awkward) == brute([(r.doc_id, r.text) for r in awkward.collect()])
    assert got(nothing) == []


def test_families_and_hot_passages(spark, monkeypatch):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = family(rng, 60, 120, 5) + [passage + " " + t for t in family(rng, 30, 40, 3)] + [f"{passage} own{i}" for i in range(30)] + [passage] * 10
    texts += [" ".join(f"u{rng.randrange(10**7)}" for _ in range(rng.randint(1, 90))) for _ in range(30)] + family(rng, 20, 6, 1)
    rows = list(enumerate(texts))
    want = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert got(docs) == want
    monkeypatch.setattr(N, "TREE", 700)  # many trees and chunks
    monkeypatch.setattr(N, "CELLS", 3000)
    assert got(docs) == want


def test_rows_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    made, settle = [], N.C.settle

    def watch(df):
        out = settle(df)
        made.append(out.count())
        return out

    monkeypatch.setattr(N.C, "settle", watch)
    most = []
    for n in (100, 400):
        made.clear()
        rows = list(enumerate(family(random.Random(1), n, 80, 2)))
        out = N.linked(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
        assert sum(r.n_links for r in out) > 0.9 * n * (n - 1)
        most.append(max(made))
    assert most[1] < 6 * most[0]


def test_trie_finds_what_all_pairs_give():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.zipf(1.3, rng.integers(1, 30)) % 60) for _ in range(150)]
    n = np.array([len(s) for s in sets]) + rng.integers(0, 3, 150)
    counts = np.array([len(s) for s in sets])
    trie = N.Trie(np.concatenate(sets), counts, n)
    trie.n_of = n[trie.order]
    assert len(trie.flat) < counts.sum()
    v, m = trie.links(np.concatenate(sets), counts, n, 60)
    want = {(a, b) for a in range(150) for b in range(150) if 160 * len(np.intersect1d(sets[a], sets[b])) >= 60 * (n[a] + n[b])}
    assert set(zip(v.tolist(), m.tolist(), strict=True)) == want and len(v) == len(want)


def test_forest_spans_and_has_no_circle():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 200, 900), rng.integers(0, 200, 900)
    use = N.C.forest(a, b, 200)

    def parts(x, y):
        root = np.arange(200)
        for i, j in zip(x, y, strict=True):
            root[root == root[i]] = root[j]
        return len(set(root.tolist()))

    assert parts(a[use], b[use]) == parts(a, b) == 200 - use.sum()


def test_shingles_are_sets_of_lower_cased_words():
    h, n = N.shingles(["a b c d e f", "", "A b", "a\tB ", "x x x x x x x"])
    assert n.tolist() == [2, 0, 1, 1, 1] and h[2] == h[3]
