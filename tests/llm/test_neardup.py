import random
from collections import Counter

import numpy as np
from gleanery.llm import common as C
from gleanery.llm import neardup as N
from gleanery.llm.components import components

SF = "/root/testdata/sf0.001"


def sets(texts):
    values, counts = C.shingles([t or "" for t in texts])
    ends = np.cumsum(counts)
    return [Counter(values[e - n : e].tolist()) for e, n in zip(ends, counts, strict=True)]


def similar(a, b):
    low = sum((a & b).values())
    return low / (a.total() + b.total() - low) if low else 0.0


def roots(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(docs):
    ids = sorted(docs)
    s = dict(zip(ids, sets([docs[i] for i in ids]), strict=True))
    return roots(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if similar(s[a], s[b]) >= 0.8])


def test_agreement_is_the_weighted_similarity():
    rng = np.random.default_rng(1)
    elements = rng.integers(1 << 62, size=300).astype(np.uint64)
    wa, wb = rng.choice([0.3, 1, 2, 5.5], 300), rng.choice([0.3, 1, 2, 5.5], 300)
    a, b = slice(0, 250), slice(100, 300)
    sig = N.signatures(np.concatenate([elements[a], elements[b]]), np.concatenate([wa[a], wb[b]]), np.array([250, 200]), k=4096)
    low = np.minimum(wa[100:250], wb[100:250]).sum()
    true = low / (wa[a].sum() + wb[b].sum() - low)
    assert abs((sig[0] == sig[1]).mean() - true) < 0.03


def test_limits_grow_until_every_coordinate_is_filled():
    sig = N.signatures(np.array([5, 7, 9], np.uint64), np.array([1.0, 0.01, 3.0]), np.array([1, 1, 0, 1]))
    assert (sig[[0, 1, 3]] != 0).all() and (sig[2] == 0).all()


def test_classes_by_brute_force(spark):
    docs = {r.doc_id: r.text for r in C.table(spark, SF, "documents").collect()}
    assert {r.doc_id: r.class_id for r in N.op2_minhash_near_dedup(spark, SF).collect()} == brute(docs)


def test_links_that_the_first_of_a_bucket_does_not_see(spark):
    """A family of which each copy is edited for itself: copies are near their source, few are near each other, and the source is not the first."""
    rng = random.Random(4)
    docs = {}
    for f in range(4):
        source = [f"w{rng.randrange(10_000)}" for _ in range(200)]
        for c in range(25):
            x = list(source)
            for _ in range(rng.choice([3, 4, 5, 6, 8])):
                x[rng.randrange(200)] = f"z{rng.randrange(10**9)}"
            docs[f * 100 + c] = " ".join(x)
        docs[f * 100 + 99] = " ".join(source)
        docs[f * 100 + 98] = " ".join(source)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in N.classes(frame).collect()}
    assert got == brute(docs)
    kept = {r.doc_id for r in N.keep_one(frame).collect()}
    assert kept == set(brute(docs).values())


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (300, 100), (7, 7), (50, 51), (50, 51)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    ids = {x for e in chain for x in e}
    want = {k: v for k, v in roots(ids, chain).items() if k != v}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_documents(awkward, nothing):
    rows = N.classes(awkward).collect()
    got = {r.doc_id: r.class_id for r in rows}
    docs = {r.doc_id: r.text for r in awkward.collect() if r.doc_id is not None}
    assert len(rows) == len(docs) and got == brute(docs)
    kept = N.keep_one(awkward)
    stay = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == awkward.columns and len(stay) == len(set(got.values())) + 1 and {d for d, _ in stay} == {*got.values(), None}
    assert N.classes(nothing).count() == 0 and N.keep_one(nothing).count() == 0


def test_keep_one_keeps_one_row_for_each_class(spark):
    """Rows repeated whole, copies without an id, and a text that shares its id with a copy."""
    text = lambda n: " ".join(f"w{n}x{i}" for i in range(30))
    rows = [(1, text(1)), (1, text(1)), (2, text(1)), (2, text(2)), (None, text(1)), (None, text(3)), (None, text(3)), (5, "!!!"), (5, "!!!"), (6, None), (7, text(3))]
    kept = N.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((tuple(r) for r in kept), key=str) == sorted([(1, text(1)), (2, text(2)), (7, text(3)), (5, "!!!"), (6, None)], key=str)


def test_rows_for_each_text_do_not_grow_with_its_group(spark, monkeypatch):
    """A family whose members are all near its source and few near each other: the rows of every step that is written are counted."""
    settle, verified = N.C.settle, N.verified
    made = []

    def watch(df):
        out = settle(df)
        made.append(out.count())
        return out

    monkeypatch.setattr(N.C, "settle", watch)
    monkeypatch.setattr(N, "verified", lambda pairs, texts, similar: (made.append(pairs.count()), verified(pairs, texts, similar))[1])
    most = {}
    for n in (150, 600):
        made.clear()
        rng = random.Random(7)
        source = [f"w{rng.randrange(10_000)}" for _ in range(150)]
        rows = []
        for c in range(n):
            x = list(source)
            for _ in range(4):
                x[rng.randrange(150)] = f"z{rng.randrange(10**9)}"
            rows.append((c, " ".join(x)))
        got = {r.doc_id: r.class_id for r in N.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
        most[n] = max(made) / n
        if n == 150:
            assert got == brute(dict(rows))
    assert most[600] < 1.5 * most[150]


def test_places_and_chunks_of_any_size_give_the_same(spark, monkeypatch):
    rng = random.Random(9)
    source = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    rows = []
    for c in range(60):
        x = list(source)
        for _ in range(rng.choice([2, 3, 4, 5])):
            x[rng.randrange(120)] = f"z{rng.randrange(10**9)}"
        rows.append((c, " ".join(x)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(dict(rows))
    assert {r.doc_id: r.class_id for r in N.classes(docs).collect()} == want
    monkeypatch.setattr(N, "PLACE", 300)
    assert {r.doc_id: r.class_id for r in N.classes(docs).collect()} == want


def test_signatures_take_the_earliest_darts_without_sorting_them(monkeypatch):
    """Sorting all darts took most of the signing's time. Sets of whole weights come out the same beside one of fractions, where heights count."""
    rng = np.random.default_rng(5)
    counts = np.array([1, 40, 300, 3])
    elements, weights = rng.integers(0, 2**63, counts.sum()).astype(np.uint64), rng.integers(1, 4, counts.sum()).astype(float)

    def no_sort(*_):
        raise AssertionError("darts are sorted")

    monkeypatch.setattr(N.np, "lexsort", no_sort)
    alone = N.signatures(elements, weights, counts)
    mixed = N.signatures(np.append(elements, np.uint64(7)), np.append(weights, 0.5), np.append(counts, 1))
    assert (mixed[:4] == alone).all() and (alone != 0).all() and (mixed[4] != 0).all()
    assert len(np.unique(alone[0])) == N.WIDTH  # one element fills every coordinate with a dart of its own
