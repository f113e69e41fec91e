import random

from gleanery.llm import common as C
from gleanery.llm import decontamination as D

from .test_common import plain_words

SF = "/root/testdata/sf0.01"


def grams(t):
    w = plain_words(t or "")
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs, items):
    own = {i: grams(t) for i, t in items.items()}
    found = set()
    for d, t in docs.items():
        g = grams(t)
        found |= {(d, i) for i, x in own.items() if x and len(x & g) >= 0.8 * len(x) - 1e-9}
    return found


def test_leaks_by_brute_force(spark):
    docs = {r.doc_id: r.text for r in C.table(spark, SF, "documents").collect()}
    items = {r.item_id: r.text for r in C.table(spark, SF, "benchmark").collect()}
    got = {(r.doc_id, r.item_id) for r in D.op9_decontamination(spark, SF).collect()}
    assert got == brute(docs, items) != set()


def planted(spark):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(5000)}"
    items = {i: " ".join(word() for _ in range(rng.choice([5, 6, 12, 40, 300]))) for i in range(60)} | {98: "too short item", 99: None}
    docs = {}
    for d in range(80):
        w = [word() for _ in range(rng.choice([0, 30, 2000, 20000]))]
        for i in rng.sample(range(60), rng.randint(0, 2)):
            x = items[i].split()
            for _ in range(rng.choice([0, 0, 1, len(x) // 20])):
                x[rng.randrange(len(x))] = word()
            at = rng.randint(0, len(w))
            w[at:at] = x
        docs[d] = " ".join(w).title()
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    return docs, items, frame, spark.createDataFrame(list(items.items()), "item_id long, text string")


def test_edited_and_short_items_in_long_documents(spark, monkeypatch):
    docs, items, frame, bench = planted(spark)
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id) for r in D.leaks(frame, bench).collect()} == want
    kept = {r.doc_id for r in D.without_leaks(frame, bench).collect()}
    assert kept == set(docs) - {d for d, _ in want}
    monkeypatch.setattr(D, "BLOCK_ITEMS", 7)  # several blocks give the same
    assert len(D.item_blocks(bench)) > 5
    assert {(r.doc_id, r.item_id) for r in D.leaks(frame, bench).collect()} == want


def test_awkward_documents(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "line line line line line"), (None, "x y z u v w"), (2, None), (3, "")], "item_id long, text string")
    assert {r.doc_id for r in D.leaks(awkward, bench).collect()} == {10}
    assert D.without_leaks(awkward, bench).columns == awkward.columns
    assert D.without_leaks(awkward, bench).count() == awkward.count() - 1
    assert D.leaks(nothing, bench).count() == 0
    empty = bench.limit(0)
    assert D.leaks(awkward, empty).count() == 0 and D.without_leaks(awkward, empty).count() == awkward.count()


def test_items_of_few_shingles_are_found_in_long_documents():
    import numpy as np

    rng = np.random.default_rng(2)
    for size in (5, 6, 8):
        items = [" ".join(f"i{k}" for k in rng.integers(1 << 40, size=size)) for _ in range(1500)]
        text = " ".join(" ".join(f"w{k}" for k in rng.integers(5000, size=25)) + " " + item for item in items)
        found = D.Items(list(range(len(items))), items).search([text], 0.8)
        assert {i for _, i, _, _ in found} == set(range(len(items)))


def test_the_stage_drops_documents_with_an_item_without_an_id(spark):
    docs = spark.createDataFrame([(1, "so it was that seven red boats left the harbour"), (2, "nothing of the kind is in here at all")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "seven red boats left the harbour"), (4, "quite another text of many words"), (None, None)], "item_id long, text string")
    assert [r.doc_id for r in D.without_leaks(docs, items).collect()] == [2]
    assert D.leaks(docs, items).count() == 0


def test_short_items_are_searched_whole_where_asked_for(spark):
    items = [(1, "one"), (2, "two Words"), (3, "a b c d"), (4, "a b c"), (5, ""), (6, None), (7, "two words"), (8, "five words are a shingle")]
    docs = [(1, "One, two words."), (2, "a b c x"), (3, "b a, b: c d"), (4, ""), (5, None), (6, "Two"), (7, "FIVE words are a shingle one")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = {i: plain_words(t or "") for i, t in items}
    want = set()
    for d, t in docs:
        w = plain_words(t or "")
        want |= {(d, i) for i, x in words.items() if x and any(w[k : k + len(x)] == x for k in range(len(w)))}
    assert {(r.doc_id, r.item_id) for r in D.leaks(frame, bench, short=True).collect()} == want and len(want) == 8
    assert {(r.doc_id, r.item_id) for r in D.leaks(frame, bench).collect()} == {(7, 8)}
    assert {r.doc_id for r in D.without_leaks(frame, bench, short=True).collect()} == {d for d, _ in docs} - {d for d, _ in want}
