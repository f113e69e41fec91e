"""Classifiers: held-out accuracy, and a defined result in every awkward case."""

import pytest
from pyspark.sql import functions as F

from gleanery.llm import common as C
from gleanery.llm import language, quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("query", "label", "least"), [(quality.op1_quality_classifier, "quality", 0.95), (toxicity.op7_toxicity, "toxic", 0.9)])
def test_held_out_accuracy(spark, query, label, least):
    got = query(spark, SF)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(C.table(spark, SF, "labels"), "doc_id").collect()
    assert got.count() == C.table(spark, SF, "documents").count()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (C_crc(r.doc_id) % 4 == 2) for r in rows)
    assert sum(r.predicted == r[label] for r in held) / len(held) >= least


def C_crc(i):
    import zlib

    return zlib.crc32(str(i).encode())


def test_language_held_out(spark):
    got = language.op8_language_id(spark, SF).join(C.table(spark, SF, "documents"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (C_crc(r.doc_id) % 5 == 0) for r in got)
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97


@pytest.mark.parametrize("module", [quality, toxicity])
def test_awkward_documents(awkward, nothing, labels, no_labels, module):
    label = "quality" if module is quality else "toxic"
    model = module.fit(awkward, labels, label)
    rows = module.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text, r.score) == r.score
    assert module.score(nothing, model).count() == 0
    assert {r.score for r in module.score(awkward, module.fit(awkward, no_labels, label)).collect()} == {0.5}
    assert {r.score for r in module.score(awkward, module.fit(nothing, labels, label)).collect()} == {0.5}


def test_pairs_count_for_more_than_their_parts():
    """Neither word tells, both together do: no additive weights can learn it."""
    import numpy as np

    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(1200):
        a, b = rng.integers(2), rng.integers(2)
        rows.append(np.array([0 if a else 1, 2 if b else 3]))
        y.append(float(a == b))
    m = toxicity.Machine(np.arange(4)).fit(rows, np.array(y), epochs=40)
    z = m.raw(np.concatenate([[0, 2], [0, 3], [1, 2], [1, 3]]), np.array([2, 2, 2, 2]))[0]
    assert z[0] > 1 and z[3] > 1 and z[1] < -1 and z[2] < -1


def test_a_pair_is_learned_from_documents_where_neither_word_tells(spark):
    """Through fit(): the terms of the pair are chosen among thousands though none of them is associated with the label by itself."""
    import numpy as np

    rng = np.random.default_rng(0)
    rows = []
    for i in range(1600):
        a, b = rng.integers(2), rng.integers(2)
        words = [*(f"w{k}" for k in rng.integers(3000, size=40)), "zorb" if a else "plimsolls", "kand" if b else "truv"]
        rows.append((i, " ".join(rng.permutation(words)), int(a == b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, docs)
    z = model.score(["zorb kand", "plimsolls truv", "zorb truv", "plimsolls kand"])
    assert z[0] > 0.7 and z[1] > 0.7 and z[2] < 0.3 and z[3] < 0.3
    held = [r for r in toxicity.score(docs, model).collect() if C_crc(r.doc_id) % 4 == 2]
    assert sum((r.score > 0.5) == r.toxic for r in held) / len(held) > 0.95
    # where no pair tells, none is chosen
    drawn = [np.unique(rng.integers(2000, size=40)) for _ in range(1000)]
    y = (rng.random(1000) < 0.3).astype(float)
    counts, ids = np.array([len(d) for d in drawn]), np.concatenate(drawn)
    assert len(toxicity.in_company(ids, counts, y, np.bincount(ids, minlength=2000), np.bincount(ids, np.repeat(y, counts), 2000))) == 0


def test_scores_against_plain_loops():
    """The machine's pair sum against two loops over pairs; the embeddings' logits against the mean vectors and the layer."""
    import numpy as np

    rng = np.random.default_rng(1)
    texts = ["one two three one", "", "Zwei drei vier", "x " * 50, "a b c d e f g"]
    m = toxicity.Machine(np.arange(toxicity.BUCKETS))
    m.w0, m.w = 0.3, rng.standard_normal(toxicity.BUCKETS).astype(np.float32) * 0.1
    m.v = rng.standard_normal((toxicity.BUCKETS, toxicity.FACTORS)).astype(np.float32) * 0.3
    for text, got in zip(texts, m.score(texts), strict=True):
        own = toxicity.terms([text])[0]
        z = m.w0 + sum(float(m.w[i]) for i in own) + sum(float(np.dot(m.v[i], m.v[j])) for a, i in enumerate(own) for j in own[:a])
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-4
    net = quality.Embeddings(seed=3)
    net.w, net.b = rng.standard_normal(net.w.shape).astype(np.float32), rng.standard_normal(2).astype(np.float32)
    for text, got in zip(texts, quality.score_texts(texts, *net.logits()), strict=True):
        x = np.zeros(quality.DIM)
        for kinds in quality.hits([text]):
            ids = np.concatenate([i for i, _ in kinds])
            x += net.e[ids].mean(0) if len(ids) else 0
        z = x @ net.w + net.b
        assert abs(got - np.exp(z[1]) / np.exp(z).sum()) < 1e-4


def test_models_do_not_depend_on_the_layout(spark):
    """Long texts are drawn from by their id: the same model from one file and from many."""
    import numpy as np

    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(9000, size=6000 if i % 4 == 0 else 30)), i % 2, i % 2, "en" if i % 3 else "fr") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int, lang string")
    one, many = docs.coalesce(1), docs.repartition(7)
    assert all(np.array_equal(a, b) for a, b in zip(quality.fit(one, docs), quality.fit(many, docs), strict=True))
    a, b = toxicity.fit(one, docs), toxicity.fit(many, docs)
    assert np.array_equal(a.active, b.active) and np.array_equal(a.w, b.w) and np.array_equal(a.v, b.v)
    a, b = language.fit(one, F.lit(True)), language.fit(many, F.lit(True))
    assert a.langs == b.langs and np.array_equal(a.out, b.out)


def test_language_of_awkward_documents(awkward, nothing):
    net = language.fit(awkward, F.lit(True))
    rows = language.predict(awkward, net).join(awkward.select("doc_id", "text").distinct(), "doc_id").collect()
    for r in rows:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
        assert r.lang_pred in ("und", "en", "fr") and 0 <= r.score <= 1
    assert {r.lang_pred for r in language.predict(awkward, language.fit(nothing, F.lit(True))).collect()} == {"und"}
    assert language.predict(nothing, net).count() == 0


def test_folded_tables_equal_the_convolution():
    import numpy as np

    net = language.Network(["a", "b"]).tables()
    x = np.random.default_rng(3).integers(0, 256, (5, language.WINDOW)).astype(np.uint8)
    pooled = []
    for w in language.WIDTHS:
        z = np.stack([net.e[x[:, i : i + w]].reshape(5, -1) @ net.k[w] for i in range(language.WINDOW - w + 1)], 1)
        pooled.append(z.max(1) + net.kb[w])
    z = np.maximum(np.concatenate(pooled, 1), 0) @ net.out + net.b
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    assert np.allclose(net.probabilities(x), p, atol=1e-5)
