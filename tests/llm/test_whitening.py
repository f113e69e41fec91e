import numpy as np
import pytest

from gleanery.llm import whitening as W


def exact(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    m = x - x.mean(0)
    values, units = np.linalg.eigh(m.T @ m / len(x))
    return x, values[::-1][:k], (m @ units[:, ::-1][:, :k]) / np.sqrt(values[::-1][:k]), values.sum()


def run(spark, monkeypatch, rows, schema="vec_id long, embedding array<float>, label int, key int, vector string"):
    monkeypatch.setattr(W.C, "table", lambda *_: spark.createDataFrame(rows, schema).repartition(3))
    return W.op11_embedding_whitening(spark, "").collect()


@pytest.mark.parametrize("d", [3, 8, 33])
def test_against_a_dense_solver(spark, monkeypatch, d):
    rng = np.random.default_rng(d)
    vectors = (rng.standard_normal((200, d)) * np.geomspace(1, 0.01, d)).astype(np.float32).tolist()
    rows = [(i, v, 0, 1, "c") for i, v in enumerate(vectors)] + [(900, None, 0, 1, ""), (901, [None] * d, 0, 1, ""), (902, [float("nan")] * d, 0, 1, ""), (903, [float("inf")] + [0.0] * (d - 1), 0, 1, ""), (904, [1.0], 0, 1, ""), (None, vectors[5], 0, 1, "")]
    x, values, want, trace = exact([*vectors, vectors[5]])
    got = run(spark, monkeypatch, rows)
    k, n = min(8, d), 201
    assert len(got) == n * k and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    white, shares = np.zeros((n, k)), np.zeros(k)
    dev = ((n * x - x.sum(0)) ** 2).sum(1)
    for r in got:
        at = 200 if r.vec_id is None else r.vec_id
        white[at, r.component - 1], shares[r.component - 1] = r.whitened, r.explained
        assert r.deviation == dev[at]
    assert np.allclose(shares, values / trace, rtol=1e-9)
    assert np.abs(white * np.sign((white * want).sum(0)) - want).max() < 1e-6


def test_dependent_equal_and_no_vectors(spark, monkeypatch):
    flat = [(i, [float(i), 2.0 * i, 0.0], 0, 0, "") for i in range(10)]
    assert {r.component for r in run(spark, monkeypatch, flat)} == {1}
    assert run(spark, monkeypatch, [(i, [1.0, 2.0], 0, 0, "") for i in range(4)]) == []
    assert run(spark, monkeypatch, []) == [] and run(spark, monkeypatch, [(1, [], 0, 0, ""), (2, None, 0, 0, "")]) == []


def test_cholesky_and_jacobi():
    rng = np.random.default_rng(0)
    g = rng.standard_normal((12, 7)) * np.geomspace(1, 1e-6, 7)
    low, order = W.pivoted_cholesky(g @ g.T)
    assert low.shape[1] == 7 and np.allclose(low @ low.T, (g @ g.T)[order][:, order]) and np.allclose(np.triu(low, 1), 0)
    turned = W.one_sided_jacobi(np.tril(rng.standard_normal((9, 9))))
    gram = turned.T @ turned
    assert np.abs(gram - np.diag(gram.diagonal())).max() < 1e-12


def test_deviation_beyond_a_long_is_null():
    m = W.Whitening(10**9, [0, 0], np.ones(1), np.ones((2, 1)), 1.0)
    assert m.deviations(np.array([[1, 1], [10**6, 0]])) == [2 * 10**18, None]
