"""Whitening against numpy's dense eigenvalue routine and exact integers."""

import math

import numpy as np
import pytest

from tidepool.llm import whitening as E
from tidepool.llm.queries import QUERIES


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * values) @ q.T


SPECTRA = {
    "falling": np.arange(1.0, 41), "steep": 10.0 ** -np.arange(12), "close": 1 + 1e-4 * np.arange(30), "tied first": np.array([5.0] * 3 + [1] * 5),
    "tied at the cut": np.array([9.0, 8, 7, 5, 5, 5, 1, 1]), "all tied": np.ones(6), "short rank": np.array([3.0, 2] + [0] * 20), "one": np.array([2.0]),
    "two of three": np.array([0.0, 4, 1]), "far apart": np.array([1e9, 1e3, 1, 1e-2, 1e-3, 0])}


@pytest.mark.parametrize("name", SPECTRA)
def test_leading_components(name):
    values = SPECTRA[name]
    a = symmetric(values)
    got, vectors = E.leading(a, 4)
    want = np.linalg.eigvalsh(a)[::-1]
    want = want[:4][want[:4] > E.LEAST_SHARE * np.trace(a)]
    assert len(got) == len(want) and np.allclose(got, want, rtol=1e-9, atol=1e-12 * want[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-12)
    assert np.allclose(a @ vectors, vectors * got, atol=1e-11 * want[0])


@pytest.mark.parametrize("seed", range(20))
def test_inertia(seed):
    rng = np.random.default_rng(seed)
    values = rng.choice([-3.0, -1, 0, 1, 2, 50], rng.integers(1, 12))
    a = symmetric(values, seed)
    got = E.inertia(a)
    assert sum(got) == len(a)
    for shift in (-2.0, -0.5, 0.5, 1.5, 10):
        assert E.above(a, shift) == (values > shift).sum()
    assert E.inertia(np.array([[0.0, 1], [1, 0]])) == (1, 1, 0) and E.inertia(np.zeros((3, 3))) == (0, 0, 3)


def test_contour_counts_what_it_holds():
    a = symmetric(np.array([1.0, 2, 3, 10, 11]))
    # The trace of the projector is the number of eigenvalues inside.
    assert np.trace(E.project(a, np.eye(5), 8.0, 14.0)) == pytest.approx(2, abs=1e-5)


def brute(vectors, k=4):
    """{row number: (deviation, whitened up to signs)}, n and explained."""
    ok = {i: [math.floor(256 * float(c)) for c in v] for i, v in enumerate(vectors)
          if v and all(c is not None and math.isfinite(c) for c in v)}
    fit = np.array(sorted({tuple(v) for v in ok.values()}), dtype=float)
    n, s = len(fit), [sum(int(v[j]) for v in fit) for j in range(fit.shape[1])]
    c = fit - fit.mean(axis=0)
    values, q = np.linalg.eigh(c.T @ c / n)
    values, q = values[::-1][:k], q[:, ::-1][:, :k]
    return n, values / (c ** 2).sum() * n, {
        i: (sum((n * a - b) ** 2 for a, b in zip(v, s)), (np.array(v) - fit.mean(axis=0)) @ q / np.sqrt(values)) for i, v in ok.items()}


def check(rows, vectors, key=lambda r: r.row.vec_id):
    n, share, want = brute(vectors)
    got = {}
    for r in rows:
        got.setdefault(key(r), {})[r.component] = r
    assert got.keys() == want.keys()
    signs = np.sign(np.array([[got[i][c].whitened for c in range(1, 5)] for i in want]) * np.array([w for _, w in want.values()])).sum(axis=0)
    assert (np.abs(signs) > 0).all()
    for i, (d, w) in want.items():
        assert sorted(got[i]) == [1, 2, 3, 4]
        for c in range(4):
            r = got[i][c + 1]
            assert (r.n, r.deviation) == (n, d) and r.explained == pytest.approx(share[c], rel=1e-9)
            assert r.whitened == pytest.approx(w[c] * np.sign(signs[c]), abs=1e-7) and 0 <= r.identity_error < 1e-9


SCHEMA = "vec_id long, embedding array<float>, component string, x string, n string"


def rows_of(spark, vectors):
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in enumerate(vectors)], SCHEMA)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = [[float(x) for x in np.float32(rng.normal(size=6) * [4, 3, 2, 1.5, 1, .5])] for _ in range(300)]
    vectors += [vectors[0]] * 200 + [None, [float("nan")] * 6, [1.0, None, 2.0, 3.0, 4.0, 5.0], [float("inf")] * 6, [float("-inf")] + [0.0] * 5, [-0.0] * 6, []]
    for parts in (1, 7):
        rows = E.whiten(rows_of(spark, vectors).repartition(parts)).collect()
        check(rows, vectors)
        assert all(r.row.component == "a" and r.row.x == "b" for r in rows)


def test_defined_cases(spark):
    assert E.whiten(rows_of(spark, [])).collect() == []
    assert E.whiten(rows_of(spark, [None, []])).collect() == []
    assert E.whiten(rows_of(spark, [[1.0, 2.0]] * 5)).collect() == []
    two = E.whiten(rows_of(spark, [[1.0, 2.0], [3.0, 5.0], [1.0, 2.0]])).collect()
    assert [r.component for r in two] == [1, 1, 1] and [abs(r.whitened) for r in two] == pytest.approx([1, 1, 1])
    # The commonest length wins, of equal ones the greater; an entry too great to be exact is left out.
    mixed = [[1.0], [2.0], [1.0, 2.0], [3.0, 1.0], [1e30, 1.0]]
    assert {r.row.vec_id for r in E.whiten(rows_of(spark, mixed)).collect()} == {2, 3}
    null_id = spark.createDataFrame([(None, [1.0]), (None, [2.0])], "vec_id long, embedding array<double>")
    assert [r.row.vec_id for r in E.whiten(null_id).collect()] == [None, None]


def test_deviation_is_exact_beyond_double():
    x, sums = np.array([[3_000_000, 1], [5, 5]]), np.array([7, -9])
    assert E.deviation(x, 10 ** 3, sums) == [(3_000_000_000 - 7) ** 2 + 1009 ** 2, 4993 ** 2 + 5009 ** 2]
    assert E.deviation(x, 10 ** 4, sums) == [None if (3 * 10 ** 10 - 7) ** 2 + 10009 ** 2 >= 1 << 63 else 0, 49993 ** 2 + 50009 ** 2]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r.vec_id for r in table] == list(range(len(table)))
    rows = QUERIES["op11_embedding_whitening"](spark, sf).collect()
    check(rows, [r.embedding for r in table], key=lambda r: r.vec_id)
