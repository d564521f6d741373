import numpy as np
import pytest

from plumbline.llm import whiten as w


def symmetric(rng, d):
    a = rng.normal(size=(d, d))
    return a + a.T


@pytest.mark.parametrize("d", [1, 2, 3, 10, 40])
def test_inertia_counts_eigenvalues(d):
    rng = np.random.default_rng(d)
    for _ in range(20):
        a = symmetric(rng, d)
        values = np.linalg.eigvalsh(a)
        for s in (-1.0, 0.0, 0.7):
            negative, zero, positive = w.inertia(a - s * np.eye(d))
            assert (negative, zero, positive) == ((values < s).sum(), 0, (values > s).sum())
    assert w.inertia(np.zeros((d, d))) == (0, d, 0)


def test_inertia_without_pivots_on_the_diagonal():
    assert w.inertia(np.array([[0.0, 1], [1, 0]])) == (1, 0, 1)
    a = np.zeros((4, 4))
    a[0, 3] = a[3, 0] = a[1, 2] = a[2, 1] = 2
    assert w.inertia(a) == (2, 0, 2)


@pytest.mark.parametrize("spectrum", [
    [9, 7, 5, 3, 2, 1, 0.5, 0.1], [5, 5 - 1e-9, 5 - 2e-9, 1, 1, 1, 0, 0], [3] * 8, [1e12, 1e6, 1, 1e-6, 0, 0, 0, 0], [0] * 8, [1 + 1e-13, 1, 1 - 1e-13, 0.5, 0.5, 0.1, 0.1, 0],
])
def test_leading_pairs_of_any_spectrum(spectrum):
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.normal(size=(8, 8)))[0]
    v = (q * np.array(spectrum, float)) @ q.T
    v = (v + v.T) / 2
    found = w.leading_pairs(v, 5)
    scale = max(spectrum) or 1
    assert np.allclose(found.values, np.linalg.eigvalsh(v)[::-1][:5], atol=1e-13 * scale) and found.certified.all()
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(5), atol=1e-12)
    assert np.abs(v @ found.vectors - found.vectors * found.values).max() <= 1e-12 * scale


def test_iteration_converges_cubically():
    """Three steps after the shift give full precision."""
    rng = np.random.default_rng(1)
    a = symmetric(rng, 30)
    values = np.linalg.eigvalsh(a)[::-1]
    scale = np.abs(a).sum(axis=1).max()
    value, vector = w._rayleigh(a / scale, np.zeros((30, 0)), values[2] / scale + 1e-3, 0)
    assert abs(value * scale - values[2]) < 1e-13 * scale and np.linalg.norm(a @ vector - value * scale * vector) < 1e-12 * scale


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<float>, label string, n int").repartition(3)


def expected(vectors, k):
    """By whole matrices and another eigensolver."""
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    c = distinct - sums / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return n, ((n * x - sums) ** 2).sum(axis=1), np.abs((x - sums / n) @ axes) / np.sqrt(values), values / np.trace(c.T @ c / n)


def test_whitening_matches_whole_matrices(spark):
    rng = np.random.default_rng(0)
    vectors = (rng.normal(size=(300, 20)) @ np.diag(np.linspace(3, 0.2, 20)) + 5).astype(np.float32)
    vectors[200:] = vectors[0]  # a third of all rows
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)] + [(None, vectors[3].tolist()), (5, vectors[9].tolist())]
    got = w.whiten(frame(spark, rows), 6).collect()
    n, deviation, whitened, explained = expected([v for _, v in rows], 6)
    assert len(got) == len(rows) * 6 and {r.n for r in got} == {n} and n == 200
    for r in got:
        if r.vec_id is not None and r.vec_id != 5:
            assert r.deviation == deviation[r.vec_id]
            assert abs(abs(r.whitened) - whitened[r.vec_id, r.component - 1]) < 1e-9 and abs(r.explained - explained[r.component - 1]) < 1e-12
    assert got[0].identity_error < 1e-12 and len({r.identity_error for r in got}) == 1


def test_rows_that_are_left_out_and_components_without_variance(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 2.0, 0.0]), (2, [3.0, 2.0, 0.0]), (3, None), (4, [1.0, None, 2.0]), (5, [nan, 1.0, 1.0]), (6, [inf, 1.0, 1.0]), (7, []), (8, [1.0, 2.0, 0.0])]
    got = {(r.vec_id, r.component): r for r in w.whiten(frame(spark, rows)).collect()}
    assert sorted({i for i, _ in got}) == [1, 2, 8] and {c for _, c in got} == {1, 2, 3}
    assert got[1, 1].whitened == got[8, 1].whitened == -got[2, 1].whitened and abs(got[1, 1].whitened) == 1 and got[1, 1].explained == 1
    assert got[1, 2].whitened is None and got[1, 2].explained == 0 and got[1, 1].n == 2 and got[1, 1].deviation == 128**2
    alone = w.whiten(frame(spark, [(1, [5.0])])).collect()
    assert [(r.whitened, r.deviation, r.identity_error) for r in alone] == [(None, 0, 0.0)]


def test_lengths_are_fitted_apart_and_extremes_saturate(spark):
    rng = np.random.default_rng(3)
    short, long = rng.normal(size=(40, 2)), rng.normal(size=(50, 5))
    rows = [(k, v.tolist()) for k, v in enumerate(short)] + [(100 + k, v.tolist()) for k, v in enumerate(long)]
    both = {(r.vec_id, r.component): (r.n, abs(r.whitened)) for r in w.whiten(frame(spark, rows)).collect()}
    alone = {(r.vec_id, r.component): (r.n, abs(r.whitened)) for r in w.whiten(frame(spark, rows[40:])).collect()}
    assert len(both) == 40 * 2 + 50 * 5
    assert all(both[k][0] == n and abs(both[k][1] - x) < 1e-9 for k, (n, x) in alone.items())
    far = w.whiten(frame(spark, [(1, [3e38, 1.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])])).collect()
    assert all(r.deviation is None for r in far if r.vec_id != 3) and all(abs(r.whitened) < 3 for r in far if r.component == 1)
    assert all(r.whitened is None for r in far if r.component == 2)  # beyond the digits of the first


def test_deviations_are_exact_beyond_floats():
    f = w.Fit(10**6, [10**6 * 7 + 3], np.array([7]), np.array([3e-6]), np.ones(1), np.ones((1, 1)), 1.0, np.ones(1, bool))
    assert f.deviations(np.array([[7], [7 + 2500], [7 + 5000]])) == [9, (2500 * 10**6 - 3) ** 2, None]


def test_empty_table(spark):
    df = frame(spark, [(1, [1.0])]).limit(0)
    assert w.whiten(df).collect() == []


def test_query_of_the_table(rows, duck):
    got = rows("op12_whiten")
    ids, vectors = zip(*duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall())
    n, deviation, whitened, explained = expected(vectors, 16)
    place = {i: k for k, i in enumerate(ids)}
    assert len(got) == 16 * len(ids)
    for r in got:
        k = place[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation[k]) and abs(abs(r.whitened) - whitened[k, r.component - 1]) < 1e-8 and r.identity_error < 1e-10
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-10
