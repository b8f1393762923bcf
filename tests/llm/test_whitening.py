"""Whitening against numpy's eigenvectors, exact small cases and awkward vectors."""

import numpy as np
import pytest

from assetflow.llm import whitening
from assetflow.llm.common import table


def _expected(x_rows, k=4):
    """Distinct rows, their eigenvalues and eigenvectors by numpy, falling."""
    u = np.unique(x_rows, axis=0)
    c = (u - u.mean(axis=0)).astype(float)
    e, v = np.linalg.eigh(c.T @ c / len(u))
    return u, e[::-1][:k], v[:, ::-1][:, :k], e.sum()


def _by_component(rows):
    out = {}
    for r in rows:
        out.setdefault(r.component, {}).setdefault(r.vec_id, r)
    return out


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_given_vectors(spark, sf):
    vec = table(spark, sf, "embeddings").select("vec_id", "embedding").collect()
    ids = [r.vec_id for r in vec]
    x = np.floor(256 * np.array([r.embedding for r in vec], np.float32).astype(float)).astype(np.int64)
    u, e, v, total = _expected(x)
    rows = whitening.query(spark, sf).collect()
    got = _by_component(rows)
    assert len(rows) == 4 * len(ids) and sorted(got) == [1, 2, 3, 4]
    s = u.sum(axis=0)
    for c in range(4):
        w = np.array([got[c + 1][i].whitened for i in ids])
        want = (x - s / len(u)) @ v[:, c] / np.sqrt(e[c])
        assert np.abs(w * np.sign(w @ want) - want).max() < 1e-8
        assert got[c + 1][ids[0]].explained == pytest.approx(e[c] / total, rel=1e-10)
    assert {r.n for r in rows} == {len(u)} and {r.identity_error < 1e-9 for r in rows} == {True}
    d = ((len(u) * x - s) ** 2).sum(axis=1)
    assert all(got[1][i].deviation == d[j] for j, i in enumerate(ids))


def test_polynomial_equals_the_integer_one(spark):
    rng = np.random.default_rng(2)
    for d in (1, 2, 5, 9):
        y = rng.integers(-9, 9, (d + 2, d))
        a = (y.T @ y).astype(object)
        a[:, 0] *= rng.integers(0, 2)
        a[0, :] = a[:, 0]
        if d > 2:
            a[1], a[:, 1] = 0, 0  # a column without a pivot
        if (np.linalg.eigvalsh(a.astype(float)) < -1e-9).any():
            a = (y.T @ y).astype(object)
        # Faddeev and LeVerrier's rule in whole numbers
        c, m = [1], np.zeros((d, d), object)
        for k in range(1, d + 1):
            m = a @ m + c[-1] * np.eye(d, dtype=int).astype(object)
            c.append(-(a @ m).trace() // k)
        assert whitening.polynomial(spark, a.tolist()) == c[::-1]


def test_repeated_and_close_roots():
    poly = [1]
    roots = [10**12 + 1, 10**12, 7, 7, 7, 2, 0, 0]
    for r in roots:
        poly = [(poly[i - 1] if i else 0) - (r * poly[i] if i < len(poly) else 0) for i in range(len(poly) + 1)]
    got = whitening.largest_roots(poly, 6, sum(roots))
    assert [round(x) for x in got] == roots[:6] and all(abs(x - r) < 1e-20 for x, r in zip(got, roots))
    assert len(whitening.largest_roots(poly, 8, sum(roots))) == 6 and whitening.above(poly, 7, 0) == 2 and whitening.above(poly, 13, 1) == 5
    v = whitening.null_vectors([[7 if i == j else 0 for j in range(4)] for i in range(4)], whitening.largest_roots([7**4, -4 * 7**3, 6 * 49, -28, 1], 4, 28))
    assert np.abs(v @ v.T - np.eye(4)).max() < 1e-15


def test_exact_products_of_large_numbers():
    y = np.random.default_rng(0).integers(-(1 << 31), 1 << 31, (200, 5))
    assert (whitening.products(y) == y.astype(object).T @ y.astype(object)).all()


def test_awkward_vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(a), float(b), 0.5, 3.0], "n") for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    rows += [(7, rows[7][1], "n"), (500, rows[3][1], None), (None, rows[4][1], "n")]  # a repeated row, an equal vector, no id
    bad = [(600, None, "n"), (601, [], "n"), (602, [1.0, None, 1.0, 1.0], "n"), (603, [float("nan")] * 4, "n"), (604, [float("inf")] * 4, "n"),
           (605, [1.0], "n"), (606, [1e300, 0.0, 0.0, 0.0], "n")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, n string")
    got = whitening.whiten(df).collect()
    x = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    u, e, v, total = _expected(x)
    assert len(got) == 2 * len(rows) and {r.component for r in got} == {1, 2}  # two columns never vary
    assert {r.n for r in got} == {len(u)} and max(r.identity_error for r in got) < 1e-9
    assert sum(r.vec_id is None for r in got) == 2 and sum(r.vec_id == 7 for r in got) == 4
    by = _by_component(got)
    assert by[1][500].whitened == by[1][3].whitened and by[1][0].explained == pytest.approx(e[0] / total, rel=1e-10)
    large = spark.createDataFrame([(i, [float(v), float(-v)]) for i, v in enumerate((0, 2**21, 2**20, 5))], "vec_id long, embedding array<double>")
    x = np.array([[int(256 * v) for v in (a, -a)] for a in (0, 2**21, 2**20, 5)], object)
    want = [int(sum((4 * x[i] - x.sum(axis=0)) ** 2)) for i in range(4)]
    assert [r.deviation for r in sorted(whitening.whiten(large).collect(), key=lambda r: r.vec_id)] == want
    for empty in (df.where("false"), df.where("vec_id >= 600"), df.where("vec_id = 1")):
        assert whitening.whiten(empty).count() == 0
