from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from tempora.llm import whitening as wh

SF = "/root/testdata/sf0.01"


def faddeev(matrix):
    """Characteristic polynomial by traces of powers, in fractions."""
    d = len(matrix)
    a = np.array(matrix, object)
    m, c = np.zeros((d, d), object), [1]
    for k in range(1, d + 1):
        m = a.dot(m) + np.eye(d, dtype=int).astype(object) * c[-1]
        c.append(Fraction(-int(np.trace(a.dot(m))), k))
    return [int(v) for v in reversed(c)]


def gram(rng, d, rank, high):
    b = rng.integers(-high, high, (d, rank)).astype(object)
    return b.dot(b.T).tolist()


@pytest.mark.parametrize("d,rank,high", [(1, 1, 9), (2, 2, 50), (5, 3, 1000), (9, 9, 10 ** 6), (12, 4, 3)])
def test_polynomial_is_exact(spark, d, rank, high):
    m = gram(np.random.default_rng(d), d, rank, high)
    assert wh.characteristic(spark, m) == faddeev(m)
    assert max(map(abs, faddeev(m))) <= wh.coefficient_bound(m)


def test_polynomial_of_matrices_that_need_exchanges(spark):
    for m in ([[0, 0, 0], [0, 0, 0], [0, 0, 7]], [[2, 0, 1], [0, 3, 0], [1, 0, 2]], [[5]]):
        assert wh.characteristic(spark, m) == faddeev(m)


def test_roots_and_their_multiplicity():
    def poly(roots):
        c = [1]
        for r in roots:
            c = [(c[k - 1] if k else 0) - r * (c[k] if k < len(c) else 0) for k in range(len(c) + 1)]
        return c

    for roots, many in [([9, 9, 4, 4, 4, 1], 4), ([0, 0, 0, 5], 4), ([1000003, 1000002, 1000001], 4), ([7], 4),
                        ([0, 0, 0], 2), ([16, 8, 4, 2, 1], 3)]:
        found = wh.leading_roots(poly(roots), sum(roots), many)
        flat = [r for r, times in found for _ in range(times)]
        want = sorted(roots, reverse=True)
        assert len(flat) >= min(many, len(roots))
        for got, exact in zip(flat, want):
            assert abs(Fraction(got, 1 << wh.DIGITS) - exact) <= Fraction(max(sum(roots), 1), 1 << 100)


def test_repeated_root_has_an_orthonormal_space():
    m = np.diag([5, 5, 5, 2, 1, 0]).tolist()
    v = np.array(wh.null_space(m, 5 << wh.DIGITS, 3))
    assert np.allclose(v @ v.T, np.eye(3), atol=1e-15) and np.allclose(v @ np.array(m), 5 * v, atol=1e-14)


def brute(vectors):
    """Per row: (n, deviation, |whitened|, explained) by numpy's own decomposition."""
    x = {i: np.floor(256 * np.asarray(v, np.float64)).astype(int) for i, v in vectors.items()}
    listed = np.array(sorted({tuple(v.tolist()) for v in x.values()}))
    n, sums = len(listed), listed.sum(axis=0)
    c = listed - listed.mean(axis=0)
    e, axes = np.linalg.eigh(c.T @ c / n)
    e, axes = e[::-1][:4], axes[:, ::-1][:, :4]
    return {i: (n, int(((n * v - sums) ** 2).sum()), np.abs((v - sums / n) @ axes / np.sqrt(e)), e / c.var(axis=0).sum())
            for i, v in x.items()}


def test_rows_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    vectors = {i: (rng.normal(size=7) * [5, 3, 2, 1, .5, .3, .1]).astype(np.float32) for i in range(300)}
    vectors |= {1000 + i: vectors[i] for i in range(100)}  # copies don't weigh
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in vectors.items()],
                               "vec_id long, embedding array<float>").repartition(5)
    got = wh.whitened(df).collect()
    want = brute(vectors)
    assert len(got) == 4 * len(vectors)
    sign = {}
    for r in got:
        n, deviation, w, explained = want[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(w[r.component - 1], abs=1e-11)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-12)
        assert r.identity_error < 1e-12
        if abs(r.whitened) > 0.1:
            sign.setdefault(r.component, {})[r.vec_id] = r.whitened > 0
    assert sign.keys() == {1, 2, 3, 4}


def test_query_whitens_the_whole_table(spark):
    got = wh.op11_whitening(spark, SF).toPandas()
    e = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    assert len(got) == 4 * len(e) and got.identity_error.max() < 1e-4
    want = brute(dict(zip(e.vec_id, e.embedding)))
    for r in got.sample(400, random_state=1).itertuples():
        n, deviation, w, explained = want[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(w[r.component - 1], abs=1e-9)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, [1.5, 0.0, -3.0]), (None, [0.25, 9.0, 1.0]),
            (3, None), (4, []), (5, [1.0, None, 2.0]), (6, [nan, 1.0, 1.0]), (7, [inf, 0.0, 0.0]),
            (8, [4.0]), (9, [4.0]), (10, [1.0, 2.0]), (11, [3.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.selectExpr("*", "vec_id as id", "vec_id as n", "embedding as vec", "'x' as whitened")
    got = wh.whitened(df).collect()
    count = {}
    for r in got:
        count[r.vec_id] = count.get(r.vec_id, 0) + 1
    # three dimensions give three components, twice for the repeated row; one and two dimensions their own
    assert count == {1: 6, 2: 3, None: 3, 8: 1, 9: 1, 10: 2, 11: 2}
    by = {(r.vec_id, r.component): r for r in got}
    assert by[2, 3].whitened == 0.0 and by[2, 3].explained == 0.0 and by[2, 3].identity_error == pytest.approx(1)
    assert by[8, 1].whitened == 0.0 and by[8, 1].deviation == 0 and by[8, 1].n == 1
    assert abs(by[10, 1].whitened) == pytest.approx(1) and by[10, 2].whitened == 0.0
    assert wh.whitened(df.filter("vec_id = 3")).count() == 0
    assert wh.whitened(df.limit(0)).count() == 0


def test_entries_beyond_a_long_take_its_end_and_sums_stay_exact(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [3.0e13, 1.0]), (4, [2.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.vec_id, r.component): r for r in wh.whitened(df).collect()}
    assert len(got) == 8 and got[1, 1].deviation is None and got[4, 1].identity_error < 1e-6
    x = np.array([[2 ** 40, -3], [5, 2 ** 62], [-2 ** 62, 7]])
    exact = x.astype(object)
    assert wh.products(x) == exact.T.dot(exact).tolist()
    back = wh.unpacked(pa.array(wh.packed(x), pa.binary()), 2)
    assert (back == x).all()
