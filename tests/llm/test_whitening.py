import numpy as np
import pytest

from strata.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string, component string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "n", "c") for i, v in rows], SCHEMA)


def brute(rows, width, k=4):
    """n, S, V's top eigenpairs and every row's results, by numpy over all rows at once."""
    kept = [(i, [*(int(np.floor(256 * float(np.float32(c)))) for c in v), *[0] * (width - len(v))]) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, total = len(fit), fit.sum(axis=0)
    v = (fit - total / n).T @ (fit - total / n) / n
    e, u = np.linalg.eigh(v)
    return kept, n, total, e[::-1][:k], u[:, ::-1][:, :k], v


def cloud(n, width, seed):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, width)) * np.linspace(0.05, 1.5, width) + r.standard_normal(width)
    return [(i, x[i].astype(np.float32).tolist()) for i in range(n)]


def check(spark, rows, width):
    kept, n, total, e, u, v = brute(rows, width)
    got = W.whiten(vectors(spark, rows)).collect()
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    k = int((e > 1e-9 * max(e.max(), 1e-300)).sum())
    assert sorted(by) == list(range(1, k + 1)) and len(got) == k * len(kept)
    for c in by:
        want = sorted((i is None, i or 0, sum((n * q - int(s)) ** 2 for q, s in zip(x, total)),
                       float((np.array(x) - total / n) @ u[:, c - 1] / np.sqrt(e[c - 1]))) for i, x in kept)
        have = sorted((r["vec_id"] is None, r["vec_id"] or 0, int(r["deviation"]), r["whitened"]) for r in by[c])
        assert [w[:3] for w in want] == [h[:3] for h in have]
        a, b = np.array([w[3] for w in want]), np.array([h[3] for h in have])
        sign = np.sign(a @ b)
        if len({i for i, _ in kept}) == len(kept):
            assert np.allclose(a, sign * b, atol=1e-8)
        for r in by[c]:
            assert r["n"] == n and abs(r["explained"] / (e[c - 1] / np.trace(v)) - 1) < 1e-9
            assert r["identity_error"] < 1e-8


def test_equals_a_dense_eigensolver(spark):
    check(spark, cloud(300, 20, 1), 20)


def test_repeated_vectors_count_once(spark):
    rows = cloud(60, 6, 2)
    check(spark, rows + [(1000 + i, rows[0][1]) for i in range(200)], 6)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = cloud(30, 5, 3) + [(None, [1.0] * 5), (None, [0.5] * 5), (3, [0.1] * 5), (3, [0.1] * 5), (90, None),
                              (91, [1.0, None, 1.0, 1.0, 1.0]), (92, [nan] * 5), (93, [-inf] * 5), (94, [1.0, 2.0]),
                              (95, []), (96, [-0.0] * 5)]
    check(spark, rows, 5)


def test_fewer_distinct_vectors_than_components(spark):
    check(spark, [(1, [1.0, 2.0, 3.0, 4.0, 5.0]), (2, [2.0, 2.0, 1.0, 0.0, 5.0]), (3, [0.0, 1.0, 0.0, 1.0, 0.0])], 5)
    assert W.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert W.whiten(vectors(spark, [(1, [])])).count() == 0
    assert W.whiten(vectors(spark, [(1, [1.0])]).limit(0)).count() == 0


def test_far_from_the_origin_nothing_cancels(spark):
    r = np.random.default_rng(4)
    rows = [(i, (4e4 + r.standard_normal(6) * [5, 4, 3, 2, 1, 0.5]).astype(np.float32).tolist()) for i in range(200)]
    check(spark, rows, 6)


@pytest.mark.parametrize("rank", [7, 12])
def test_factor_and_rotations(rank):
    r = np.random.default_rng(rank)
    b = r.standard_normal((12, rank)) * np.logspace(0, 4, rank)
    a = b @ b.T
    factor, order = W.pivoted_cholesky(a)
    assert factor.shape == (12, rank) and np.allclose(factor @ factor.T, a[np.ix_(order, order)])
    assert (np.triu(factor, 1)[:rank] == 0).all()
    turned = W.one_sided_jacobi(factor)
    gram = turned.T @ turned
    assert np.allclose(gram / np.sqrt(np.outer(gram.diagonal(), gram.diagonal())), np.eye(rank), atol=1e-13)
    assert np.allclose(np.sort(gram.diagonal()), np.linalg.eigvalsh(a)[-rank:], rtol=1e-8, atol=1e-15 * a.trace())


def test_query_gives_longs(spark):
    out = W.op12_whitening(spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes)["deviation"] == "bigint"
    assert out.filter("deviation IS NULL").count() == 0 and out.count() == 2000
