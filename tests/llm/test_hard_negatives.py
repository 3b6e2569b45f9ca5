import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives as H
from strata.llm.vectors import largest

SCHEMA = "vec_id long, label int, embedding array<float>, row string, x string, score string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, l, v, "r", "x", "s") for i, l, v in rows], SCHEMA)


def brute(rows, every, keep=5):
    """All results by comparing every anchor with every row."""
    fit = [(i, l, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, l, v in rows
           if None not in (i, l) and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for a, (i, l, v) in enumerate(fit):
        if i % every:
            continue
        score = [(-sum(p * q for p, q in zip(v, w)), j, m) for k, (j, m, w) in enumerate(fit) if k != a]
        for ps, p, _ in sorted(s for s in score if s[2] == l)[:keep]:
            wrong = sorted(s for s in score if s[2] != l and 80 * -ps <= 100 * -s[0] <= 100 * -ps)[:keep]
            out += [(i, p, r, n, -ps, -ns) for r, (ns, n, _) in enumerate(wrong, 1)]
    return sorted(out)


def got(spark, rows, every):
    found = H.hard_negatives(vectors(spark, rows), F.col("vec_id") % every == 0)
    return sorted(tuple(r) for r in found.collect())


def clustered(n, seed, width=12, labels=4, spread=0.2):
    r = np.random.default_rng(seed)
    middle = r.standard_normal((8, width))
    at = r.integers(0, 8, n)
    x = middle[at] + spread * r.standard_normal((n, width))
    x *= r.uniform(0.2, 2.0, (n, 1))  # many lengths
    return [(i, int(r.integers(0, labels)), x[i].astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("size", [16, 4096])
def test_equals_brute_force_over_buckets_of_any_size(spark, monkeypatch, size):
    rows = clustered(400, 3)
    monkeypatch.setattr(H, "BUCKET_ROWS", size)
    assert got(spark, rows, 10) == brute(rows, 10) != []


def test_blocks_of_anchors_give_the_same(spark, monkeypatch):
    rows = clustered(200, 4)
    monkeypatch.setattr(H, "BLOCK_ANCHORS", 7)
    assert got(spark, rows, 5) == brute(rows, 5)


def test_coordinate_ranges_prune_without_loss():
    r = np.random.default_rng(5)
    x = r.standard_normal((3000, 16))
    x[::3] = x[0] + 0.05 * r.standard_normal((1000, 16))
    x = np.floor(1024 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)  # a bucket's rows are of like length
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    lists = np.argsort(unit, axis=0, kind="stable").T.astype("<u2")
    bucket = H.Bucket({"row": range(3000), "vec_id": range(3000), "label": [i % 2 for i in range(3000)],
                       "bytes": 4, "vectors": x.astype("<i4").tobytes(), "lists": lists.tobytes()}, 16)
    truth = np.array([int(v @ x[0]) for v in x])
    lower = int(0.95 * truth[0])
    scored = []
    multiply = np.ndarray.__matmul__

    class Watched(np.ndarray):
        def __matmul__(self, other):
            scored.append(len(self))
            return multiply(np.asarray(self), np.asarray(other))

    bucket.values = bucket.values.view(Watched)
    anchors = H.Anchors(np.array([0]), np.array([0]), np.array([0]), x[:1], np.array([[lower]]),
                        np.array([[int(truth.max())]]), 10_000, False)
    place, level, ids, rows, score = anchors.search([bucket], 16)
    want = [i for i in range(3000) if i % 2 and truth[i] >= lower]
    assert sorted(ids.tolist()) == want and len(want) > 400
    assert sum(scored) < 1200  # of 3,000 rows


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (None, 1, [1.0, 0.0]), (1, None, [1.0, 0.0]), (2, 1, None), (3, 1, [1.0, None]),
            (4, 1, [nan, 1.0]), (5, 2, [inf, 0.0]), (6, 1, [0.9, 0.1]), (7, 2, [0.9, 0.1]), (8, 2, [0.9, 0.1]),
            (9, 2, [0.9]), (10, 3, []), (20, 3, [0.0, 0.0]), (11, 4, [-1.0, 0.5]), (30, 4, [1.0, -0.5]),
            (6, 1, [0.9, 0.1]), (7, 2, [0.9, 0.1])]
    def pad(v):
        return v if v is None or len(v) > 1 else (v + [0.0, 0.0])[:2]

    assert got(spark, rows, 10) == brute([(i, l, pad(v)) for i, l, v in rows], 10) != []


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, i % 2, [1.0, 2.0]) for i in range(40)]
    assert got(spark, rows, 10) == brute(rows, 10)


def test_large_values_are_exact_and_impossible_ones_raise(spark):
    rows = [(0, 1, [3e6, 1.0]), (1, 1, [3e6, 2.0]), (2, 2, [3e6, 1.5]), (3, 2, [3e6, 0.5])]
    assert got(spark, rows, 10) == brute(rows, 10) != []
    with pytest.raises(Exception, match="does not fit into a long"):
        got(spark, [(0, 1, [3e30]), (1, 1, [3e30])], 10)


def test_empty_table_and_no_anchor(spark):
    rows = [(1, 1, [1.0]), (2, 2, [1.0])]
    assert got(spark, rows, 10) == []
    assert H.hard_negatives(vectors(spark, rows).limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_largest_of_the_ends():
    assert largest(np.array([[-2**63, 5]])) == 2**63
    assert largest(np.zeros((0, 3), np.int64)) == 0
