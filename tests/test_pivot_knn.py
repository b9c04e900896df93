"""Exact k-NN on pivot cells against brute force, with skew, copies and ties."""

import numpy as np
import pytest

from panelcraft.operators import sampling as smp
from panelcraft.operators.pivot_knn import pivot_search


def brute(ids, x, k):
    out = {}
    for i, q in zip(ids, x):
        d = np.sqrt(((x - q) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
        out[int(i)] = [(int(ids[j]), d[j]) for j in order]
    return out


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], "id long, v array<double>")


def clusters(rows, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(0, 100, (20, 3))[rng.integers(0, 20, rows)] + rng.normal(0, 1, (rows, 3))


@pytest.mark.parametrize("case", ["clusters", "copies", "grid", "one place"])
def test_equals_brute_force(spark, case):
    rng = np.random.default_rng(1)
    x = {"clusters": clusters(400),
         "copies": np.concatenate([np.tile([1.0, 2.0, 3.0], (150, 1)), clusters(250)]),       # a hot vector
         "grid": rng.integers(0, 5, (400, 2)).astype(float),                                  # ties everywhere
         "one place": np.zeros((60, 2))}[case]
    ids = rng.permutation(len(x)) * 3 - 50
    want = brute(ids, x, 4)
    got = {}
    for r in smp.knn_within(frame(spark, ids, x), "id", "v", 4, block_rows=24).collect():
        got.setdefault(r["id"], {})[r["nn_rank"]] = (r["nn_id"], r["dist"])
    assert set(got) == set(want)
    for i, near in got.items():
        assert sorted(near) == [1, 2, 3, 4]
        assert [near[r][0] for r in (1, 2, 3, 4)] == [j for j, _ in want[i]]
        assert np.allclose([near[r][1] for r in (1, 2, 3, 4)], [d for _, d in want[i]])


def test_fewer_rows_than_neighbours(spark):
    x = np.array([[0.0], [1.0], [3.0]])
    got = smp.knn_within(frame(spark, [1, 2, 3], x), "id", "v", 9, block_rows=1)
    assert sorted((r["id"], r["nn_rank"], r["nn_id"]) for r in got.collect()) == [
        (1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 2), (3, 2, 1)]
    assert smp.knn_within(frame(spark, [], x[:0]), "id", "v", 3, block_rows=1).collect() == []


def test_most_tiles_are_not_compared(spark):
    """On clustered points a small part of all pairs is compared, less the more points there are."""
    shares = []
    for rows in (500, 2000):
        points = frame(spark, range(rows), clusters(rows)).withColumnRenamed("v", "vec")
        best, report = pivot_search(points, 3, 50, smp._knn_block)
        assert best.count() == 3 * rows and report["points"] == rows
        shares.append(report["pairs"] / rows ** 2)
    assert shares[1] < shares[0] < 0.5
