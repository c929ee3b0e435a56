"""Centroid clustering against plain integer k-means, the bound, odd rows."""

import hashlib

import numpy as np
import pytest

from ampere.llm import centroids


def brute(rows, k, dims, rounds, scale=256):
    """rows: (id, list); exact integer k-means by comparing every vector with every centroid."""
    x = [[max(-centroids.LIMIT, min(centroids.LIMIT, int(np.floor(scale * v)))) for v in vec] for _, vec in rows]
    order = sorted(range(len(rows)), key=lambda i: (
        rows[i][0] is None, hashlib.sha256(f"2:{rows[i][0]}".encode()).hexdigest()))
    c = [x[i] for i in order[:k]]

    def assign():
        out = []
        for v in x:
            d = [sum((a - b) ** 2 for a, b in zip(v, m, strict=True)) for m in c]
            out.append((min(d), d.index(min(d))))
        return out

    for _ in range(rounds):
        got = assign()
        for j in range(len(c)):
            mine = [x[i] for i, (_, a) in enumerate(got) if a == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    got = assign()
    inertia = [sum(d for d, a in got if a == j) for j in range(len(c))]
    return sorted(((rows[i][0], a, d, inertia[a], sum(inertia),
                    hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest())
                   for i, (d, a) in enumerate(got)), key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = centroids.cluster(df, **kw).select("vec_id", *centroids.ADDED).collect()
    return sorted(map(tuple, got), key=repr)


@pytest.mark.parametrize("leading", [1, 3, 8])
def test_equals_plain_search(spark, leading):
    r = np.random.default_rng(7)
    centre = r.standard_normal((6, 8))
    rows = [(i, (centre[i % 6] + 0.3 * r.standard_normal(8)).tolist()) for i in range(300)]
    assert run(spark, rows, k=9, dims=8, leading=leading) == brute(rows, 9, 8, 5)


def test_ties_repeats_and_copies(spark):
    rows = [(i, [float(i % 3), 0.0]) for i in range(40)] + [(5, [2.0, 0.0])] * 7 + [(None, [0.5, 0.5])] * 2
    assert run(spark, rows, k=12, dims=2, rounds=3) == brute(rows, 12, 2, 3)


def test_fewer_rows_than_clusters_and_none(spark):
    rows = [(1, [0.1, -0.2]), (2, [1.0, 1.0])]
    assert run(spark, rows, k=40, dims=2) == brute(rows, 40, 2, 5)
    assert run(spark, [], dims=2) == []


def test_unusable_vectors_are_left_out(spark):
    good = [(i, [float(i), -1.0]) for i in range(10)]
    bad = [(100, None), (101, []), (102, [1.0]), (103, [1.0, None]), (104, [float("nan"), 1.0]),
           (105, [float("inf"), 1.0]), (106, [1.0, 2.0, 3.0])]
    assert run(spark, good + bad, k=4, dims=2) == brute(good, 4, 2, 5)


def test_huge_components_are_clipped(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [1e6, 1.0]), (4, [0.0, 0.5])]
    assert run(spark, rows, k=2, dims=2) == brute(rows, 2, 2, 5)


def test_other_columns_pass_and_clashing_ones_are_replaced(spark):
    df = spark.createDataFrame([(1, [0.5], "a", 9, b"k")], "vec_id long, embedding array<float>, Cluster string, _x int, _p binary")
    out = centroids.cluster(df, dims=1)
    assert out.columns == ["vec_id", "embedding", "_x", "_p", *centroids.ADDED]
    (row,) = out.collect()
    assert (row._x, bytes(row._p), row.cluster, row.distance) == (9, b"k", 0, 0)


def test_the_bound_spares_most_verifications():
    r = np.random.default_rng(3)
    centre = r.standard_normal((40, 64))
    x = centroids.integers((centre[r.integers(0, 40, 2000)] + 0.2 * r.standard_normal((2000, 64))).ravel(), 64)
    c = centroids.integers(centre.ravel(), 64)
    mean = x.mean(0)
    basis = np.linalg.eigh(np.cov(x.T))[1][:, ::-1]
    p, q = centroids.rotate(x, mean, basis, 16), centroids.rotate(c, mean, basis, 16)
    best, least, verified = centroids.nearest(x, p, c, q)
    d = ((x[:, None, :] - c[None]) ** 2).sum(2)
    assert (best == d.argmin(1)).all() and (least == d.min(1)).all()
    low = ((p[:, None, :] - q[None]) ** 2).sum(2)
    assert (low <= d * (1 + 1e-9) + 1e-6).all()
    assert verified < 0.2 * d.size
