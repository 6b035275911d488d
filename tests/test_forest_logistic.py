"""The one-job forest against a plain tree builder, the Newton fit against NumPy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from drawlake.operators import forest as T
from drawlake.operators import logistic as L


def gini(p, n):
    return 2 * p * n / (p + n) if p + n else 0.0


def plain_tree(rows, y, weights, seed, tree, label, max_depth, take, node=1, depth=0):
    """Nested (feature, edge, left, right) or a share, one node at a time."""
    wp, wn = weights
    pos = sum(y)
    share = wp * pos / (wp * pos + wn * (len(y) - pos))
    if pos in (0, len(y)) or depth == max_depth:
        return share
    width = len(rows[0])
    hashes = [(int(T.mixed(seed, tree, label, node, f)), f) for f in range(width)]
    best = None
    for _, f in sorted(hashes)[:take]:
        for edge in sorted({r[f] for r in rows})[:-1]:
            left = [t for r, t in zip(rows, y, strict=True) if r[f] <= edge]
            lp, rp = sum(left), pos - sum(left)
            cost = gini(wp * lp, wn * (len(left) - lp)) + gini(wp * rp, wn * (len(y) - len(left) - rp))
            if best is None or (cost, f, edge) < best:
                best = (cost, f, edge)
    if best is None or not best[0] < gini(wp * pos, wn * (len(y) - pos)) * (1 - 1e-12):
        return share
    _, f, edge = best
    side = [r[f] > edge for r in rows]
    kids = [plain_tree([r for r, s in zip(rows, side, strict=True) if s == k], [t for t, s in zip(y, side, strict=True) if s == k],
                       weights, seed, tree, label, max_depth, take, 2 * node + k, depth + 1) for k in (0, 1)]
    return f, edge, *kids


def plain_predict(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2 + (row[tree[0]] > tree[1])]
    return tree


@pytest.mark.parametrize("take", [2, 7])
@pytest.mark.parametrize("depth", [0, 1, 6])
def test_a_tree_equals_the_plain_builder(take, depth):
    rng = np.random.default_rng(depth)
    bins = rng.integers(0, 5, (80, 7)).astype(np.uint8)
    y = (rng.random(80) < 0.2 + 0.1 * bins[:, 3]).astype(np.uint8)
    for tree in range(4):
        nodes = T.grow(bins, y, (2.5, 0.625), 42, tree, 1, depth, take)
        plain = plain_tree(bins.tolist(), y.tolist(), (2.5, 0.625), 42, tree, 1, depth, take)
        for row in rng.integers(0, 5, (40, 7)):
            assert T.predict(nodes, row) == plain_predict(plain, row.tolist())


def table(spark, n, width=6, labels=3):
    rng = np.random.default_rng(9)
    x = rng.integers(0, 9, (n, width)).astype(float)
    y = (rng.random((n, labels)) < 0.15 + x[:, :labels] / 14).astype(int)
    return x, y, spark.createDataFrame([(k, x[k].tolist(), y[k].astype(float).tolist()) for k in range(n)],
                                       "seq long, features array<double>, y array<double>")


def test_a_forest_equals_plain_trees(spark):
    x, y, rows = table(spark, 120)
    asked = rows.where("seq >= 117")
    weights = [(3.0, 0.6), (1.0, 1.0), (2.0, 0.5)]
    points = [T.split_points(x[:, k]) for k in range(6)]
    bins = np.stack([np.searchsorted(points[k], x[:, k]) for k in range(6)], axis=1)
    rate = {}
    drawn = T.drawn_trees(rows.select("seq"), "seq", 5, 1.0, 42).collect()
    for bootstrap in (False, True):
        got = {(r.seq, r.label): r.probability for r in T.forest_probabilities(
            rows.repartition(5), asked, weights, num_trees=5, max_depth=4, max_samples=None, bootstrap=bootstrap).collect()}
        for label in range(3):
            trees = []
            for t in range(5):
                own = [r.seq for r in drawn if r.tree == t] if bootstrap else range(120)
                trees.append(plain_tree([bins[k].tolist() for k in own], [int(y[k, label]) for k in own], weights[label], 42, t, label, 4, 2))
            for k in (117, 118, 119):
                assert got[(k, label)] == pytest.approx(sum(plain_predict(t, bins[k].tolist()) for t in trees) / 5, abs=1e-12)
        rate[bootstrap] = got
    assert rate[True] != rate[False]


def test_draws_are_poisson(spark):
    rows = spark.range(4000).select(F.col("id").alias("seq"))
    per = [r["count"] for r in T.drawn_trees(rows, "seq", 20, 0.25, 3).groupBy("tree").count().collect()]
    assert len(per) == 20 and all(abs(n - 1000) < 160 for n in per)
    pairs = T.drawn_trees(rows, "seq", 20, 0.25, 3).groupBy("tree", "seq").count().groupBy("count").agg(F.count("*").alias("n"))
    seen = {r["count"]: r["n"] / 80_000 for r in pairs.collect()}
    assert seen[1] == pytest.approx(0.25 * math.exp(-0.25), rel=0.05) and seen[2] == pytest.approx(0.125 * 0.25 * math.exp(-0.25), rel=0.2)
    assert T.drawn_trees(rows, "seq", 20, 0.25, 3).exceptAll(T.drawn_trees(rows.repartition(9), "seq", 20, 0.25, 3)).count() == 0
    with pytest.raises(ValueError):
        T.drawn_trees(rows, "seq", 1000, 1.0, 3)


def test_split_points():
    assert T.split_points(np.array([3.0, 1, 1, 2])).tolist() == [1.5, 2.5]
    assert T.split_points(np.array([5.0])).tolist() == []
    many = T.split_points(np.arange(10_000.0))
    assert len(many) == 63 and np.abs(many - np.arange(1, 64) * 156.25).max() < 2


def numpy_logistic(x, y, pos, reg):
    """Plain Newton on the whole table, long after convergence."""
    z = (x - x.mean(axis=0)) / np.where(x.std(axis=0) > 0, x.std(axis=0), 1)
    z = np.concatenate([z, np.ones((len(x), 1))], axis=1)
    ridge = np.append(np.full(x.shape[1], reg * len(x)), 0)
    w, beta = np.where(y == 1, pos, 1.0), np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ beta))
        beta = beta - np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (w * (p - y)) + ridge * beta)
    return beta


@pytest.mark.parametrize("fan_in", [64, 2])
def test_coefficients_equal_numpy(spark, monkeypatch, fan_in):
    monkeypatch.setattr(L, "FAN_IN", fan_in)
    x, y, rows = table(spark, 400)
    x = np.concatenate([x, 9 - x[:, :1], np.full((400, 1), 4.0)], axis=1)  # a collinear and a constant feature
    rows = spark.createDataFrame([(k, x[k].tolist(), y[k].astype(float).tolist()) for k in range(400)],
                                 "seq long, features array<double>, y array<double>").repartition(7, "seq")
    pos = [1.0, 4.0, 0.3]
    model = L.fit(rows, pos)
    assert model.scans < 12
    for j in range(3):
        assert model.beta[j] == pytest.approx(numpy_logistic(x, y[:, j], pos[j], 1e-4), abs=1e-6)
    p = {r.seq: list(r.probability) for r in model.probabilities(rows.select("seq", "features")).collect()}
    z = np.append((x[5] - model.mean) / model.scale, 1)
    assert p[5] == pytest.approx((1 / (1 + np.exp(-model.beta @ z))).tolist(), abs=1e-12)


def test_raised_losses_are_halved(spark):
    """Separable classes of very unequal weight make full Newton steps overshoot."""
    rows = spark.createDataFrame([(k, [float(k ** 3)], [float(k > 36)]) for k in range(40)], "seq long, features array<double>, y array<double>")
    model = L.fit(rows, [1000.0], reg_param=1e-6, max_scans=60)
    assert np.isfinite(model.beta).all()
    p = [r.probability[0] for r in model.probabilities(rows.select("seq", "features")).orderBy("seq").collect()]
    assert max(p[:37]) < 0.5 < min(p[37:])
