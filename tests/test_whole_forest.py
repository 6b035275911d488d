"""Forests of whole tables: every row sets thresholds, every tree draws as many rows as there are."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from drawlake.operators import forest as T
from drawlake.operators.features import sliding_features
from drawlake.operators.ml import fit_multilabel_forest
from drawlake.operators.picks import pick_top_k
from drawlake.operators.sequence import global_sequence
from drawlake.schemas import Pool
from tests.conftest import draws_df, random_draws
from tests.test_forest_logistic import plain_predict, plain_tree, table

FEW = (Pool("main", ("ball_1", "ball_2"), 1, 3), Pool("star", ("lucky_star_1",), 1, 2))


def test_a_value_outside_the_first_rows_by_hash_is_split_off(spark):
    n = 10_200
    late = {r.id for r in spark.range(n).orderBy(F.xxhash64("id"), "id").collect()[-100:]}
    rows = spark.createDataFrame([(k, [2.0 if k in late else float(k % 2)], [float(k in late)]) for k in range(n)],
                                 "seq long, features array<double>, y array<double>")
    asked = rows.where(F.col("seq").isin(sorted(late)[:1]))
    got = T.forest_probabilities(rows, asked, [(1.0, 1.0)], num_trees=3, max_depth=3, max_samples=None).collect()
    assert [r.probability for r in got] == [1.0]


def test_thresholds_of_all_rows(spark):
    x = np.random.default_rng(3).integers(0, 400, (12_000, 2)).astype(float)
    x[:, 1] %= 7
    rows = spark.createDataFrame([(r.tolist(),) for r in x], "features array<double>").repartition(6)
    got = T.all_split_points(rows, 2)
    assert [p.tolist() for p in got] == [T.split_points(x[:, k]).tolist() for k in range(2)]


def test_trees_draw_as_many_rows_as_there_are(spark):
    n = 2_600
    x, y, rows = table(spark, n, width=4, labels=2)
    asked, weights = rows.where(f"seq >= {n - 3}"), [(3.0, 0.6), (1.0, 1.0)]
    got = {(r.seq, r.label): r.probability for r in T.forest_probabilities(rows.repartition(5), asked, weights, num_trees=2, max_depth=3).collect()}
    points = [T.split_points(x[:, k]) for k in range(4)]
    bins = np.stack([np.searchsorted(points[k], x[:, k]) for k in range(4)], axis=1)
    drawn = T.drawn_trees(rows.select("seq"), "seq", 2, 1.0, 42).collect()
    for label in range(2):
        trees = []
        for t in range(2):
            own = [r.seq for r in drawn if r.tree == t]
            assert abs(len(own) - n) < 6 * n ** 0.5
            trees.append(plain_tree([bins[k].tolist() for k in own], [int(y[k, label]) for k in own], weights[label], 42, t, label, 3, 2))
        for k in range(n - 3, n):
            assert got[(k, label)] == pytest.approx(sum(plain_predict(t, bins[k].tolist()) for t in trees) / 2, abs=1e-12)


@pytest.fixture(scope="module")
def long_sequence(spark):
    rows = [(k, d, 1 + a % 3, 1 + b % 3, 1, 1, 1, 1 + c % 2, 1)
            for k, (_, d, a, b, c, *_) in enumerate(random_draws(2_400, unique_dates=True), 1)]
    return global_sequence(draws_df(spark, rows), ["draw_date", "draw_number"])


def scores_of(features, **kwargs):
    return {(r.pool, r.number): r.probability
            for r in fit_multilabel_forest(features, FEW, num_trees=3, max_depth=3, **kwargs).collect()}


def test_the_default_forest_is_that_of_all_draws(long_sequence):
    features = sliding_features(long_sequence, lags=1, window=2, pools=FEW)
    assert scores_of(features) == scores_of(features, max_samples=None) != scores_of(features, max_samples=2_048)


def test_bins_in_a_file_give_the_same_forest(spark, long_sequence, monkeypatch):
    features = sliding_features(long_sequence, lags=1, window=2, pools=FEW)
    in_memory = scores_of(features)
    monkeypatch.setattr(T, "IN_MEMORY", 0)
    assert scores_of(features) == in_memory and len(in_memory) == 5


@pytest.mark.parametrize("large,together", [(1, 1), (40, 64), (1 << 20, 1 << 20)])
def test_a_tree_does_not_depend_on_which_nodes_are_counted_together(monkeypatch, large, together):
    rng = np.random.default_rng(7)
    bins = rng.integers(0, 9, (700, 12)).astype(np.uint8)
    y = (rng.random(700) < 0.05 + 0.08 * bins[:, 3]).astype(np.uint8)
    times = rng.poisson(1, 700).astype(np.uint8)
    drawn = np.repeat(np.arange(700), times)
    expected = T.grow(bins[drawn], y[drawn], (2.5, 0.625), 42, 0, 1, 7, 4)
    monkeypatch.setattr(T, "LARGE", large)
    monkeypatch.setattr(T, "TOGETHER", together)
    assert T.grow(np.asfortranarray(bins), y, (2.5, 0.625), 42, 0, 1, 7, 4, times, 9) == expected and len(expected) > 50


def test_picks_of_the_next_draw_come_from_all_draws(long_sequence):
    features = sliding_features(long_sequence, lags=1, window=2, pools=FEW, mode="next")
    scores = {k: fit_multilabel_forest(features, FEW, mode="next", num_trees=3, max_depth=3, **kwargs)
              for k, kwargs in {"default": {}, "all": {"max_samples": None}, "some": {"max_samples": 2_048}}.items()}
    rows = {k: sorted(map(tuple, v.collect())) for k, v in scores.items()}
    assert rows["default"] == rows["all"] != rows["some"] and {r[0] for r in rows["all"]} == {2_401}
    assert (sorted(map(tuple, pick_top_k(scores["default"], "probability").collect()))
            == sorted(map(tuple, pick_top_k(scores["all"], "probability").collect())))
