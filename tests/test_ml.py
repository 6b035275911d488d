"""Model fits on small tables: one-class labels, null lags, which row is predicted, every draw counted."""

import pytest
from pyspark.sql import functions as F

from drawlake.operators.features import sliding_features
from drawlake.operators.ml import fit_multilabel_forest, fit_multilabel_logistic, split_last
from drawlake.operators.sequence import global_sequence
from drawlake.schemas import Pool
from tests.conftest import draws_df, random_draws

FEW = (Pool("main", ("ball_1", "ball_2"), 1, 3), Pool("star", ("lucky_star_1",), 1, 2))


@pytest.fixture(scope="module")
def sequence(spark):
    rows = [(n, d, 1 + n % 2, 1, 1, 1, 1, 2, None if n % 3 else 1) for n, d, *_ in random_draws(40, unique_dates=True)]
    return global_sequence(draws_df(spark, rows), ["draw_date", "draw_number"])


@pytest.mark.parametrize("mode,seq", [("holdout", 40), ("next", 41)])
def test_one_class_labels_and_null_lags(spark, sequence, mode, seq):
    pools = (Pool("main", ("ball_1",), 1, 3), Pool("star", ("lucky_star_1", "lucky_star_2"), 1, 3))
    features = sliding_features(sequence, lags=2, window=4, pools=pools, mode=mode)
    got = {}
    for r in fit_multilabel_logistic(features, pools, mode=mode).collect():
        assert r.seq == seq and 0 <= r.probability <= 1
        got[(r.pool, r.number)] = r.probability
    assert set(got) == {(p, n) for p in ("main", "star") for n in (1, 2, 3)}
    assert got[("main", 3)] == 0.0 and got[("star", 2)] == 1.0 and got[("star", 3)] == 0.0  # one class: its rate


def test_forest_does_not_depend_on_partitions(spark, sequence):
    features = sliding_features(sequence, lags=2, window=4, pools=FEW)
    small = [tuple(r) for r in fit_multilabel_forest(features, FEW, num_trees=3, max_depth=2, max_samples=12).collect()]
    again = [tuple(r) for r in fit_multilabel_forest(features.repartition(3), FEW, num_trees=3, max_depth=2, max_samples=12).collect()]
    assert sorted(small) == sorted(again) and len(small) == 5


def test_every_draw_trains(spark):
    """A number drawn only outside the first 2,000 draws by hash is neither impossible nor unweighted."""
    n = 2_100
    late = {r.id for r in spark.range(1, n + 1).orderBy(F.xxhash64("id"), "id").collect()[-20:]}
    rows = [(k, d, 3 if k in late else 1 + k % 2, 1, 1, 1, 1, 2, 1)
            for k, (_, d, *_) in enumerate(random_draws(n, unique_dates=True), 1)]
    pools = (Pool("main", ("ball_1",), 1, 3),)
    features = sliding_features(global_sequence(draws_df(spark, rows), ["draw_date", "draw_number"]), lags=1, window=2, pools=pools)
    got = {r.number: r.probability for r in fit_multilabel_logistic(features, pools).collect()}
    assert set(got) == {1, 2, 3} and 0 < got[3] < 1


def test_split(spark, sequence):
    features = sliding_features(sequence, lags=1, window=2, pools=FEW, mode="next")
    train, predict = split_last(features, "next")
    assert [r.seq for r in predict.collect()] == [41] and train.count() == 38
    with pytest.raises(ValueError):
        split_last(features, "other")
