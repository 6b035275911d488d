"""A history fed in batches equals the same draws numbered and windowed at once."""

import random

import pytest
from pyspark.sql import functions as F

from drawlake.operators.features import window_stats
from drawlake.operators.sequence import global_sequence
from drawlake.operators.windows import window_arrays
from drawlake.sources import snapshots as S
from drawlake.streaming import history as H
from tests.conftest import draws_df, random_draws

ORDER = ["draw_date", "draw_number"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def windows(df):
    def plain(v):
        return tuple(None if x != x else x for x in v) if isinstance(v, list) else v
    return sorted(tuple(plain(v) for v in r) for r in df.select("seq", "lagged", "frequency", "recency").collect())


def test_any_split_equals_one_batch(spark, tmp_path, seed=1):
    rnd = random.Random(seed)
    data = random_draws(140, seed=seed, null_every=11, repeat_every=13)
    rnd.shuffle(data)
    cuts = sorted(rnd.sample(range(1, 140), 2))
    path = str(tmp_path / "h")
    for a, b in zip([0, *cuts], [*cuts, 140]):
        H.append_draws(path, draws_df(spark, data[a:b]), ORDER, window=7, lags=3, file_rows=16, chunk=10)
        want = global_sequence(draws_df(spark, data[:b]), ORDER)
        got = H.read_history(spark, path)
        assert rows(got.select(*want.columns)) == rows(want)
        assert windows(H.read_windows(spark, path)) == windows(window_arrays(want, 7, lags=3))
    assert rows(H.stored_window_stats(spark, path)) == rows(window_stats(want, 7, 3))
    assert rows(H.read_history(spark, path, first=30, last=41)) == rows(got.where("seq between 30 and 41"))
    many = S.snapshot_files(spark, path)
    assert len(many) >= 6
    H.append_draws(path, draws_df(spark, []), ORDER, window=7, lags=3)
    assert S.snapshot_files(spark, path) == many


def test_a_late_draw_rewrites_one_file(spark, tmp_path):
    path = str(tmp_path / "h")
    data = random_draws(600, unique_dates=True)
    late = data.pop(300)
    H.append_draws(path, draws_df(spark, data), ORDER, file_rows=40)
    before = {s["file"]: s for s in H._opened(spark, path, None)[2]}
    H.append_draws(path, draws_df(spark, [late]), ORDER, file_rows=40)
    after = {s["file"]: s for s in H._opened(spark, path, None)[2]}
    assert len(before.keys() - after.keys()) == 1 and len(before) > 10
    kept = before.keys() & after.keys()
    assert sum(before[f]["features"] != after[f]["features"] for f in kept) <= 2  # the files right after it
    want = global_sequence(draws_df(spark, [*data, late]), ORDER)
    assert rows(H.read_history(spark, path).select(*want.columns)) == rows(want)
    assert windows(H.read_windows(spark, path)) == windows(window_arrays(want, 20, lags=5))
    # The old snapshot still answers; once it expires its files and windows go.
    assert H.read_history(spark, path, 1).count() == 599
    assert S.expire_snapshots(spark, path, keep=1) >= 2
    assert windows(H.read_windows(spark, path)) == windows(window_arrays(want, 20, lags=5))


def test_new_draws_leave_old_files(spark, tmp_path):
    path, data = str(tmp_path / "h"), random_draws(200, unique_dates=True)
    H.append_draws(path, draws_df(spark, data[:160]), ORDER, file_rows=20)
    before = {s["file"]: s["features"] for s in H._opened(spark, path, None)[2]}
    H.append_draws(path, draws_df(spark, data[160:]), ORDER, file_rows=20)
    after = {s["file"]: s["features"] for s in H._opened(spark, path, None)[2]}
    assert len(before.items() - after.items()) <= 1  # at most the last, half-full file


def test_ties_nulls_and_equal_rows(spark, tmp_path):
    path = str(tmp_path / "h")
    some = draws_df(spark, random_draws(12)).withColumn("draw_date", F.when(F.col("draw_number") % 3 > 0, F.to_date(F.lit("2020-01-01"))))
    for batch in (some.where("draw_number % 2 = 0"), some.where("draw_number % 2 = 1"), some.limit(2)):
        H.append_draws(path, batch, ["draw_date"], window=4, lags=2, file_rows=5)
    got = H.read_history(spark, path)
    seqs = got.orderBy("seq").select("seq", "draw_date").collect()
    assert [r.seq for r in seqs] == list(range(1, 15))
    assert [r.draw_date is None for r in seqs] == sorted((r.draw_date is None for r in seqs), reverse=True)
    assert windows(H.read_windows(spark, path)) == windows(window_arrays(got, 4, lags=2))


def test_writers_and_settings(spark, tmp_path):
    path, data = str(tmp_path / "h"), random_draws(30)
    first, second = draws_df(spark, data[:20]), draws_df(spark, data[20:])
    met = []

    def someone_else():
        if not met:
            met.append(H.append_draws(path, second, ORDER, writer=("b", 0)))

    assert H.append_draws(path, first, ORDER, writer=("a", 0), before_commit=someone_else) == 2 and met == [1]
    assert H.append_draws(path, first, ORDER, writer=("a", 0)) == 2  # a batch tried again
    want = global_sequence(draws_df(spark, data), ORDER)
    assert rows(H.read_history(spark, path).select(*want.columns)) == rows(want)
    with pytest.raises(ValueError):
        H.append_draws(path, first, ORDER, window=5)
    with pytest.raises(ValueError):
        H.append_draws(path, first.withColumn("x", F.lit(1)), ORDER)
    with pytest.raises(ValueError):
        H.append_draws(path, first.withColumn("draw_date", F.col("draw_date").cast("timestamp")), ORDER)
    with pytest.raises(FileNotFoundError):
        H.read_history(spark, str(tmp_path / "none"))
