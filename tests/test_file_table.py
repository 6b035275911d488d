"""The table of files: what a merge rewrites, two writers, batches, expiry."""

import random

import pytest
from pyspark.sql import functions as F

from drawlake.operators.merge import upsert
from drawlake.sources import snapshots as S


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture
def big(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert S.create_table(path, table, ["k"], file_rows=1_000) == 1
    return path, table


def test_a_small_merge_leaves_most_files(spark, big):
    path, table = big
    before = set(S.snapshot_files(spark, path))
    assert len(before) >= 90
    changes = spark.range(40_000, 40_100).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v"))
    assert S.merge_into(path, changes, ["k"]) == 2
    after = set(S.snapshot_files(spark, path))
    assert len(before - after) < 0.05 * len(before) and len(after - before) <= 2
    got = S.read_latest(spark, path)
    assert got.count() == 100_000 and got.where("v = -1").count() == 100
    assert rows(S.read_snapshot(spark, path, 1).where("k between 39990 and 40010")) == rows(table.where("k between 39990 and 40010"))


def test_ranges_that_meet_without_a_common_key_rewrite_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    S.create_table(path, spark.range(0, 20_000, 2).select(F.col("id").alias("k"), F.lit("a").alias("s")), ["k"], file_rows=500)
    before = set(S.snapshot_files(spark, path))
    S.merge_into(path, spark.createDataFrame([(101, "b"), (19_001, "c")], "k long, s string"), ["k"])
    assert before < set(S.snapshot_files(spark, path)) and S.read_latest(spark, path).count() == 10_002


def test_random_merges_equal_upsert(spark, tmp_path):
    rnd = random.Random(4)
    path, columns = str(tmp_path / "t"), "k int, d string, v int, w int"
    def some(n, null_every=9):
        return [(None if rnd.random() < 1 / null_every else rnd.randint(0, 40), rnd.choice("ab"), rnd.randint(0, 9), k) for k in range(n)]
    target = spark.createDataFrame(some(120), columns)  # keys repeat
    S.create_table(path, target, ["k", "d"], file_rows=10)
    want = target
    for step in range(3):
        source = spark.createDataFrame(some(15), columns)
        if step == 1:
            source = source.drop("v")  # a column that the source lacks
        want = spark.createDataFrame(upsert(want, source, ["k", "d"], order_col="w").collect(), columns)
        assert S.merge_into(path, source, ["k", "d"], order_col="w", file_rows=10) == step + 2
        assert rows(S.read_latest(spark, path)) == rows(want)
    assert S.merge_into(path, spark.createDataFrame([], columns), ["k", "d"]) == 5
    assert rows(S.read_latest(spark, path)) == rows(want)


def test_a_key_that_most_rows_share(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(4_000).select(F.when(F.col("id") < 3_000, 7).otherwise(F.col("id")).cast("long").alias("k"), F.col("id").alias("v"))
    S.create_table(path, table, ["k"], file_rows=500)
    sizes = [r["rows"] for r in S._manifest(spark, path, S._latest(spark, path)).collect()]
    assert max(sizes) < 1_200
    S.merge_into(path, spark.createDataFrame([(7, 0)], "k long, v long"), ["k"], file_rows=500)
    assert S.read_latest(spark, path).where("k = 7 and v = 0").count() == 3_000


def test_two_writers(spark, big):
    path, _ = big
    other = spark.createDataFrame([(5, 50), (200_000, 1)], "k long, v long")
    mine = spark.createDataFrame([(5, 55), (6, 66)], "k long, v long")
    met = []

    def someone_else():
        if not met:
            met.append(S.merge_into(path, other, ["k"]))

    assert S.merge_into(path, mine, ["k"], before_commit=someone_else) == 3 and met == [2]
    got = {r.k: r.v for r in S.read_latest(spark, path).where("k in (5, 6, 200000)").collect()}
    assert got == {5: 55, 6: 66, 200_000: 1}  # mine came after the other one's
    met.clear()
    with pytest.raises(S.CommitConflict):
        S.merge_into(path, spark.createDataFrame([(5, 0)], "k long, v long"), ["k"], attempts=1, before_commit=someone_else)
    assert S.latest_snapshot_id(spark, path) == 4 and {r.v for r in S.read_latest(spark, path).where("k = 5").collect()} == {50}
    with pytest.raises(S.CommitConflict):
        S.create_table(path, mine, ["k"])


def test_batches_are_merged_once(spark, tmp_path):
    path = str(tmp_path / "t")
    row = lambda v: spark.createDataFrame([(1, v)], "k int, v int")
    assert S.merge_into(path, row(1), ["k"], writer=("a", 0)) == 1
    assert S.merge_into(path, row(2), ["k"], writer=("b", 0)) == 2
    assert S.merge_into(path, row(9), ["k"], writer=("a", 0)) == 1
    assert S.merge_into(path, row(3), ["k"], writer=("a", 1)) == 3
    assert rows(S.read_latest(spark, path)) == [(1, 3)]


def test_expiry(spark, big):
    path, _ = big
    for k in range(3):
        S.merge_into(path, spark.createDataFrame([(10_000 * k, -k)], "k long, v long"), ["k"])
    want = rows(S.read_latest(spark, path).where("k % 10000 = 0"))
    gone = S.expire_snapshots(spark, path, keep=2)
    assert 2 <= gone <= 4 and S._numbers(spark, path) == [3, 4]
    assert rows(S.read_latest(spark, path).where("k % 10000 = 0")) == want
    assert S.read_snapshot(spark, path, 3).count() == 100_000
    assert S.expire_snapshots(spark, path, keep=2) == 0
    with pytest.raises(ValueError):
        S.expire_snapshots(spark, path, keep=0)
