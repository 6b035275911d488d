"""Uniqueness kept beside a growing table equals the check over all of its rows."""

import random

import pytest
from pyspark.sql import functions as F

from drawlake.operators.reconcile import check_constraints, find_duplicates
from drawlake.sources import snapshots as S
from drawlake.sources import unique_keys as U

COLUMNS = "k int, d string, v int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def looked(spark, path):
    return S._latest(spark, path).settings["files_looked_at"]


def test_random_batches_equal_the_whole_check(spark, tmp_path):
    rnd, path, seen = random.Random(3), str(tmp_path / "t"), []
    for n in (40, 25, 0, 25):
        batch = [(None if rnd.random() < 0.05 else rnd.randint(0, 60), rnd.choice(["a", "b", None]), rnd.randint(0, 9)) for _ in range(n)]
        seen += batch
        U.append_unique(path, spark.createDataFrame(batch, COLUMNS), ["k", "d"])
        whole = spark.createDataFrame(seen, COLUMNS)
        assert rows(U.repeated_keys(spark, path)) == rows(find_duplicates(whole, ["k", "d"]).select("k", "d"))
    assert rows(U.unique_report(spark, path, "t")) == rows(check_constraints(whole, "t", unique=[["k", "d"]]))
    assert rows(S.read_latest(spark, path)) == rows(whole)


def test_history_is_read_only_where_hashes_meet(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(3):
        U.append_unique(path, spark.range(i * 1000, i * 1000 + 1000, 1, 2), ["id"])
        assert looked(spark, path) == 0
    U.append_unique(path, spark.range(990, 1010, 1, 1), ["id"])
    assert 1 <= looked(spark, path) <= 2 and U.repeated_keys(spark, path).count() == 20
    U.append_unique(path, spark.range(990, 1010, 1, 1), ["id"])  # known to repeat: no file is read again
    assert looked(spark, path) == 0 and U.repeated_keys(spark, path).count() == 20


def test_equal_hashes_of_different_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(U, "_print", lambda keys: F.lit(1).cast("long").alias("fp"))
    path = str(tmp_path / "t")
    U.append_unique(path, spark.range(5), ["id"])
    U.append_unique(path, spark.range(4, 9), ["id"])
    assert looked(spark, path) >= 1 and rows(U.repeated_keys(spark, path)) == [(4,)]


def test_rejecting_writers_and_misuse(spark, tmp_path):
    path = str(tmp_path / "t")
    U.append_unique(path, spark.range(10), ["id"], "reject", writer=("w", 0))
    assert U.append_unique(path, spark.range(10), ["id"], "reject", writer=("w", 0)) == 1
    for bad in (spark.range(9, 12), spark.range(20, 22).union(spark.range(20, 21))):
        with pytest.raises(U.UniqueViolation):
            U.append_unique(path, bad, ["id"], "reject")
    assert S.read_latest(spark, path).count() == 10
    met = []

    def someone_else():
        if not met:
            met.append(U.append_unique(path, spark.range(50, 60), ["id"]))

    with pytest.raises(U.UniqueViolation):  # the other writer's key came first
        U.append_unique(path, spark.range(55, 70), ["id"], "reject", before_commit=someone_else)
    assert S.read_latest(spark, path).count() == 20 and U.repeated_keys(spark, path).isEmpty()
    assert U.append_unique(path, spark.range(9, 10), ["id"]) == 3
    with pytest.raises(U.UniqueViolation):  # known to repeat
        U.append_unique(path, spark.range(9, 10), ["id"], "reject")
    with pytest.raises(ValueError):
        U.append_unique(path, spark.range(3).withColumnRenamed("id", "x"), ["x"])
    with pytest.raises(ValueError):
        U.append_unique(path, spark.range(3), ["id"], "ignore")
