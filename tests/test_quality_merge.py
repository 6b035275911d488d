import datetime as dt

import pytest
from pyspark.sql import functions as F

from drawlake.operators.merge import delete_keys, delete_where, upsert, update_where
from drawlake.operators.reconcile import (
    QualityGateError, check_constraints, find_duplicates, only_in, quality_gate, reconcile,
    reconcile_summary,
)

from drawlake.sources.snapshots import merge_into, read_latest

SCHEMA = "draw_date date, draw_number int, ball_1 int, ball_2 int"


def _d(s):
    return dt.date.fromisoformat(s) if s else None


@pytest.fixture()
def two_copies(spark):
    left = spark.createDataFrame([
        (_d("2021-01-01"), 1, 5, 6),    # equal
        (_d("2021-01-05"), 2, 7, 8),    # only left
        (_d("2021-01-08"), 3, 9, 10),   # changed ball
        (_d("2021-01-12"), 4, None, 1), # null on one side
        (None, 5, 1, 2),                # null key on both sides
        (_d("2021-01-19"), 6, 1, 2),    # duplicate key on the right
    ], SCHEMA)
    right = spark.createDataFrame([
        (_d("2021-01-01"), 1, 5, 6),
        (_d("2021-01-08"), 3, 9, 11),
        (_d("2021-01-12"), 4, 3, 1),
        (None, 5, 1, 2),
        (_d("2021-01-19"), 6, 1, 2),
        (_d("2021-01-19"), 6, 1, 2),
        (_d("2021-01-22"), 7, 1, 2),    # only right
    ], SCHEMA)
    return left, right


def test_reconcile_cases(spark, two_copies):
    left, right = two_copies
    rec = {r.draw_date: r for r in reconcile(left, right, ["draw_date"], ["draw_number", "ball_1", "ball_2"]).collect()}
    assert rec[_d("2021-01-05")].status == "left_only"
    assert rec[_d("2021-01-22")].status == "right_only"
    assert rec[_d("2021-01-19")].status == "duplicate" and rec[_d("2021-01-19")].right_rows == 2
    assert rec[_d("2021-01-19")].ball_1_left is None and rec[_d("2021-01-19")].ball_1_right is None
    assert rec[None].status == "both" and not rec[None].mismatch          # null meets null
    assert rec[_d("2021-01-08")].mismatch and rec[_d("2021-01-08")].ball_2_match is False
    assert not rec[_d("2021-01-12")].mismatch                             # compatible null rule
    strict = {r.draw_date: r for r in reconcile(left, right, ["draw_date"], ["ball_1"], null_mismatch=True).collect()}
    assert strict[_d("2021-01-12")].mismatch
    s = reconcile_summary(reconcile(left, right, ["draw_date"], ["draw_number", "ball_1", "ball_2"])).first()
    assert (s.left_only, s.right_only, s.both, s.duplicate, s.mismatched, s.matched) == (1, 1, 4, 1, 1, 3)
    with pytest.raises(QualityGateError):
        quality_gate(reconcile_summary(reconcile(left, right, ["draw_date"], ["ball_1"])))
    assert quality_gate(reconcile_summary(reconcile(left, left, ["draw_date"], ["ball_1"])))["passed"]


def test_only_in_null_safe(spark, two_copies):
    left, right = two_copies
    assert sorted(r.draw_number for r in only_in(left, right, ["draw_date"]).collect()) == [2]
    assert sorted(r.draw_number for r in only_in(right, left, ["draw_date"]).collect()) == [7]


def test_constraints_and_duplicates(spark, two_copies):
    _, right = two_copies
    rep = {(r.rule, r.columns): r.violations for r in
           check_constraints(right, "t", not_null=["draw_date", "ball_1"], unique=[["draw_date"]]).collect()}
    assert rep[("not_null", "draw_date")] == 1 and rep[("unique", "draw_date")] == 1
    d = find_duplicates(right, ["draw_date"]).collect()
    assert [(r.draw_date, r.n) for r in d] == [(_d("2021-01-19"), 2)]
    assert find_duplicates(right, ["draw_date"], limit=0).count() == 0


@pytest.mark.parametrize("join", ["broadcast", "merge"])
def test_upsert_cases(spark, join):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k int, s string, v int")
    source = spark.createDataFrame([(2, "B", 21, 1), (2, "BB", 22, 2), (3, "c", 30, 1), (None, "m", 1, 1)],
                                   "k int, s string, v int, ts int").hint(join)
    out = sorted(upsert(target, source, ["k"], order_col="ts").collect(),
                 key=lambda r: (r.k is None, r.k or 0, r.s))
    assert [tuple(r) for r in out] == [(1, "a", 10), (2, "BB", 22), (3, "c", 30), (None, "m", 1), (None, "n", 0)]
    part = upsert(target, source, ["k"], update_cols=["v"], order_col="ts")
    got = {r.k: (r.s, r.v) for r in part.where("k is not null").collect()}
    assert got[2] == ("b", 22) and got[3] == ("c", 30)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_keeps_what_the_source_does_not_touch(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "k int, s string")
    source = spark.createDataFrame([(2, "Z")], "k int, s string")
    assert _rows(upsert(target, source, ["k"])) == [(1, "a"), (1, "b"), (2, "Z"), (3, "d")]
    # both rows of a repeated target key are updated
    assert _rows(upsert(target, spark.createDataFrame([(1, "Y")], "k int, s string"), ["k"])) == \
        [(1, "Y"), (1, "Y"), (2, "c"), (3, "d")]


def test_upsert_source_lacks_a_column(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, w int")
    source = spark.createDataFrame([(2, "Z"), (3, "n")], "k int, v string")
    assert _rows(upsert(target, source, ["k"])) == [(1, "a", 10), (2, "Z", 20), (3, "n", None)]
    with pytest.raises(ValueError):
        upsert(target, source, ["k"], update_cols=["w"])


def test_upsert_null_order_and_ties(spark):
    target = spark.createDataFrame([(2, "b", 20)], "k int, s string, v int")
    source = spark.createDataFrame([(2, "x", 1, None), (2, "y", 2, None)], "k int, s string, v int, ts int")
    assert _rows(upsert(target, source, ["k"], order_col="ts")) == [(2, "y", 2)]
    assert _rows(upsert(target.limit(0), source.limit(0), ["k"], order_col="ts")) == []


def test_batch_snapshots(spark, tmp_path):
    table = str(tmp_path / "t")
    assert read_latest(spark, table) is None
    first = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1), (None, "n", 1)], "k int, s string, ts int")
    assert merge_into(table, first, ["k"], order_col="ts") == 1
    assert _rows(read_latest(spark, table)) == [(1, "b", 2), (2, "c", 1), (None, "n", 1)]
    assert merge_into(table, spark.createDataFrame([(2, "C", 2)], "k int, s string, ts int"), ["k"]) == 2
    assert _rows(read_latest(spark, table).where("k is not null")) == [(1, "b", 2), (2, "C", 2)]


def test_unreadable_commit_log_is_not_an_empty_table(spark):
    with pytest.raises(Exception, match="nosuchfs"):
        merge_into("nosuchfs://host/table", spark.createDataFrame([(1, "a")], "k int, s string"), ["k"])


def test_update_delete(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "k int, v int")
    up = {r.k: r.v for r in update_where(df, "v > 5", {"v": 0}).collect()}
    assert up == {1: 5, 2: 0, 3: None}
    assert sorted(r.k for r in delete_where(df, F.col("v") == 5).collect()) == [2, 3]
    assert sorted(r.k for r in delete_keys(df, spark.createDataFrame([(2,)], "k int"), ["k"]).collect()) == [1, 3]
