import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from drawlake.operators.reshape import densify, indicator_counts, to_long
from drawlake.operators.sequence import global_sequence
from drawlake.schemas import MAIN, STAR
from tests.conftest import draws_df, random_draws


def test_to_long_drops_nulls_and_keeps_positions(spark):
    df = draws_df(spark, [(1, "2021-01-01", 1, 2, 3, 4, 4, 7, None)])
    rows = sorted(to_long(df, keep=["draw_number"]).collect())
    assert len(rows) == 6
    assert ("main", 5, 4) in {(r.pool, r.position, r.number) for r in rows}
    assert not [r for r in rows if r.pool == "star" and r.position == 2]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_global_sequence_matches_row_number(spark, parts):
    df = draws_df(spark, random_draws(300))
    got = global_sequence(df, ["draw_date", "draw_number"], num_partitions=parts)
    want = df.withColumn("seq", F.row_number().over(Window.orderBy("draw_date", "draw_number")))
    a = sorted((r.draw_number, r.seq) for r in got.select("draw_number", "seq").collect())
    b = sorted((r.draw_number, r.seq) for r in want.select("draw_number", "seq").collect())
    assert a == b


def test_global_sequence_hot_leading_value(spark):
    # a third of the rows share one date; the tie-break column still spreads them
    rows = random_draws(90)
    rows = [(r[0], "2020-01-01" if i % 3 == 0 else r[1], *r[2:]) for i, r in enumerate(rows)]
    df = draws_df(spark, rows)
    got = global_sequence(df, ["draw_date", "draw_number"], num_partitions=5)
    seqs = sorted(r.seq for r in got.collect())
    assert seqs == list(range(1, 91))


def test_global_sequence_empty(spark):
    df = draws_df(spark, [])
    assert global_sequence(df, ["draw_date", "draw_number"]).count() == 0


def test_indicator_counts_dense_with_repeats(spark):
    df = draws_df(spark, [(1, "2021-01-01", 1, 1, 2, 3, 4, 5, 5), (2, "2021-01-02", 1, 2, 3, 4, 6, 1, 2)])
    got = {(r.draw_number, r.number): r.cnt for r in indicator_counts(df, "draw_number", STAR).collect()}
    assert len(got) == 24
    assert got[(1, 5)] == 2 and got[(1, 1)] == 0 and got[(2, 1)] == 1


def test_densify_fills_domain(spark):
    stats = spark.createDataFrame([("main", 3, 7)], "pool string, number int, frequency long")
    out = densify(stats, [MAIN], {"frequency": 0})
    vals = {r.number: r.frequency for r in out.collect()}
    assert len(vals) == 50 and vals[3] == 7 and vals[1] == 0
