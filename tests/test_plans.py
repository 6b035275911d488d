"""Plan-shape checks: the physical plans keep the properties the design relies on."""

import re

from pyspark.sql import functions as F

from drawlake.operators.features import sliding_features, window_stats
from drawlake.operators.merge import upsert
from drawlake.operators.picks import backtest_window_picks
from drawlake.operators.reconcile import reconcile
from drawlake.operators.rolling import rolling_frequency
from drawlake.operators.sequence import chunk_overlap, global_sequence
from drawlake.plans.derived import derived_draws, table
from drawlake.schemas import MAIN
from tests.conftest import draws_df, random_draws

SF = "/root/testdata/sf0.001"


def _plan(df, capsys, mode="simple"):
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


def _data_exchanges(plan):
    """Shuffles over data (scalar subqueries' single-partition exchanges excluded)."""
    return [l for l in plan.splitlines() if "Exchange" in l and "SinglePartition" not in l
            and "BroadcastExchange" not in l]


def test_derivation_prunes_and_shuffles_lines_once(spark, capsys):
    d = derived_draws(table(spark, SF, "lineitem"), table(spark, SF, "orders"))
    plan = _plan(d, capsys, "formatted")
    li_schema = [l for l in plan.splitlines() if "ReadSchema" in l and "l_orderkey" in l][0]
    assert "l_tax" not in li_schema and "l_discount" not in li_schema and "l_returnflag" not in li_schema
    lines = table(spark, SF, "lineitem").count()
    numbers = F.size(F.array_compact(F.array(*MAIN.columns)))
    assert d.select(F.sum(numbers)).first()[0] == lines  # every line item lands in a draw


def test_sequence_is_a_projection_after_checkpoint(spark, capsys):
    sd = global_sequence(draws_df(spark, random_draws(50)), ["draw_date", "draw_number"])
    plan = _plan(sd, capsys)
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan


def test_windows_shuffle_the_wide_rows_once(spark, capsys):
    sd = global_sequence(draws_df(spark, random_draws(200)), ["draw_date", "draw_number"])
    for df in (window_stats(sd), sliding_features(sd), backtest_window_picks(sd), rolling_frequency(sd)):
        plan = _plan(df, capsys)
        assert len(_data_exchanges(plan)) == 1 and not re.search(r"\bWindow\b|Join", plan)
    copies = chunk_overlap(sd, "seq", 20, 10_000).count()
    assert copies <= 1.01 * 200  # rows shuffled per draw


def test_upsert_reads_the_source_once_and_never_pairs(spark, capsys, tmp_path):
    target = spark.range(1000).selectExpr("id AS k", "id * 2 AS v")
    spark.range(10).selectExpr("id * 100 AS k", "-1L AS v").write.parquet(str(tmp_path / "s"))
    df = upsert(target, spark.read.parquet(str(tmp_path / "s")).where("k is not null"), ["k"])
    df.collect()
    plan = _plan(df, capsys)
    final = plan.split("Initial Plan")[0]
    assert "FullOuter" not in final and "CartesianProduct" not in final and "LeftOuter" in final and "LeftAnti" in final


def test_reconcile_is_an_aggregate_not_a_full_join(spark, capsys):
    a = draws_df(spark, random_draws(30))
    plan = _plan(reconcile(a, a, ["draw_date"], ["ball_1", "ball_2"]), capsys)
    assert "FullOuter" not in plan and "HashAggregate" in plan
    assert len(_data_exchanges(plan)) == 1
    text = a.withColumn("t", F.lit("x"))
    plan = _plan(reconcile(text, text, ["draw_date"], ["t"]), capsys)
    assert "FullOuter" not in plan and "SortAggregate" in plan and len(_data_exchanges(plan)) == 1
