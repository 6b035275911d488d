"""A job that is cut off after any stage ends, on its next run, with the outputs of an uninterrupted one."""

import pytest
from pyspark.sql import functions as F

from drawlake.operators.reconcile import QualityGateError
from drawlake.plans import stages as G
from drawlake.plans.job import JobConfig, run_draw_job
from tests.conftest import draws_df, random_draws

STAGES = ["merged", "draw_history", "summary", "export", "sequence", "frequency", "top_with_others", "yearly_matrix_main",
          "yearly_matrix_star", "rolling_star_frequency", "recency", "picks"]


class Killed(Exception):
    pass


def contents(spark, outputs):
    read = lambda name, path: spark.read.json(path) if name == "export" else spark.read.parquet(path)
    return {name: sorted(map(str, read(name, path).collect())) for name, path in outputs.items()}


def test_a_kill_after_each_stage(spark, tmp_path):
    draws = random_draws(70, unique_dates=True)
    limits = {"left_only": 0, "right_only": 0, "duplicate": 0, "mismatched": 0}

    def config(folder, copy=draws, **more):
        return JobConfig(output_dir=str(tmp_path / folder), target=draws_df(spark, draws), reference_copy=draws_df(spark, copy),
                         export_format="json", gate_limits=limits, **more)

    whole = run_draw_job(spark, config("whole"))
    want = contents(spark, whole["outputs"])
    assert whole["skipped"] == [] and set(want) == set(STAGES) - {"merged", "summary", "sequence"}

    # One folder, killed after every stage in turn: each run goes one stage further.
    for i, last in enumerate(STAGES):
        def kill(stage):
            if stage == last:
                raise Killed
        with pytest.raises(Killed):
            run_draw_job(spark, config("cut"), after_stage=kill)
        assert G.published(spark, str(tmp_path / "cut")) == {}
    end = run_draw_job(spark, config("cut"))
    assert end["skipped"] == STAGES and end["summary"] == whole["summary"]
    assert contents(spark, G.published(spark, str(tmp_path / "cut"))) == want

    # A run that fails leaves what was published; the same run published twice is one publication.
    with pytest.raises(QualityGateError):
        run_draw_job(spark, config("cut", copy=draws[:60]))
    assert contents(spark, G.published(spark, str(tmp_path / "cut"))) == want
    assert G.Run(spark, str(tmp_path / "cut"), {}, {}).name != end["outputs"]["picks"].split("/")[-2]
    assert G.drop_runs(spark, str(tmp_path / "cut")) == 1
    assert contents(spark, G.published(spark, str(tmp_path / "cut"))) == want


def test_digest(spark):
    df = spark.createDataFrame([(1, "a", {"k": 1}), (2, None, {}), (2, None, {})], "x int, s string, m map<string,int>")
    same = df.select("m", "s", "x").repartition(3)
    assert G.content_digest(df) == G.content_digest(same)
    for other in (df.limit(2), df.withColumn("x", F.col("x").cast("long")), df.withColumn("s", F.coalesce("s", F.lit(""))), df.drop("m")):
        assert G.content_digest(other) != G.content_digest(df)


def test_a_stage_that_broke_off_is_done_again(spark, tmp_path):
    run = G.Run(spark, str(tmp_path), {"a": spark.range(3)}, {"p": 1})

    def broken():
        spark.range(9).write.parquet(run._path("s"))
        raise Killed

    with pytest.raises(Killed):
        run.table("s", broken)
    again = G.Run(spark, str(tmp_path), {"a": spark.range(3).repartition(2)}, {"p": 1})
    assert again.table("s", lambda: spark.range(4)).count() == 4 and again.done == []
    assert again.publish() == 1 and again.publish() == 1 and list(G.published(spark, str(tmp_path))) == ["s"]
    assert G.Run(spark, str(tmp_path), {"a": spark.range(3)}, {"p": 2}).notes("s") is None
    with pytest.raises(ValueError):
        G.drop_runs(spark, str(tmp_path), 0)
