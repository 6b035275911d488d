"""The draw-history job: ingest, merge, validate, gate, publish, analyse, pick, export.

One parameterised function composes the stages as DataFrames. Each stage is
written once, in the folder of its run beside the output folder, and a rerun with the same inputs and
parameters skips what has ended. The sequenced draw table is built once and
shared by every order-dependent stage. One commit at the end publishes all
outputs; nothing is published before the gate has passed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drawlake.functions.dates import is_weekday
from drawlake.operators.features import history_guard, next_features, sliding_features
from drawlake.operators.frequency import (
    frequency, frequency_matrix, frequency_share, recency, top_n_with_others,
)
from drawlake.operators.merge import upsert
from drawlake.operators.ml import fit_multilabel_forest, fit_multilabel_logistic
from drawlake.operators.picks import pick_top_k, random_tickets
from drawlake.operators.reconcile import quality_gate, reconcile, reconcile_summary
from drawlake.operators.reshape import to_long
from drawlake.operators.rolling import rolling_frequency
from drawlake.operators.sequence import global_sequence
from drawlake.operators.standardize import drop_null_rows, lower_case_columns, standardize
from drawlake.plans.stages import Run
from drawlake.schemas import CORE_COLUMNS, DEFAULT_POOLS, MAIN, NUMBER_COLUMNS, STAR
from drawlake.sources.sinks import export_table

STRATEGIES = ("most_frequent", "least_frequent", "most_overdue", "random", "forest", "logistic")
WEEKDAYS = ("all", "tuesday", "friday")
DRAW_KEY = "draw_date"


@dataclass
class JobConfig:
    """Run parameters (O71). ``strategy`` and ``weekday`` are validated enums."""

    output_dir: str
    target: DataFrame | None = None          # current draw table (any case of column names)
    updates: DataFrame | None = None         # newly ingested draws to merge on draw_date
    reference_copy: DataFrame | None = None  # second copy to reconcile against
    strategy: str = "most_frequent"
    weekday: str = "all"
    gate_limits: dict = field(default_factory=lambda: {"left_only": 0, "right_only": 0,
                                                      "duplicate": 0, "mismatched": 0})
    top_n: int = 15
    rolling_window: int = 50
    seed: int = 42
    export_format: str | None = None         # also export the history as csv, json or parquet

    def validate(self) -> None:
        if self.strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}")
        if self.weekday.lower() not in WEEKDAYS:
            raise ValueError(f"weekday must be one of {WEEKDAYS}")
        if self.target is None and self.updates is None:
            raise ValueError("need a target table or updates")


def load_draws(df: DataFrame) -> DataFrame:
    """A draw source in the warehouse shape, with every further column it has.

    Names in lower case, date and numbers typed, rows without a first number
    left out. ``draw_number`` is not read: :func:`numbered` derives it.
    """
    df = lower_case_columns(df).drop("draw_number")
    core = [c for c in CORE_COLUMNS if c != "draw_number"]
    extra = [c for c in df.columns if c not in core]
    typed = standardize(df, [*core, *extra], int_columns=core)
    return drop_null_rows(typed, ["ball_1"])


def numbered(draws: DataFrame) -> DataFrame:
    """``draw_number`` 1..N by date, in front of all columns."""
    rest = F.xxhash64(*[c for c in draws.columns if c != DRAW_KEY])
    order = [F.col(DRAW_KEY), rest]
    return global_sequence(draws, order, "draw_number").select("draw_number", *draws.columns)


def _merged(cfg: JobConfig) -> DataFrame:
    """Merge (O13): updates win on the draw date; columns that they lack keep their values."""
    if cfg.target is None or cfg.updates is None:
        return load_draws(cfg.target if cfg.target is not None else cfg.updates)
    target, updates = load_draws(cfg.target), load_draws(cfg.updates)
    for c in updates.columns:
        if c not in target.columns:
            target = target.withColumn(c, F.lit(None).cast(updates.schema[c].dataType))
    return upsert(target, updates, [DRAW_KEY])


def _picks(spark: SparkSession, cfg: JobConfig, sd: DataFrame, counts: DataFrame, overdue: DataFrame) -> DataFrame:
    """The strategy's picks."""
    if cfg.strategy in ("most_frequent", "least_frequent"):
        return pick_top_k(counts, "frequency", largest=cfg.strategy == "most_frequent")
    if cfg.strategy == "most_overdue":
        return pick_top_k(overdue, "draws_since", largest=True)
    if cfg.strategy == "random":
        return random_tickets(spark.range(1).withColumnRenamed("id", "ticket_id"), seed=cfg.seed)
    history_guard(sd, mode="next")
    features = sliding_features(sd).unionByName(next_features(sd))
    scores = (fit_multilabel_forest(features, mode="next", seed=cfg.seed) if cfg.strategy == "forest"
              else fit_multilabel_logistic(features, mode="next"))
    return pick_top_k(scores, "probability")


def run_draw_job(spark: SparkSession, cfg: JobConfig, after_stage: Callable[[str], None] | None = None) -> dict:
    """Run every stage of the job and publish the outputs by one commit.

    Returns the reconcile summary, the gate verdict, the output paths and the
    stages that an earlier run with the same inputs and parameters had ended
    (:mod:`drawlake.plans.stages`). A failed gate, or any other failure, leaves
    what was published before. ``after_stage`` is called as each stage ends.
    """
    cfg.validate()
    run = Run(spark, cfg.output_dir, {"target": cfg.target, "updates": cfg.updates, "reference": cfg.reference_copy},
              {k: getattr(cfg, k) for k in ("strategy", "weekday", "gate_limits", "top_n", "rolling_window", "seed", "export_format")},
              after_stage)
    out: dict = {}
    raw = run.table("merged", lambda: _merged(cfg), output=False)
    merged = run.table("draw_history", lambda: numbered(raw))

    # Validate + gate.
    if cfg.reference_copy is not None:
        def compare(_: str) -> dict:
            rec = reconcile(merged, load_draws(cfg.reference_copy), [DRAW_KEY], list(NUMBER_COLUMNS))
            return reconcile_summary(rec).first().asDict()

        out["summary"] = run.stage("summary", compare)
        out["gate"] = quality_gate(spark.createDataFrame([out["summary"]]), cfg.gate_limits)
    if cfg.export_format:
        if run.stage("export", lambda path: {"wrote": export_table(merged, path, cfg.export_format)})["wrote"]:
            run.outputs["export"] = run._path("export")

    # Analyse (O38-O47, O51, O56) on the weekday-filtered history.
    draws = merged.select(*CORE_COLUMNS).where(is_weekday(DRAW_KEY, cfg.weekday))
    sd = run.table("sequence", lambda: global_sequence(draws, ["draw_number"]), output=False)
    long_df = to_long(sd, DEFAULT_POOLS, keep=["seq", DRAW_KEY])
    counts = run.table("frequency", lambda: frequency_share(frequency(long_df)))
    yearly = frequency(long_df.withColumn("year", F.year(DRAW_KEY)), by=["year"])
    run.table("top_with_others", lambda: top_n_with_others(yearly.where(F.col("pool") == MAIN.name), cfg.top_n, by=["year"]))
    run.table("yearly_matrix_main", lambda: frequency_matrix(long_df, MAIN, F.year(DRAW_KEY)))
    run.table("yearly_matrix_star", lambda: frequency_matrix(long_df, STAR, F.year(DRAW_KEY)))
    run.table("rolling_star_frequency", lambda: rolling_frequency(sd, STAR, cfg.rolling_window))
    overdue = run.table("recency", lambda: recency(sd))
    run.table("picks", lambda: _picks(spark, cfg, sd, counts, overdue))
    run.publish()
    return {**out, "outputs": run.outputs, "skipped": run.done}
