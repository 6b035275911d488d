"""Sliding-window features and multi-label targets.

The windows are computed by chunks of the sequence
(:mod:`drawlake.operators.windows`): one shuffle of the wide draws, no copies
per window position.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawlake.operators.reshape import to_long
from drawlake.operators.sequence import scatter
from drawlake.operators.windows import CHUNK, Windows, by_chunks, domain_rows, list_column, window_arrays
from drawlake.schemas import DEFAULT_POOLS, Pool

LAGS = 5
WINDOW = 20


def start_index(lags: int = LAGS, window: int = WINDOW) -> int:
    """First sequence number (1-based) that has full lag and window history."""
    return max(lags, window) + 1


def history_guard(seq_draws: DataFrame, lags: int = LAGS, window: int = WINDOW, mode: str = "holdout") -> None:
    """Raise when there are too few draws to build one training row plus one to predict.

    In ``holdout`` mode the last known draw is the one to predict, so it needs
    one more. Reads at most ``need`` rows (``limit`` before ``count``), never the table.
    """
    need = max(lags, window) + (2 if mode == "holdout" else 1)
    have = seq_draws.limit(need).count()
    if have < need:
        raise ValueError(f"need at least {need} draws for lag {lags} / window {window}, have {have}")


def _last_target(seq_draws: DataFrame, seq_col: str, mode: str) -> Column:
    if mode not in ("holdout", "next"):
        raise ValueError("mode must be 'holdout' or 'next'")
    n = seq_draws.select(F.max(seq_col)).scalar()
    return n + 1 if mode == "next" else n


def lag_long(seq_draws: DataFrame, lags: int = LAGS, window: int = WINDOW,
             pools: Sequence[Pool] = DEFAULT_POOLS, seq_col: str = "seq",
             mode: str = "holdout") -> DataFrame:
    """Numbers of the previous ``lags`` draws for each target draw (O48), long form.

    Output ``seq, lag, pool, position, number`` for every target seq from
    ``start_index`` on. No shuffle: every pick is emitted once per lag.
    """
    long_df = to_long(seq_draws, pools, keep=[seq_col])
    out = scatter(long_df, seq_col, 1, lags, target_col="_t", k_col="lag",
                  min_target=start_index(lags, window),
                  max_target=_last_target(seq_draws, seq_col, mode))
    return out.select(F.col("_t").alias(seq_col), "lag", "pool", "position", "number")


def _with_next(seq_draws: DataFrame, columns: Sequence[str], seq_col: str, mode: str) -> DataFrame:
    """The draws and, in ``next`` mode, one row N + 1 without numbers."""
    rows = seq_draws.select(F.col(seq_col).cast("long").alias(seq_col), *columns)
    if mode == "holdout":
        return rows
    if mode != "next":
        raise ValueError("mode must be 'holdout' or 'next'")
    after = rows.agg((F.max(seq_col) + 1).alias(seq_col)).where(F.col(seq_col).isNotNull())
    return rows.unionByName(after, allowMissingColumns=True)


def window_stats(seq_draws: DataFrame, window: int = WINDOW, lags: int = LAGS,
                 pools: Sequence[Pool] = DEFAULT_POOLS, seq_col: str = "seq",
                 mode: str = "holdout", include_current: bool = False, chunk: int = CHUNK) -> DataFrame:
    """Frequency and recency of every pool number in the ``window`` draws before each target.

    ``frequency`` counts occurrences; ``recency`` is 0 when the number is in
    the previous draw, j-1 when last seen j draws back, and ``window + 1`` when
    absent. Output is dense: ``seq, pool, number, frequency, recency`` and,
    with ``include_current``, ``present`` (0/1: the number is in the target
    draw itself).
    """
    cols = [c for p in pools for c in p.columns]
    rows = window_arrays(_with_next(seq_draws, cols, seq_col, mode), window, pools, seq_col, chunk=chunk)
    cells = domain_rows(rows.where(F.col(seq_col) >= start_index(lags, window)),
                        [seq_col, *(cols if include_current else [])], pools, ["frequency", "recency"])
    return cells.select(seq_col, "pool", "number", F.col("frequency").cast("long").alias("frequency"), "recency",
                        *([_present(pools).alias("present")] if include_current else []))


def _present(pools: Sequence[Pool]) -> Column:
    """0/1: ``number`` of ``pool`` stands in one of the pool's columns."""
    hit = F.lit(False)
    for p in pools:
        stands = F.lit(False)
        for c in p.columns:
            stands = stands | F.coalesce(F.col(c).cast("int") == F.col("number"), F.lit(False))
        hit = hit | ((F.col("pool") == p.name) & stands)
    return hit.cast("int")


def multi_hot_long(seq_draws: DataFrame, pools: Sequence[Pool] = DEFAULT_POOLS,
                   seq_col: str = "seq") -> DataFrame:
    """0/1 presence of every domain number in each draw (O53), long form, no shuffle."""
    cols = [c for p in pools for c in p.columns]
    return domain_rows(seq_draws, [seq_col, *cols], pools, []).select(seq_col, "pool", "number", _present(pools).alias("present"))


def sliding_features(seq_draws: DataFrame, lags: int = LAGS, window: int = WINDOW,
                     pools: Sequence[Pool] = DEFAULT_POOLS, seq_col: str = "seq",
                     mode: str = "holdout", chunk: int = CHUNK) -> DataFrame:
    """One feature row per target draw (O52): ``seq, features, y_<pool>...``.

    ``features`` is ``lags x (all pool columns)`` lagged numbers (null where a
    draw lacks one), then (frequency, recency) for every number of every pool
    in domain order: 5 x 7 + 2 x 50 + 2 x 12 = 159 values for the default
    pools. ``y_<pool>`` are the target draw's 0/1 vectors (null for the unseen
    ``next`` row).

    ``holdout``: targets run to the last known draw (it is the hold-out row).
    ``next``: one more row, seq N+1, whose features use the last ``window``
    known draws including the latest one.
    """
    cols = [c for p in pools for c in p.columns]

    def build(w: Windows, home: np.ndarray) -> list:
        both = np.stack([w.frequency()[home], w.recency()[home]], axis=2).reshape(len(home), 2 * w.counts.shape[1]).astype(float)
        features = np.concatenate([w.lagged(lags)[home], both], axis=1)
        present, at, out = (w.counts[home] > 0).astype(np.int32), 0, [list_column(features, nan_is_null=True)]
        unknown = pa.array(np.isnan(w.numbers[home]).all(axis=1))
        for p in pools:
            y = list_column(present[:, at:at + p.size])
            out.append(pc.if_else(unknown, pa.scalar(None, y.type), y))
            at += p.size
        return out

    rows = by_chunks(_with_next(seq_draws, cols, seq_col, mode), window, pools, seq_col, max(window, lags, 1), (), chunk, build,
                     ", ".join(["features array<double>", *[f"y_{p.name} array<int>" for p in pools]]))
    return rows.where(F.col(seq_col) >= start_index(lags, window)).select(seq_col, "features", *[f"y_{p.name}" for p in pools])


def next_features(seq_draws: DataFrame, lags: int = LAGS, window: int = WINDOW,
                  pools: Sequence[Pool] = DEFAULT_POOLS, seq_col: str = "seq") -> DataFrame:
    """The one feature row of the unseen draw N + 1, from the last draws alone.

    Only as many draws as a window or lag reaches back are read into it.
    """
    n = seq_draws.agg(F.max(seq_col)).first()[0]
    recent = seq_draws.where(F.col(seq_col) > (n or 0) - max(lags, window))
    return sliding_features(recent, lags, window, pools, seq_col, mode="next").where(F.col(seq_col) == (n or 0) + 1)
