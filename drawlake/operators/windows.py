"""Trailing-window statistics by chunks of the sequence (the shape behind O47-O52 and O63).

Rows carry a dense sequence number. Each wide row goes to its own chunk of
``chunk`` numbers and, if it lies in the last ``window`` of a chunk, also to
the next one: about ``1 + window / chunk`` rows shuffled per draw, whatever the
window. A chunk then holds every row that its windows need and is computed with
array operations; its size does not grow with the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawlake.operators.sequence import chunk_overlap
from drawlake.schemas import DEFAULT_POOLS, Pool
from drawlake.session import ship_package

CHUNK = 10_000


def counts_per_row(numbers: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """How often each of ``lo..hi`` stands in each row; nulls (NaN) and other values count nowhere."""
    out = np.zeros((len(numbers), hi - lo + 1), dtype=np.int32)
    for column in numbers.T:  # a row stands once in a column, so nothing is added twice to one place
        row = np.flatnonzero((column >= lo) & (column <= hi))
        out[row, column[row].astype(int) - lo] += 1
    return out


def trailing_counts(counts: np.ndarray, window: int, inclusive: bool) -> np.ndarray:
    """Sums over the ``window`` rows before each row (with it, if ``inclusive``); fewer rows at the start."""
    total = np.concatenate([np.zeros((1, counts.shape[1]), np.int32), np.cumsum(counts, axis=0, dtype=np.int32)])
    end = np.arange(len(counts)) + int(inclusive)
    return total[end] - total[np.maximum(end - window, 0)]


def rows_since(counts: np.ndarray, window: int) -> np.ndarray:
    """Rows between each row and the last earlier one that holds the number (0: the row before);
    ``window + 1`` if it is not among the ``window`` rows before."""
    at, never = np.arange(len(counts), dtype=np.int32)[:, None], np.int32(-window - 2)
    seen = np.maximum.accumulate(np.where(counts > 0, at, never), axis=0)
    before = np.concatenate([np.full((1, counts.shape[1]), never), seen[:-1]])[:len(counts)]
    gap = at - before - 1
    return np.where(gap < window, gap, np.int32(window + 1))


class Windows:
    """The draws of one chunk in order: their numbers, and what lies before each of them."""

    def __init__(self, numbers: np.ndarray, spans: list[tuple[int, int, int]], window: int):
        self.numbers, self.window, at, parts = numbers, window, 0, []
        for n, lo, hi in spans:
            parts.append(counts_per_row(numbers[:, at:at + n], lo, hi))
            at += n
        self.counts = np.concatenate(parts, axis=1)

    def frequency(self, inclusive: bool = False) -> np.ndarray:
        return trailing_counts(self.counts, self.window, inclusive)

    def recency(self) -> np.ndarray:
        return rows_since(self.counts, self.window)

    def lagged(self, lags: int) -> np.ndarray:
        """The number columns of the rows 1 to ``lags`` before; NaN marks a null or a row before the first."""
        width = self.numbers.shape[1]
        out = np.full((len(self.numbers), lags * width), np.nan)
        for k in range(1, lags + 1):
            out[k:, (k - 1) * width:k * width] = self.numbers[:-k]
        return out


def list_column(values: np.ndarray, nan_is_null: bool = False) -> pa.ListArray:
    """One list per row of a matrix."""
    flat = pa.array(values.reshape(-1), mask=np.isnan(values.reshape(-1)) if nan_is_null else None)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * np.int32(values.shape[1])), flat)


def by_chunks(seq_draws: DataFrame, window: int, pools: Sequence[Pool], seq_col: str, reach: int,
              keep: Sequence[str], chunk: int, build: Callable[[Windows, np.ndarray], list], columns: str) -> DataFrame:
    """``seq, keep..., <number columns>`` of every draw, and the ``columns`` that ``build`` makes of a chunk.

    ``build`` gets the :class:`Windows` of a chunk, with the ``reach`` draws
    before it, and the places of the chunk's own draws, for which it returns
    one Arrow array per column.
    """
    if chunk < 1:
        raise ValueError("chunk must be positive")
    ship_package(seq_draws.sparkSession)
    cols = [c for p in pools for c in p.columns]
    wide = seq_draws.select(F.col(seq_col).cast("long").alias(seq_col), *keep, *[F.col(c).cast("int").alias(c) for c in cols])
    spans = [(len(p.columns), p.lo, p.hi) for p in pools]
    names = [seq_col, *keep, *cols]
    own_names = [c.split()[0] for c in columns.split(", ")]

    def compute(group: pa.Table) -> pa.Table:
        group = group.take(pa.array(np.argsort(group.column(seq_col).to_numpy(), kind="stable")))
        numbers = np.stack([group.column(c).to_numpy().astype(float) for c in cols], axis=1)
        home = np.flatnonzero(group.column("_home").to_numpy())
        own = group.select(names).take(pa.array(home))  # a chunk may hold no row of its own
        return pa.table([*own.columns, *build(Windows(numbers, spans, window), home)], names=[*names, *own_names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.schema.fields) + f", {columns}"
    return chunk_overlap(wide, seq_col, reach, chunk).groupBy("_chunk").applyInArrow(compute, schema)


def window_arrays(seq_draws: DataFrame, window: int, pools: Sequence[Pool] = DEFAULT_POOLS, seq_col: str = "seq",
                  lags: int = 0, inclusive: bool = False, keep: Sequence[str] = (), chunk: int = CHUNK) -> DataFrame:
    """Per draw: ``seq, keep..., <number columns>, lagged, frequency, recency``.

    ``frequency`` and ``recency`` are arrays over all numbers of all pools, in
    order, for the ``window`` draws before (for ``frequency`` with the draw
    itself, if ``inclusive``). ``lagged`` holds the number columns of the draws
    1 to ``lags`` before; NaN marks a null number or a draw before the first.
    Draws at the start have shorter windows; filter by ``seq`` where full ones
    are wanted. The result does not depend on ``chunk``.
    """
    def build(w: Windows, home: np.ndarray) -> list:
        return [list_column(w.lagged(lags)[home]), list_column(w.frequency(inclusive)[home]), list_column(w.recency()[home])]

    return by_chunks(seq_draws, window, pools, seq_col, max(window, lags, 1), keep, chunk, build,
                     "lagged array<double>, frequency array<int>, recency array<int>")


def domain_rows(rows: DataFrame, keep: Sequence[str], pools: Sequence[Pool], arrays: Sequence[str]) -> DataFrame:
    """``keep..., pool, number, a, b, ...``: the arrays over all pools' numbers, one row per cell.

    The domain is a constant that each row is combined with, and a cell is
    looked up by its place, so that no array of cells is built per row.
    """
    numbers = [(p.name, n) for p in pools for n in range(p.lo, p.hi + 1)]
    cells = F.array(*[F.struct(F.lit(pool).alias("pool"), F.lit(n).alias("number"), F.lit(at).alias("_place"))
                      for at, (pool, n) in enumerate(numbers)])
    return (rows.select(*keep, *[F.col(a).alias(f"_of_{a}") for a in arrays], F.inline(cells))
            .select(*keep, "pool", "number", *[F.get(f"_of_{a}", F.col("_place")).alias(a) for a in arrays]))
