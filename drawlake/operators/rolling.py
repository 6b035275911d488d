"""Rolling frequency over the last ``window`` draws."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawlake.operators.windows import CHUNK, domain_rows, window_arrays
from drawlake.schemas import STAR, Pool


def rolling_frequency(seq_draws: DataFrame, pool: Pool = STAR, window: int = 50,
                      seq_col: str = "seq", date_col: str = "draw_date", chunk: int = CHUNK) -> DataFrame:
    """Occurrences of every pool number in draws ``seq-window+1 .. seq``, for seq >= window.

    Same result as a per-draw indicator matrix rolled with a full window and
    the incomplete first ``window-1`` rows dropped, melted to
    ``(seq, draw_date, number, frequency)`` with zero rows kept. One plan for
    every window length (see :mod:`drawlake.operators.windows`).
    """
    rows = window_arrays(seq_draws, window, [pool], seq_col, inclusive=True, keep=[date_col], chunk=chunk)
    return (domain_rows(rows.where(F.col(seq_col) >= window), [seq_col, date_col], [pool], ["frequency"])
                .select(seq_col, date_col, "number", F.col("frequency").cast("long").alias("frequency")))
