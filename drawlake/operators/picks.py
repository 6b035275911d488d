"""Picking numbers from statistics, random tickets, and scoring picks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drawlake.operators.windows import CHUNK, Windows, by_chunks
from drawlake.schemas import DEFAULT_POOLS, MAIN, STAR, Pool

# Picks per pool in one ticket: 5 main numbers and 2 stars.
DEFAULT_K = {MAIN.name: 5, STAR.name: 2}


def _k_expr(k: Mapping[str, int]) -> Column:
    expr = None
    for name, v in k.items():
        cond = F.col("pool") == name
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(0))


def pick_top_k(stats: DataFrame, stat_col: str, k: Mapping[str, int] = DEFAULT_K,
               largest: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """The k largest (or smallest) ``stat_col`` numbers per pool.

    Ties always go to the smaller number. Output keeps the statistic of each
    pick (O58) and its rank; ``sort_array`` of the numbers gives the ticket.
    """
    order = F.col(stat_col).desc() if largest else F.col(stat_col).asc()
    rank = F.row_number().over(Window.partitionBy(*by, "pool").orderBy(order, F.col("number")))
    return (stats.withColumn("pick_rank", rank)
                 .where(F.col("pick_rank") <= _k_expr(k))
                 .select(*by, "pool", "pick_rank", "number", stat_col))


def ticket(picks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Collapse picks to one ascending number array per pool (at most k values each)."""
    return picks.groupBy(*by, "pool").agg(F.sort_array(F.collect_list("number")).alias("numbers"))


def random_tickets(tickets: DataFrame, pools: Sequence[Pool] = DEFAULT_POOLS,
                   k: Mapping[str, int] = DEFAULT_K, seed: int = 42,
                   id_col: str = "ticket_id") -> DataFrame:
    """k of n without replacement per pool, sorted, for every ticket row.

    ``tickets`` holds one row per wanted ticket (any id column); every row is
    independent, so M tickets are generated in parallel. Numbers are drawn in
    the order of the md5 of ``seed:pool:id:number``, so the same ticket id
    gives the same numbers on any partitioning, retry or engine.
    """
    out = tickets
    for p in pools:
        numbers = range(p.lo, p.hi + 1)
        endings = F.array(*[F.struct(F.lit(f":{n}").alias("end"), F.lit(n).alias("n")) for n in numbers])
        prefix = F.concat_ws(":", F.lit(str(seed)), F.lit(p.name), F.col(id_col).cast("string"))
        key = lambda pre: F.transform(endings, lambda e: F.struct(F.md5(F.concat(pre, e["end"])).alias("h"), e["n"].alias("n")))
        # sort_array compares keys without an expression per comparison, as array_sort would.
        keyed = F.sort_array(F.element_at(F.transform(F.array(prefix), key), 1))
        chosen = F.slice(keyed, 1, k[p.name])
        out = out.withColumn(f"{p.name}_numbers", F.sort_array(F.transform(chosen, lambda s: s["n"])))
    return out


def sample_numbers(rows: DataFrame, id_col: str, lo: int, hi: int, k: int, seed: int = 42, out_col: str = "numbers") -> DataFrame:
    """k different numbers of ``lo..hi`` for every row, ascending, each set equally likely.

    Floyd's selection: step i draws from the first ``n - k + i`` numbers, and a
    number that is taken already stands for the newest one. So a row costs k
    steps, whatever the size of the domain, and nothing but the k numbers is
    built. The draw of step i is the first 60 bits of the md5 of
    ``seed:id:i``, so that it does not depend on partitioning, retries or the
    engine. A null id draws as the text ``null``; k above the domain raises.
    """
    n = hi - lo + 1
    if not 0 <= k <= n:
        raise ValueError(f"cannot draw {k} of {n} different numbers")

    def step(taken: Column, i: Column) -> Column:
        text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), i.cast("string"))
        newest = F.lit(n - k) + i
        drawn = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % newest + 1
        return F.concat(taken, F.array(F.when(F.array_contains(taken, drawn), newest).otherwise(drawn)))

    chosen = F.aggregate(F.sequence(F.lit(1).cast("long"), F.lit(k).cast("long")) if k else F.array().cast("array<long>"),
                         F.array().cast("array<long>"), step)
    return rows.withColumn(out_col, F.array_sort(F.transform(chosen, lambda x: x + (lo - 1))))


def score_picks(picks: DataFrame, draws: DataFrame, key: str,
                pools: Sequence[Pool] = DEFAULT_POOLS) -> DataFrame:
    """Matches per pool between a pick and the actual draw sharing ``key``.

    ``picks`` has ``key`` and one array column ``<pool>_numbers`` per pool;
    draws are wide rows. Many strategies x many draws is one equi-join.
    """
    d = draws.select(key, *[F.array(*[F.col(c).cast("int") for c in p.columns]).alias(f"_{p.name}_actual")
                            for p in pools])
    j = picks.join(d, key)
    for p in pools:
        j = j.withColumn(f"{p.name}_matches",
                         F.size(F.array_intersect(F.col(f"{p.name}_numbers"), F.col(f"_{p.name}_actual"))))
    return j.drop(*[f"_{p.name}_actual" for p in pools])


def backtest_window_picks(seq_draws: DataFrame, stat: str = "frequency", largest: bool = True,
                          k: Mapping[str, int] = DEFAULT_K, pools: Sequence[Pool] = DEFAULT_POOLS,
                          window: int = 20, seq_col: str = "seq") -> DataFrame:
    """Back-test a windowed pick strategy on every draw (O57 per draw, O63).

    For each draw with full history: pick the k numbers per pool with the
    largest (or smallest) ``stat`` (``frequency`` or ``recency``) over the
    previous ``window`` draws (ties to the smaller number) and count how
    many are in that draw. Output ``seq, <pool>_matches...``.

    Plan: one shuffle of the wide draws by chunks of the sequence; ranking
    and matching stay inside each chunk.
    """
    from drawlake.operators.features import start_index

    if stat not in ("frequency", "recency"):
        raise ValueError("stat must be 'frequency' or 'recency'")

    def build(w: Windows, home: np.ndarray) -> list:
        values = (w.frequency() if stat == "frequency" else w.recency())[home].astype(np.int64)
        drawn, at, out = w.counts[home] > 0, 0, []
        for p in pools:
            own = values[:, at:at + p.size]
            order = np.argsort((-own if largest else own) * p.size + np.arange(p.size), axis=1)[:, :k[p.name]]
            out.append(pa.array(np.take_along_axis(drawn[:, at:at + p.size], order, axis=1).sum(axis=1).astype(np.int32)))
            at += p.size
        return out

    names = [f"{p.name}_matches" for p in pools]
    rows = by_chunks(seq_draws, window, pools, seq_col, window, (), CHUNK, build, ", ".join(f"{n} int" for n in names))
    return rows.where(F.col(seq_col) >= start_index(window=window)).select(seq_col, *names)
