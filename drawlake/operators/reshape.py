"""Wide draw rows to long (pool, position, number) rows, domains and densifying.

O23 (to long), O35b (dense domain), O43 (per-draw indicator counts), O62.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drawlake.schemas import DEFAULT_POOLS, Pool


def to_long(df: DataFrame, pools: Sequence[Pool] = DEFAULT_POOLS,
            keep: Sequence[str] = ()) -> DataFrame:
    """One row per (kept columns, pool, position, number); null numbers dropped.

    A single ``inline`` generator over all pools: one scan, no union of
    per-column projections, and whole-stage codegen stays intact.
    """
    entries = [
        F.struct(F.lit(p.name).alias("pool"), F.lit(i).alias("position"),
                 F.col(c).cast("int").alias("number"))
        for p in pools for i, c in enumerate(p.columns, 1)
    ]
    return (df.select(*keep, F.inline(F.array(*entries)))
              .where(F.col("number").isNotNull()))


def domain(spark: SparkSession, pools: Sequence[Pool] = DEFAULT_POOLS) -> DataFrame:
    """All (pool, number) pairs of the pools' domains; size = sum of pool sizes."""
    rows = [(p.name, n) for p in pools for n in range(p.lo, p.hi + 1)]
    return spark.createDataFrame(rows, "pool string, number int")


def densify(stats: DataFrame, pools: Sequence[Pool] = DEFAULT_POOLS,
            fill: dict | None = None) -> DataFrame:
    """Reindex per-(pool, number) stats onto the full domain, filling gaps.

    ``stats`` has at most one row per (pool, number), so both sides are bounded
    by the domain size (tens of rows); AQE plans the tiny join.
    """
    dom = domain(stats.sparkSession, pools)
    out = dom.join(stats, ["pool", "number"], "left")
    for c, v in (fill or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), v if hasattr(v, "_jc") else F.lit(v)))
    return out


def indicator_counts(df: DataFrame, key: str, pool: Pool, unique_key: bool = False) -> DataFrame:
    """Per draw key, how often each number of ``pool`` occurs (O43), dense over the domain.

    Output ``key, number, cnt`` including zero rows. With ``unique_key`` every
    draw is counted by itself in a projection, without a shuffle; otherwise
    the counts of draws with one key are added up.
    """
    numbers = F.array(*[F.col(c).cast("int") for c in pool.columns])
    cells = F.transform(F.sequence(F.lit(pool.lo), F.lit(pool.hi)), lambda n: F.struct(
        n.alias("number"), F.size(F.filter(numbers, lambda x: F.coalesce(x == n, F.lit(False)))).cast("long").alias("cnt")))
    counted = df.select(key, F.inline(cells))
    return counted if unique_key else counted.groupBy(key, "number").agg(F.sum("cnt").alias("cnt"))
