"""Counting operators: frequency, share, top-N + Others, year matrix, recency.

O38-O42, O51, O56. Every aggregation is a
partial + final hash aggregate; windows only run over already-aggregated
tables whose groups are bounded by the pool domain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drawlake.operators.reshape import to_long
from drawlake.schemas import DEFAULT_POOLS, Pool


def frequency(long_df: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Occurrences per (by..., pool, number), like ``value_counts``.

    Numbers never drawn are absent (compatible default); pass the result
    through ``densify`` to add zero rows.
    """
    return (long_df.groupBy(*by, "pool", "number")
                   .agg(F.count(F.lit(1)).alias("frequency")))


def frequency_share(counts: DataFrame, by: Sequence[str] = (), decimals: int | None = None,
                    count_col: str = "frequency", out_col: str = "share_pct") -> DataFrame:
    """Percent of the pool total for each number.

    ``decimals`` rounds for display; ``None`` keeps full precision.
    """
    total = F.sum(count_col).over(Window.partitionBy(*by, "pool"))
    share = F.col(count_col) * F.lit(100.0) / total
    return counts.withColumn(out_col, F.round(share, decimals) if decimals is not None else share)


def top_n_with_others(counts: DataFrame, n: int, by: Sequence[str] = (),
                      count_col: str = "frequency", label_col: str = "label",
                      others: str = "Others") -> DataFrame:
    """Keep the ``n`` largest counts per group, fold the rest into one ``Others`` row.

    Ties break on the smaller number. Groups with at most ``n`` numbers get
    no ``Others`` row.
    """
    grp = [*by, "pool"]
    rank = F.row_number().over(Window.partitionBy(*grp).orderBy(F.col(count_col).desc(), F.col("number")))
    labelled = counts.withColumn(
        label_col, F.when(rank <= n, F.col("number").cast("string")).otherwise(F.lit(others)))
    return labelled.groupBy(*grp, label_col).agg(F.sum(count_col).alias(count_col))


def top_values(counts: DataFrame, value_col: str, n: int, by: Sequence[str] = (), count_col: str = "frequency",
               label_col: str = "label", others: str = "Others") -> DataFrame:
    """The ``n`` largest counts per group, the rest as one ``others`` row, and every row's share (O39, O56), for a
    domain of any size.

    ``counts`` has one row per group and value. Each task keeps the ``n``
    largest of each group before anything is shuffled (a rank that is filtered
    by a limit), and group totals come from an aggregate, so no task sees a
    group whole. Ties break on the smaller value; a null value is labelled
    null and ranks as the least value. ``is_other`` tells the rest from a
    value of that name. Output ``by..., label, is_other, count_col, share_pct``.
    """
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.col(count_col).desc(), F.col(value_col)))
    top = (counts.withColumn("_rank", rank).where(F.col("_rank") <= n)
                 .select(*by, F.col(value_col).cast("string").alias(label_col), F.lit(0).alias("_whole"), F.col(count_col).alias("_n")))
    whole = counts.groupBy(*by).agg(F.sum(count_col).alias("_n")).select(
        *by, F.lit(None).cast("string").alias(label_col), F.lit(1).alias("_whole"), "_n").where(F.col("_n").isNotNull())
    # At most n + 1 rows a group come together here.
    cell = F.struct("_whole", label_col, "_n")
    grouped = top.unionByName(whole).groupBy(*by).agg(
        F.max(F.when(F.col("_whole") == 1, F.col("_n"))).alias("_total"), F.collect_list(cell).alias("_cells"))
    kept = F.filter("_cells", lambda c: c["_whole"] == 0)
    rest = F.col("_total") - F.aggregate(kept, F.lit(0).cast("long"), lambda a, c: a + c["_n"])
    shown = F.transform(kept, lambda c: F.struct(c[label_col].alias(label_col), F.lit(False).alias("is_other"), c["_n"].alias(count_col)))
    other = F.when(rest > 0, F.array(F.struct(F.lit(others).alias(label_col), F.lit(True).alias("is_other"), rest.alias(count_col))))
    return (grouped.select(*by, "_total", F.inline(F.concat(shown, F.coalesce(other, F.slice(shown, 1, 0)))))
                   .withColumn("share_pct", F.col(count_col) * F.lit(100.0) / F.col("_total")).drop("_total"))


def frequency_matrix(long_df: DataFrame, pool: Pool, row_col: str | Column,
                     row_name: str = "year", prefix: str = "n_") -> DataFrame:
    """Row key x number count matrix over the full domain, zero filled.

    The pivot values are passed explicitly, so no extra job discovers them.
    """
    values = list(range(pool.lo, pool.hi + 1))
    rows = F.col(row_col) if isinstance(row_col, str) else row_col
    pivoted = (long_df.where(F.col("pool") == pool.name)
                      .select(rows.alias(row_name), "number")
                      .groupBy(row_name).pivot("number", values).agg(F.count(F.lit(1))))
    pivoted = pivoted.na.fill(0, [str(v) for v in values])
    return pivoted.select(row_name, *[F.col(str(v)).alias(f"{prefix}{v}") for v in values])


def recency(draws: DataFrame, order_cols: str | Sequence[str] = "seq",
            pools: Sequence[Pool] = DEFAULT_POOLS) -> DataFrame:
    """Draws since each number was last seen (O51): 0 = in the latest draw.

    ``order_cols`` order the draws (together unique, null first). Never-seen
    numbers get the number of draws. No global order is built: one aggregate finds each
    number's last draw, a second counts, for all numbers at once, the draws after
    it. What passes through the driver is one row per number of the pools.
    """
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    key = F.struct(*order)
    last = (to_long(draws, pools, keep=[key.alias("_at")])
            .groupBy("pool", "number").agg(F.max("_at").alias("_last")).collect())
    types = {f.name: f.dataType for f in draws.select(*order).schema.fields}
    after = {}
    for r in last:
        at = F.struct(*[F.lit(r["_last"][c]).cast(types[c]).alias(c) for c in order])
        after[(r["pool"], r["number"])] = F.count(F.when(key > at, 1))
    cells = [(p.name, n) for p in pools for n in range(p.lo, p.hi + 1)]
    counted = draws.agg(F.array(*[F.struct(F.lit(pool).alias("pool"), F.lit(n).alias("number"),
                                           after.get((pool, n), F.count(F.lit(1))).alias("draws_since"))
                                  for pool, n in cells]).alias("cells"))
    return counted.select(F.inline("cells"))
