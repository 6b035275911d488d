"""Reconciling two copies of a table, constraint checks, duplicates, quality gate.

O33, O34, O36, O40, O69.

The reconcile is a union of both copies followed by one groupBy on the key,
not a full outer join: a key repeated on both sides is aggregated instead of
producing every left x right pair, and each task sends at most one partial row
per key. With text columns Spark sorts for that aggregation rather than hashing. Keys seen more than once on a side are reported as ``duplicate``.
Null keys group together, so null meets null as in a pandas outer merge.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("left_only", "right_only", "both", "duplicate")


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str],
              compare_cols: Sequence[str], null_mismatch: bool = False,
              suffixes: tuple[str, str] = ("_left", "_right")) -> DataFrame:
    """One row per key value: presence status, both sides' values and match flags.

    Output: keys, ``left_rows``, ``right_rows``, ``status``, for each compared
    column ``<c><suffix0>``, ``<c><suffix1>``, ``<c>_match``, and ``mismatch``.

    ``null_mismatch=False`` (compatible): a null on either side is not a
    mismatch. ``True`` (strict): null-safe equality, so null vs value differs.
    Match flags are only set for ``both`` rows; ``duplicate`` rows show no values.
    """
    ls, rs = suffixes
    side = F.col("_side")
    u = (left.select(*keys, *compare_cols, F.lit(1).alias("_side"))
             .unionByName(right.select(*keys, *compare_cols, F.lit(2).alias("_side"))))
    aggs = [F.count(F.when(side == 1, 1)).alias("left_rows"),
            F.count(F.when(side == 2, 1)).alias("right_rows")]
    for c in compare_cols:
        aggs += [F.max(F.when(side == 1, F.col(c))).alias(c + ls),
                 F.max(F.when(side == 2, F.col(c))).alias(c + rs)]
    g = u.groupBy(*keys).agg(*aggs)
    status = (F.when(F.col("left_rows") == 0, F.lit("right_only"))
               .when(F.col("right_rows") == 0, F.lit("left_only"))
               .when((F.col("left_rows") == 1) & (F.col("right_rows") == 1), F.lit("both"))
               .otherwise(F.lit("duplicate")))
    g = g.withColumn("status", status)
    # The extremes of several rows may belong to no single row, so a repeated key shows no values.
    single = F.col("status") != "duplicate"
    g = g.withColumns({c + x: F.when(single, F.col(c + x)) for c in compare_cols for x in suffixes})
    matches = []
    for c in compare_cols:
        a, b = F.col(c + ls), F.col(c + rs)
        eq = a.eqNullSafe(b) if null_mismatch else F.coalesce(a == b, F.lit(True))
        g = g.withColumn(c + "_match", F.when(F.col("status") == "both", eq))
        matches.append(F.col(c + "_match"))
    all_match = F.lit(True)
    for m in matches:
        all_match = all_match & m
    return g.withColumn("mismatch", (F.col("status") == "both") & ~all_match)


def reconcile_summary(recon: DataFrame) -> DataFrame:
    """One row of counts: each status, mismatched and matched common keys."""
    st = F.col("status")
    return recon.agg(*[F.count_if(st == s).alias(s) for s in STATUSES],
                     F.count_if(F.col("mismatch")).alias("mismatched"),
                     F.count_if((st == "both") & ~F.col("mismatch")).alias("matched"))


def only_in(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key has no null-safe match in ``right``.

    The right side is reduced to its distinct keys first (partial
    aggregation), so a key repeated many times on the right is one row
    before it reaches the join.
    """
    rk = right.select(*keys).distinct()
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(rk[k])
        cond = c if cond is None else cond & c
    return left.join(rk, cond, "left_anti")


def find_duplicates(df: DataFrame, keys: Sequence[str], count_col: str = "n",
                    limit: int | None = None, descending: bool = True) -> DataFrame:
    """Key values occurring more than once (O31, O40), newest key first when limited."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)
    if limit is not None:
        order = [F.col(k).desc() if descending else F.col(k).asc() for k in keys]
        out = out.orderBy(*order).limit(limit)
    return out


def check_constraints(df: DataFrame, table: str, not_null: Sequence[str] = (),
                      unique: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Constraint report (O36): ``table, rule, columns, violations``.

    Not-null checks share one aggregate; each unique key set is one grouped
    count (duplicates = key values seen more than once).
    """
    spark = df.sparkSession
    parts = []
    if not_null:
        nn = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        parts.append(nn.select(F.lit(table).alias("table_name"), F.lit("not_null").alias("rule"),
                               F.inline(F.array(*[F.struct(F.lit(c).alias("columns"),
                                                           F.col(c).alias("violations"))
                                                  for c in not_null]))))
    for key in unique:
        dup = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
                 .agg(F.count(F.lit(1)).alias("violations")))
        parts.append(dup.select(F.lit(table).alias("table_name"), F.lit("unique").alias("rule"),
                                F.lit(",".join(key)).alias("columns"), "violations"))
    if not parts:
        return spark.createDataFrame([], "table_name string, rule string, columns string, violations long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class QualityGateError(RuntimeError):
    """Raised when a reconcile summary is outside its thresholds."""


def gate_status(summary: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Add ``passed`` to the one-row summary: every named count within its limit."""
    ok: Column = F.lit(True)
    for name, lim in limits.items():
        ok = ok & (F.col(name) <= F.lit(lim))
    return summary.withColumn("passed", ok)


def quality_gate(summary: DataFrame, limits: Mapping[str, int] | None = None) -> dict:
    """Decide on a one-row summary; raise ``QualityGateError`` when a limit is exceeded.

    Default limits: no one-sided keys, no duplicates and no mismatches.
    Only the single summary row reaches the driver.
    """
    limits = dict(limits or {"left_only": 0, "right_only": 0, "duplicate": 0, "mismatched": 0})
    row = gate_status(summary, limits).first()
    result = row.asDict() if row is not None else {"passed": True}
    if not result["passed"]:
        over = {k: result[k] for k, v in limits.items() if result[k] > v}
        raise QualityGateError(f"quality gate failed: {over}")
    return result
