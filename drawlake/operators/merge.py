"""Upsert (MERGE) keyed on columns, conditional update and delete.

One shape for every size: the source is reduced to one row per key, the target
is left-joined with it (no pairs: a target row meets at most one source row),
and source rows without a target are appended. Spark picks broadcast or
shuffled joins by the bytes it measures, and may split a hot target key. The
answer does not depend on that choice.

Rows whose key has a null are never matched (SQL MERGE semantics) and pass
through unchanged (target) or are inserted (source).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _has_null_key(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_col: str | None) -> DataFrame:
    """One row per key: the one with the greatest ``order_col`` (last wins).

    Rows are compared by ``order_col`` (null first) and then by all their
    columns, so a null order never hides a row and ties are settled.
    """
    cols = [c for c in df.columns if c not in keys]
    if not cols:
        return df.dropDuplicates(list(keys))
    order = F.struct(*([F.col(order_col).alias("_order")] if order_col else []), *[F.col(c) for c in cols])
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*cols), order).alias("_row"))
              .select(*keys, "_row.*"))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, order_col: str | None = None) -> DataFrame:
    """MERGE ``source`` into ``target`` on ``keys``; returns the merged table.

    Matched target rows (all of them, also when the target repeats a key):
    ``update_cols`` (default: every non-key target column that the source has)
    take the source value, other columns keep theirs. Source keys without a
    target row are inserted; columns the source lacks are null there.
    ``order_col`` picks the last of several source rows per key.
    """
    tcols = target.columns
    src_cols = [c for c in tcols if c in source.columns]
    update = list(update_cols) if update_cols is not None else [c for c in src_cols if c not in keys]
    lacking = [c for c in update if c not in src_cols]
    if lacking:
        raise ValueError(f"the source has no column {lacking}")
    src = source.select(*src_cols, *([order_col] if order_col and order_col not in src_cols else []))
    null_src = src.where(_has_null_key(keys)).select(*src_cols)
    src = dedupe_latest(src.where(~_has_null_key(keys)), keys, order_col).select(*src_cols)

    new = src.select(*keys, F.struct(*[F.col(c) for c in update], F.lit(True).alias("_hit")).alias("_new"))
    found = F.col("_new").isNotNull()
    updated = target.join(new, list(keys), "left").select(*[
        (F.when(found, F.col("_new").getField(c)).otherwise(F.col(c)) if c in update else F.col(c)).alias(c)
        for c in tcols])
    inserted = src.join(target.select(*keys), list(keys), "left_anti").unionByName(null_src)
    return updated.unionByName(inserted, allowMissingColumns=True).select(*tcols)


def update_where(df: DataFrame, condition: Column | str, assignments: dict) -> DataFrame:
    """``UPDATE ... SET col = value WHERE condition`` as a projection."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    out = df
    for c, v in assignments.items():
        val = v if isinstance(v, Column) else F.lit(v)
        out = out.withColumn(c, F.when(F.coalesce(cond, F.lit(False)), val).otherwise(F.col(c)))
    return out


def delete_where(df: DataFrame, condition: Column | str) -> DataFrame:
    """``DELETE ... WHERE condition``: keep rows where it is not true."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return df.where(~F.coalesce(cond, F.lit(False)))


def delete_keys(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove rows whose key appears in ``keys_df`` (left anti join) (V4)."""
    return df.join(keys_df.select(*keys), list(keys), "left_anti")
