"""Column alignment, required-column checks, tolerant casts, unions and quarantine.

O17-O22, O61, O70, with F1-F4 and F9 from ``drawlake.functions``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawlake.functions.dates import normalize_date, parse_date
from drawlake.schemas import CORE_COLUMNS


def lower_case_columns(df: DataFrame) -> DataFrame:
    """All column names to lower case (O19); two names colliding is an error."""
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        dup = sorted({c for c in lowered if lowered.count(c) > 1})
        raise ValueError(f"lower-casing makes duplicate columns: {dup}")
    return df.toDF(*lowered)


def align_columns(df: DataFrame, renames: Mapping[str, str] | None = None,
                  drop: Sequence[str] = (), lower: bool = False,
                  constants: Mapping[str, object] | None = None) -> DataFrame:
    """Drop (O17), rename (O18), lower-case (O19) and add literal columns."""
    out = df.drop(*drop) if drop else df
    if renames:
        present = {k: v for k, v in renames.items() if k in out.columns}
        out = out.withColumnsRenamed(present)
    if lower:
        out = lower_case_columns(out)
    for name, value in (constants or {}).items():
        out = out.withColumn(name, value if isinstance(value, Column) else F.lit(value))
    return out


def require_columns(df: DataFrame, columns: Sequence[str], source: str = "input") -> None:
    """Raise ``KeyError`` naming every required column that is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"required columns {missing} not found in {source} data")


def tolerant_int(c) -> Column:
    """Text/number to int; anything not an integral number becomes null.

    ``'12'``, ``' 12 '``, ``'12.0'`` and ``12.0`` give 12; ``'12.5'``, ``'x'``
    and out-of-range values give null. Never raises under ANSI mode.
    """
    c = F.col(c) if isinstance(c, str) else c
    d = F.trim(c.cast("string")).try_cast("double")
    ok = d.isNotNull() & (d == F.floor(d)) & (F.abs(d) <= F.lit(2147483647.0))
    return F.when(ok, d.cast("long").cast("int"))


def standardize(df: DataFrame, core: Sequence[str] = CORE_COLUMNS, date_col: str = "draw_date",
                date_format: str | None = None, source: str = "input",
                int_columns: Sequence[str] | None = None) -> DataFrame:
    """Lower-case names, check the core columns, normalise the date, cast numbers, project.

    ``date_format`` parses text with one pattern; without it any timestamp or
    date text is accepted and truncated to the day.
    """
    out = lower_case_columns(df)
    require_columns(out, [date_col], source)
    require_columns(out, core, source)
    date = parse_date(date_col, date_format) if date_format else normalize_date(date_col)
    ints = [c for c in (int_columns if int_columns is not None else core) if c != date_col]
    return out.select(*[date.alias(c) if c == date_col else
                        (tolerant_int(c).alias(c) if c in ints else F.col(c)) for c in core])


def union_aligned(frames: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union by column name (O61); columns missing on one side become null."""
    if not frames:
        raise ValueError("nothing to union")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def split_valid(df: DataFrame, rules: Mapping[str, Column],
                reason_col: str = "_reason") -> tuple[DataFrame, DataFrame]:
    """Split rows into (valid, quarantine) by named rules that must hold.

    A rule that evaluates to false or null fails. Quarantined rows keep all
    their columns plus ``reason_col``: the comma-joined names of failed rules.
    Both outputs come from one projection; nothing is collected.
    """
    failed = F.array_compact(F.array(*[
        F.when(F.coalesce(cond, F.lit(False)), F.lit(None)).otherwise(F.lit(name))
        for name, cond in rules.items()]))
    tagged = df.withColumn("_failed", failed)
    valid = tagged.where(F.size("_failed") == 0).drop("_failed")
    bad = (tagged.where(F.size("_failed") > 0)
                 .withColumn(reason_col, F.array_join("_failed", ","))
                 .drop("_failed"))
    return valid, bad


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows with a null in any of ``subset`` removed."""
    return df.na.drop(subset=list(subset))


def filter_not_in(df: DataFrame, column: str | Column, values: Sequence) -> DataFrame:
    """``column NOT IN (values)`` (O26); null values are dropped as in SQL."""
    c = F.col(column) if isinstance(column, str) else column
    return df.where(~c.isin(list(values)))
