"""Reconcile by a tree of digests: only what differs is shuffled row by row.

Rows go to buckets by a hash of their key. A bucket's digest does not depend on
the order of its rows (a count, exclusive ors and sums of two row hashes), so
each copy is reduced to one row per bucket where it lies. Buckets whose digests
agree hold the same rows on both sides; the others are divided once more, and
only rows of unequal parts meet in :func:`drawlake.operators.reconcile.reconcile`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawlake.operators.reconcile import reconcile, reconcile_summary

#: Buckets of the first level, and parts of each unequal bucket.
BUCKETS, PARTS = 4_096, 64


def _bucket(keys: Sequence[str], level: str, n: int) -> Column:
    """A key's bucket; null keys have one too."""
    known = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    void = [F.col(k).isNull() for k in keys]
    return F.pmod(F.xxhash64(F.lit(level), *known, *void), F.lit(n)).cast("int")


def digests(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per value of ``by``: ``rows`` and an order-free ``digest`` of the given columns (nulls count)."""
    cells = [c for name in columns for c in (F.col(name), F.col(name).isNull())]
    low, high = F.lit(0xFFFFFFFF).cast("long"), 32

    def sums(h: Column, name: str) -> list[Column]:
        return [F.bit_xor(h).alias(f"{name}x"), F.sum(h.bitwiseAND(low)).alias(f"{name}l"),
                F.sum(F.shiftrightunsigned(h, high)).alias(f"{name}h")]

    hashed = df.select(*by, F.xxhash64(*cells).alias("__a"), F.xxhash64(F.lit("again"), *cells).alias("__b"))
    return (hashed.groupBy(*by).agg(F.count("*").alias("rows"), *sums(F.col("__a"), "a"), *sums(F.col("__b"), "b"))
            .select(*by, "rows", F.struct("ax", "al", "ah", "bx", "bl", "bh").alias("digest")))


def _unequal(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Values of ``by`` whose digests differ or that one side lacks."""
    both = (left.withColumn("__side", F.lit(1)).unionByName(right.withColumn("__side", F.lit(2)))
            .groupBy(*by).agg(F.count("*").alias("sides"), F.min("digest").alias("lo"), F.max("digest").alias("hi"),
                              F.min("rows").alias("fewer"), F.max("rows").alias("more")))
    return both.where((F.col("sides") != 2) | (F.col("lo") != F.col("hi")) | (F.col("fewer") != F.col("more"))).select(*by)


def _split(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int, parts: int):
    """Both copies with ``__bucket`` and ``__part``, and a column that says whether the part is unequal."""
    sides = [d.select(*columns).withColumns({"__bucket": _bucket(keys, "bucket", buckets), "__part": _bucket(keys, "part", parts)})
             for d in (left, right)]
    first = _unequal(*[digests(d, columns, ["__bucket"]) for d in sides], ["__bucket"]).collect()  # at most ``buckets`` numbers
    numbers = [r[0] for r in first]
    if not numbers:
        return sides, F.lit(False)
    inside = F.col("__bucket").isin(numbers)
    second = _unequal(*[digests(d.where(inside), columns, ["__bucket", "__part"]) for d in sides], ["__bucket", "__part"])
    # At most buckets * parts pairs: as bits, one long per unequal bucket.
    bits = {r["__bucket"]: r["bits"] for r in second.groupBy("__bucket").agg(
        F.bit_or(F.expr("shiftleft(1L, __part)")).alias("bits")).collect()}
    masks = F.create_map(*[x for b in numbers for x in (F.lit(b), F.lit(bits.get(b, 0)).cast("long"))])
    mask = F.coalesce(F.element_at(masks, F.col("__bucket")), F.lit(0).cast("long"))
    return sides, F.call_function("shiftrightunsigned", mask, F.col("__part")).bitwiseAND(F.lit(1).cast("long")) == 1


def reconcile_by_digest(left: DataFrame, right: DataFrame, keys: Sequence[str], compare_cols: Sequence[str],
                        null_mismatch: bool = False, unique_keys: bool = False, buckets: int = BUCKETS,
                        parts: int = PARTS) -> DataFrame:
    """The rows of :func:`~drawlake.operators.reconcile.reconcile`, shuffling only unequal parts of both copies.

    Each copy is scanned three times (two digests, of which the second reads
    unequal buckets only, and the result). Rows of equal parts are matched rows
    of ``left``; with ``unique_keys`` (both copies known to repeat no key, as
    :func:`~drawlake.operators.reconcile.check_constraints` tells) they are not
    shuffled at all, without it those of ``left`` alone are grouped to find
    repeated keys. Two different parts pass for equal only if 128 bits of
    hashes agree. ``parts`` is 64 at most.
    """
    if not 1 <= parts <= 64:
        raise ValueError("parts must lie between 1 and 64")
    columns = [*keys, *compare_cols]
    (a, b), differs = _split(left, right, keys, columns, buckets, parts)
    rest = reconcile(a.where(differs), b.where(differs), keys, compare_cols, null_mismatch)
    same = a.where(~differs)
    if unique_keys:
        n, first = F.lit(1).cast("long"), same
    else:
        first = same.groupBy(*keys).agg(F.count("*").alias("__n"), *[F.max(c).alias(c) for c in compare_cols])
        n = F.col("__n")
    single = n == 1
    out = [*keys, n.alias("left_rows"), n.alias("right_rows"), F.when(single, "both").otherwise("duplicate").alias("status")]
    by_name = {"mismatch": F.lit(False).alias("mismatch")}
    for c in compare_cols:
        by_name |= {f"{c}_left": F.when(single, F.col(c)).alias(f"{c}_left"), f"{c}_right": F.when(single, F.col(c)).alias(f"{c}_right"),
                    f"{c}_match": F.when(single, F.lit(True)).alias(f"{c}_match")}
    done = ("left_rows", "right_rows", "status")
    equal = first.select(*out, *[by_name[c] for c in rest.columns if c not in keys and c not in done])
    return rest.unionByName(equal)


def summary_by_digest(left: DataFrame, right: DataFrame, keys: Sequence[str], compare_cols: Sequence[str],
                      null_mismatch: bool = False, buckets: int = BUCKETS, parts: int = PARTS) -> DataFrame:
    """The one row of counts of :func:`~drawlake.operators.reconcile.reconcile_summary` for copies that repeat no key
    where they agree: equal parts only add to ``both`` and ``matched``, by their number of rows."""
    columns = [*keys, *compare_cols]
    (a, b), differs = _split(left, right, keys, columns, buckets, parts)
    rest = reconcile_summary(reconcile(a.where(differs), b.where(differs), keys, compare_cols, null_mismatch))
    equal = a.where(~differs).agg(F.count("*").alias("__n"))
    n = F.col("__n")
    return rest.crossJoin(equal).select(*[(F.col(c) + n).alias(c) if c in ("both", "matched") else F.col(c) for c in rest.columns])
